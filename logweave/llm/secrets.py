"""Secret scans: fixed patterns, and windows of high Shannon entropy per character class.

Candidates of a class are the maximal runs of its characters that mix letters with
digits or small letters with capitals, cut where a word of the allow-list stands; a run
that is a path or a name, made of words and numbers only, is none.  A window slides over
a candidate; its entropy follows from the counts of its characters, of which a step
changes two.  Windows at or above the class's threshold are merged into spans, and spans
that an allow-list knows are dropped.  What is left of a run beside an allowed word may
be somewhat shorter than a window, and is then one window as a whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.words import byte_groups, small_batches, utf8

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 12, 18, 16
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
BASE = ("assign", "access", "hex")


@dataclass(frozen=True)
class CharClass:
    """Characters, window length in characters and least entropy in bits."""

    kind: str
    chars: str
    window: int
    bits: float


_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
CLASSES = (
    CharClass("entropy_hex", _DIGITS + "abcdefABCDEF", 16, 3.0),
    CharClass("entropy_base64", _DIGITS + _LOWER + _LOWER.upper() + "+/_=-", 20, 3.7),
)
# Words of what is no secret; windows that overlap one do not count.
WORDS = re.compile(r"example|sample|dummy|placeholder|changeme|xxxx|0123456789", re.IGNORECASE)
# Between separators, what paths, names and slugs are made of: words, joined words, numbers, short codes.
PLAIN = re.compile(r"[a-z]*(?:[A-Z][a-z]{2,}|[A-Z]{2,4}(?=[A-Z][a-z]))*\d{0,4}|[A-Z]+\d{0,4}|\d+|[A-Za-z0-9]{1,4}")
SEPARATORS = re.compile(r"[/+_=-]+")
# Beside an allowed word so much of a window is enough, with so much of its entropy.
PART = 0.75
# What looks random but is no secret, matched against a whole span.
ALLOW = (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
    r"[0-9+/_=-]+",
)

Span = tuple[str, int, int]


def _mask(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars.encode())] = True
    return table


_HEX = _mask(_DIGITS + "abcdef")
_DIGIT = _mask(_DIGITS)
_LETTER = _mask(_LOWER + _LOWER.upper())
_SMALL = _mask(_LOWER)
_TABLES = {c.kind: _mask(c.chars) for c in CLASSES}


def runs(inside: np.ndarray, at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of at least ``least`` bytes, none across the start of a text."""
    edge = np.zeros(len(inside) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    edge[at] = True
    places = np.flatnonzero(edge)
    starts, ends = places[:-1], places[1:]
    fit = inside[starts] & (ends - starts >= least) if len(inside) else np.zeros(len(starts), bool)
    return starts[fit], ends[fit]


def high_windows(text: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Merged windows of ``text`` whose entropy reaches ``bits``; counts change one step at a time."""
    if len(text) < window:
        return []
    part = [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    most = (math.log2(window) - bits) * window + 1e-9
    counts: dict[str, int] = {}
    total = 0.0
    found: list[tuple[int, int]] = []
    for end, char in enumerate(text, 1):
        n = counts.get(char, 0)
        total += part[n + 1] - part[n] if n < window else 0.0
        counts[char] = n + 1
        if end > window:
            gone = text[end - window - 1]
            m = counts[gone]
            total += part[m - 1] - part[m] if m <= window else 0.0
            counts[gone] = m - 1
        if end >= window and total <= most:
            start = end - window
            if found and start <= found[-1][1]:
                found[-1] = (found[-1][0], end)
            else:
                found.append((start, end))
    return found


def between_words(text: str) -> list[tuple[int, int]]:
    """The parts of a run that hold no word of the allow-list."""
    parts, first = [], 0
    for word in WORDS.finditer(text):
        parts.append((first, word.start()))
        first = word.end()
    return [*parts, (first, len(text))]


def is_name(text: str) -> bool:
    """Is every part between separators a word, joined words, or a number?"""
    return all(PLAIN.fullmatch(part) for part in SEPARATORS.split(text) if part)


def windows(text: str, c: CharClass) -> Iterator[tuple[int, int]]:
    """The merged high windows of a run, allowed words and names left out."""
    if is_name(text):
        return
    parts = between_words(text)
    for first, last in parts:
        part, window, bits = text[first:last], c.window, c.bits
        if len(parts) > 1 and PART * window <= len(part) < window:
            window, bits = len(part), c.bits - math.log2(c.window / len(part))
        if len(parts) == 1 or not is_name(part):
            for a, b in high_windows(part, window, bits):
                yield first + a, first + b


def _chars(raw: np.ndarray, places: list[int]) -> list[int]:
    """Code points before each byte offset of a text; offsets ascend."""
    out, seen, last = [], 0, 0
    for place in places:
        part = raw[last:place]
        seen += int(np.count_nonzero((part & 0xC0) != 0x80))
        out.append(seen)
        last = place
    return out


def scan(data: np.ndarray, at: np.ndarray, allow: Sequence[re.Pattern]) -> list[list[Span]]:
    """The spans of each text, base kinds first listed, in code points."""
    n = len(at) - 1
    by_text: list[list[tuple[str, int, int]]] = [[] for _ in range(n)]  # byte offsets in the text
    spans: list[list[Span]] = [[] for _ in range(n)]

    def put(kind: str, starts: np.ndarray, ends: np.ndarray) -> None:
        owners = np.searchsorted(at, starts, "right") - 1
        for k, s, e in zip(owners.tolist(), starts.tolist(), ends.tolist(), strict=True):
            by_text[k].append((kind, s - int(at[k]), e - int(at[k])))

    put("hex", *runs(_HEX[data], at, LEAST_HEX))
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data], dtype=np.int64)])
    letters = np.concatenate([[0], np.cumsum(_LETTER[data], dtype=np.int64)])
    small = np.concatenate([[0], np.cumsum(_SMALL[data], dtype=np.int64)])
    blob = data.tobytes()
    for c in CLASSES:
        starts, ends = runs(_TABLES[c.kind][data], at, c.window)
        n_letters, n_small = letters[ends] - letters[starts], small[ends] - small[starts]
        mixed_case = (n_small > 0) & (n_small < n_letters)
        both = ((digits[ends] > digits[starts]) & (n_letters > 0)) | mixed_case
        found = []
        for s, e in zip(starts[both].tolist(), ends[both].tolist(), strict=True):
            text = blob[s:e].decode("ascii")
            for a, b in windows(text, c):
                if not any(rule.fullmatch(text, a, b) for rule in allow):
                    found.append((s + a, s + b))
        if found:
            put(c.kind, *map(np.array, zip(*found, strict=True)))

    lower = blob.lower()
    named: set[int] = set()
    for word, whole in [(b"AKIA", blob), *((k, lower) for k in KEYWORDS)]:
        place = whole.find(word)
        while place >= 0:
            k = int(np.searchsorted(at, place, "right")) - 1
            named.add(k)
            place = whole.find(word, int(at[k + 1]))
    for k in range(n):
        if by_text[k]:
            raw = data[at[k] : at[k + 1]]
            places = sorted({p for _, s, e in by_text[k] for p in (s, e)})
            chars = dict(zip(places, _chars(raw, places), strict=True))
            spans[k] = [(kind, chars[s], chars[e]) for kind, s, e in by_text[k]]
        if k in named:
            text = blob[at[k] : at[k + 1]].decode("utf-8", "replace")
            spans[k] += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
            spans[k] += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
        base = [s for s in spans[k] if s[0] in BASE]
        more = [s for s in spans[k] if s[0] not in BASE and not any(b[1] <= s[1] and s[2] <= b[2] for b in base)]
        spans[k] = ordered(base + more)
    return spans


def ordered(spans: list[Span]) -> list[Span]:
    kinds = [*BASE, *(c.kind for c in CLASSES)]
    return sorted(spans, key=lambda s: (s[1], kinds.index(s[0]), s[2]))


def told(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _scan(allow: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = [re.compile(rule) for rule in allow]
        for batch in batches:
            data, at = utf8(batch.column("text"))
            for first, last in byte_groups(at):
                found = scan(data[at[first] : at[last]], at[first : last + 1] - at[first], rules)
                base = [[s for s in spans if s[0] in BASE] for spans in found]
                counts = [[sum(s[0] == kind for s in spans) for spans in base] for kind in BASE]
                digests = [hashlib.sha256(told(spans).encode()).hexdigest() for spans in base]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(first, last - first),
                        *(pa.array(c, pa.int64()) for c in counts),
                        pa.array(digests),
                        pa.array([told(spans) for spans in found]),
                    ],
                    ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
                )

    return run


def find(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allow: Sequence[str] = ALLOW
) -> DataFrame:
    """One row per row of ``docs``: counts and digest of the base spans, and all spans.

    Spans are ``kind:start:end`` in code points, end exclusive, by start, then kind.
    An entropy span inside a base span is not told twice.  Null and empty texts have
    no spans and the digest of the empty string; rows that repeat are scanned each
    for itself.  Spans that start together are told base kinds first, in the order
    listed.  Long texts are scanned whole, in time proportional to their length, and
    rows are never shuffled; other columns are not read.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    kind = dict(rows.dtypes)["id"]
    schema = f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return rows.mapInArrow(_scan(tuple(allow)), schema)
