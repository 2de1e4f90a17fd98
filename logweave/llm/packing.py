"""Packing token sequences into windows by Karmarkar-Karp multiway differencing.

A task tokenizes its documents one after the other.  Whole windows of a long
document are sequences of their own; what is left is cut into pieces of at most
``PIECE`` tokens, and pieces are gathered until they fill ``WINDOWS`` windows.
Such a batch is split into windows of near-equal length: partial partitions, at
first one piece each, are merged two by two, those with the largest differences
first, the fullest window of one with the emptiest of the other.  If the fullest
window then exceeds the capacity, the batch is split into one window more.  No
rows are shuffled, and a task holds one batch at a time, whatever the input.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.words import small_batches

WINDOW = 2048
PIECE = 256
WINDOWS = 128
END = (1).to_bytes(4, "little")

# Fixed value: where the byte-level vocabulary's texts are split before merging.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SCHEMA = pa.schema(
    [
        ("row", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
_encoders: dict[str, Encoder] = {}


def byte_characters() -> dict[str, int]:
    """Which character stands for which byte in a byte-level vocabulary.

    Printable Latin-1 characters are themselves; the other bytes, in order, are the
    characters from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Encoder:
    """Ids of texts under a byte-level tokenizer file whose merges are ranked by id.

    Texts that hold a special token's string go to the tokenizer itself, the others
    to a merger of the same vocabulary (``tiktoken``), which is several times as fast.
    The merger refuses a run of about 1,000,000 characters of white space; a text
    that it refuses goes to the tokenizer itself, too.  So do all texts where the file
    does not split and merge them as the merger does.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        stands_for = byte_characters()
        ranks = {
            bytes(stands_for[c] for c in token): k
            for token, k in self.whole.get_vocab(with_added_tokens=False).items()
            if token not in self.special
        }
        self.merger = tiktoken.Encoding("merger", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.as_merger = merges_alike(json.loads(self.whole.to_str()))

    def encode(self, text: str) -> bytes:
        """The ids of a text and the closing id, as little-endian unsigned 32-bit numbers."""
        if not self.as_merger or any(token in text for token in self.special):
            return self._by_tokenizer(text)
        try:
            ids = self.merger.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype("<u4")
        except ValueError:
            return self._by_tokenizer(text)
        return ids.tobytes() + END

    def _by_tokenizer(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes() + END


def merges_alike(file: dict) -> bool:
    """Does a tokenizer file change no text, split it like :data:`SPLIT`, and merge by plain ranks of bytes?"""
    splits, model = file.get("pre_tokenizer") or {}, file["model"]
    by_bytes = splits.get("type") == "ByteLevel" and not splits.get("add_prefix_space") and splits.get("use_regex", True)
    odd = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if file.get("normalizer") or not by_bytes or model.get("type") != "BPE" or any(model.get(k) for k in odd):
        return False
    # Merges in the order of the ids they make, so that a lower id is an earlier merge.
    made = (model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"])
    last = -1
    for token in made:
        if token < last:
            return False
        last = token
    return True


def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file, kept while the worker lives."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def differencing(sizes: list[int], windows: int) -> list[tuple[int, tuple[int, ...]]]:
    """``sizes`` split into at most ``windows`` parts of near-equal sums: (sum, indices), fullest first.

    Empty windows of a partial partition are left out; they pair like zeros.
    """
    heap = [(-size, i, [(size, (i,))]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    made = len(heap)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, two = heapq.heappop(heap)
        shared = max(0, len(one) + len(two) - windows)
        low, high = one[len(one) - shared :], two[len(two) - shared :][::-1]
        parts = one[: len(one) - shared] + two[: len(two) - shared]
        parts += [(a[0] + b[0], a[1] + b[1]) for a, b in zip(low, high, strict=True)]
        parts.sort(key=lambda p: -p[0])
        spread = parts[0][0] - (parts[-1][0] if len(parts) == windows else 0)
        heapq.heappush(heap, (-spread, made, parts))
        made += 1
    return heap[0][2] if heap else []


def split(sizes: list[int], window: int = WINDOW) -> list[tuple[int, ...]]:
    """Windows of at most ``window`` tokens; one more is opened whenever the fullest exceeds it."""
    windows = max(1, -(-sum(sizes) // window))
    while True:
        parts = differencing(sizes, windows)
        if not parts or parts[0][0] <= window:
            return [items for _, items in parts]
        windows += 1


def _pack(path: str, window: int, piece: int, windows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        sequence = partition << 32
        rest: list[tuple] = []
        filled = 0
        out: list[tuple] = []

        def close() -> None:
            nonlocal sequence, rest, filled
            for items in split([p[2] for p in rest], window):
                offset = 0
                for i in items:
                    out.append((*rest[i], sequence, offset))
                    offset += rest[i][2]
                sequence += 1
            rest, filled = [], 0

        def told() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _SCHEMA, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)

        coder = encoder(path)
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = coder.encode(text)
                n = len(ids) // 4
                start = 0
                while start < n:
                    whole = n - start >= window
                    length = window if whole else min(piece, n - start)
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    if whole:
                        out.append((row, start, length, crc, n, sequence, 0))
                        sequence += 1
                    else:
                        rest.append((row, start, length, crc, n))
                        filled += length
                    start += length
                if filled > (windows - 1) * window:
                    close()
            if out:
                yield told()
        if rest:
            close()
            yield told()

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    piece: int = PIECE,
    windows: int = WINDOWS,
) -> DataFrame:
    """The pieces of every document and where each lies.

    Columns: ``id``, ``start`` and ``length`` (in the document's ids), ``ids_crc32``,
    ``doc_tokens``, ``sequence_id`` and ``offset``.  A document is its ids and the
    closing id 1; null and empty texts are that id alone.  Rows that repeat are
    packed each for itself; null ids stay null.  Sequence numbers have gaps.  Of a text
    of any length whole windows are sequences of their own and the rest is packed.  An
    empty table gives no rows, and other columns are not read.
    """
    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    if kind != "bigint":
        raise ValueError(f"{id_col} is {kind}, not bigint")
    rows = docs.select(F.col(id_col).alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = ", ".join(f"{f.name} long" for f in _SCHEMA)
    return rows.mapInArrow(_pack(tokenizer, window, piece, windows), schema).withColumnRenamed("row", "id")
