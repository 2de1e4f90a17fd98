"""Text, list and masking expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points with the Unicode White_Space property.
WHITE_SPACE = "".join(
    map(
        chr,
        [
            *range(0x09, 0x0E),
            0x20,
            0x85,
            0xA0,
            0x1680,
            *range(0x2000, 0x200B),
            0x2028,
            0x2029,
            0x202F,
            0x205F,
            0x3000,
        ],
    )
)


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trimmed(value: Column | str) -> Column:
    """Strip all Unicode white space (plain ``trim`` strips the blank only)."""
    return F.btrim(col(value), F.lit(WHITE_SPACE))


def normal_word(value: Column | str) -> Column:
    return F.lower(trimmed(value))


def is_blank(value: Column | str) -> Column:
    return F.coalesce(trimmed(value) == "", F.lit(True))


def or_default(value: Column | str, default: Column) -> Column:
    """An empty or missing text becomes ``default``."""
    return F.coalesce(F.nullif(col(value), F.lit("")), default)


def csv_items(value: Column | str) -> Column:
    """Comma list to trimmed, non-blank items in their order."""
    parts = F.transform(F.split(col(value), ",", -1), trimmed)
    return F.filter(parts, lambda x: x != "")


def contains_item(values: Column | str, item: Column | str) -> Column:
    return F.coalesce(F.array_contains(col(values), col(item)), F.lit(False))


def _empty_if_null(values: Column | str) -> Column:
    return F.coalesce(col(values), F.array().cast("array<string>"))


def add_items(values: Column | str, additions: Column | str) -> Column:
    """Union of two lists: trimmed, no blanks, no duplicates, sorted."""
    both = F.concat(_empty_if_null(values), _empty_if_null(additions))
    kept = F.filter(F.transform(both, trimmed), lambda x: x != "")
    return F.array_sort(F.array_distinct(kept))


def remove_items(values: Column | str, removals: Column | str) -> Column:
    """``values`` without the trimmed ``removals``, sorted; duplicates in it stay."""
    gone = F.transform(_empty_if_null(removals), trimmed)
    kept = F.filter(
        _empty_if_null(values), lambda v: (v == "") | ~F.array_contains(gone, v)
    )
    return F.array_sort(kept)


# --- masking -----------------------------------------------------------------

# Word characters, as the body of a character class.
CLASSES = {"ascii": "0-9A-Za-z_", "unicode": r"\p{L}\p{N}_"}

# Non-ASCII letters that equal an ASCII letter when case is ignored, and that letter.
FOLD_FROM, FOLD_TO = "\u017f\u212a", "sk"
_VARIANTS = {"s": "[s\u017f]", "\u017f": "[s\u017f]", "k": "[k\u212a]", "\u212a": "[k\u212a]"}


def folded(text: Column | str) -> Column:
    return F.translate(F.lower(col(text)), FOLD_FROM, FOLD_TO)


def _edge(inside: str) -> str:
    """A change between a word character and anything else (the text's ends count as else)."""
    return f"(?:(?<=[{inside}])(?![{inside}])|(?<![{inside}])(?=[{inside}]))"


def _letter(c: str) -> str:
    """One letter of a lower-case word, to be matched whatever the case."""
    if c in _VARIANTS:
        return _VARIANTS[c]
    if not c.isascii():
        return f"(?u:{c})"
    return c if c.isalnum() else f"\\x{ord(c):02x}"


def _word_pattern(word: str, boundary: str) -> str:
    """A whole word, case ignored.

    An ASCII word whose ends have no variants starts with its letters, so the
    look-arounds run only where the letters were found.
    """
    inside = CLASSES[boundary]
    letters = "".join(map(_letter, word))
    ends = word[0] + word[-1]
    if word.isascii() and not set(ends) & set(_VARIANTS) and ends.replace("_", "a").isalnum():
        return f"{letters}(?![{inside}])(?<![{inside}].{{{len(word)}}})"
    return f"{_edge(inside)}{letters}{_edge(inside)}"


def mask_with(text: Column | str, words: Sequence[str], boundary: str = "ascii") -> Column:
    """Mask known words, one after the other in the order given.

    Every pattern is a literal, compiled once per task; a text without any of
    the words is passed over by a single search.
    """
    cleaned = [w for w in (w.strip(WHITE_SPACE).lower() for w in words) if w]
    if not cleaned:
        return col(text)
    patterns = [_word_pattern(w, boundary) for w in cleaned]
    masked = col(text)
    for word, pattern in zip(cleaned, patterns):
        masked = F.regexp_replace(masked, F.lit(f"(?is){pattern}"), F.lit("*" * len(word)))
    present = F.rlike(col(text), F.lit("(?is)" + "|".join(patterns)))
    return F.when(present, masked).otherwise(col(text))


def mask_each(text: Column | str, words: Column | str, boundary: str = "ascii") -> Column:
    """Mask the words of an array column, one after the other in array order."""
    inside = CLASSES[boundary]
    edge = F.lit(_edge(inside))

    def letters(word: Column) -> Column:
        quoted = F.replace(word, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
        wide = F.regexp_replace(
            quoted, "([^\\x00-\\x7f\u017f\u212a]+)", "\\\\E(?u:\\\\Q$1\\\\E)\\\\Q"
        )
        s = F.regexp_replace(wide, "[s\u017f]", "\\\\E[s\u017f]\\\\Q")
        k = F.regexp_replace(s, "[k\u212a]", "\\\\E[k\u212a]\\\\Q")
        return F.concat(F.lit("\\Q"), k, F.lit("\\E"))

    def step(acc: Column, word: Column) -> Column:
        simple = F.rlike(word, F.lit("^[0-9a-jl-rt-z_]([\\x00-\\x7f]*[0-9a-jl-rt-z_])?$"))
        behind = F.concat(F.lit(f"(?![{inside}])(?<![{inside}].{{"), F.char_length(word), F.lit("})"))
        found = letters(word)
        pattern = F.when(simple, F.concat(found, behind)).otherwise(F.concat(edge, found, edge))
        masked = F.regexp_replace(
            acc, F.concat(F.lit("(?is)"), pattern), F.repeat(F.lit("*"), F.char_length(word))
        )
        return F.when(word == "", acc).otherwise(masked)

    cleaned = F.transform(_empty_if_null(words), normal_word)
    return F.aggregate(cleaned, col(text), step)


def _unicode_folded(text: Column | str) -> Column:
    """Equal for texts that are equal but for case, letter by letter, in any script."""
    # Without the step between, the optimizer takes lower(upper(x)) for lower(x).
    upper = F.translate(F.upper(F.translate(col(text), "\u0130", "i")), FOLD_FROM, FOLD_TO)
    return F.translate(F.lower(upper), "\u03c2" + FOLD_FROM, "\u03c3" + FOLD_TO)


def _unicode_runs(text: Column | str, between: bool) -> Column:
    """As :func:`runs`, with letters and digits of all scripts as word characters."""
    inside = CLASSES["unicode"]
    t = _unicode_folded(text)
    found = F.split(t, f"[^{inside}]+", -1)
    if between:
        found = F.concat(found, F.regexp_extract_all(t, F.lit(f"([^{inside}]+)"), F.lit(1)))
    return F.array_distinct(found)


def runs(text: Column | str, between: bool = True, boundary: str = "ascii") -> Column:
    """Distinct runs of word characters, in lower case, and of everything ``between`` them.

    A masked match starts and ends at an edge, so each run inside a word that
    matches is a whole run of the text.  The variant letters are no ASCII word
    characters but match some: there an edge may also lie inside a run, so the
    rare runs that hold one give every stretch between their possible edges.
    """
    if boundary == "unicode":
        return _unicode_runs(text, between)
    t = col(text)
    # Letters whose lower case is or holds an ASCII letter; their texts are taken apart first.
    odd = [F.contains(t, F.lit(c)) for c in FOLD_FROM + "\u0130"]

    def stretches(run: Column) -> Column:
        parts = F.regexp_extract_all(run, F.lit(f"([{FOLD_FROM}]+|[^{FOLD_FROM}]+)"), F.lit(1))
        count = F.size(parts).cast("int")
        return F.flatten(
            F.transform(
                F.sequence(F.lit(1), count),
                lambda i: F.transform(
                    F.sequence(i, count), lambda j: F.array_join(F.slice(parts, i, j - i + 1), "")
                ),
            )
        )

    pieces = F.regexp_extract_all(t, F.lit(f"([0-9A-Za-z_{FOLD_FROM}]+)"), F.lit(1))
    apart = F.transform(F.flatten(F.transform(pieces, stretches)), folded)
    plain = F.split(F.lower(t), "[^0-9a-z_]+", -1)
    inside = F.when(odd[0] | odd[1] | odd[2], apart).otherwise(plain)
    if not between:
        return F.array_distinct(inside)
    gaps = F.regexp_extract_all(t, F.lit(f"([^0-9A-Za-z_{FOLD_FROM}]+)"), F.lit(1))
    return F.array_distinct(F.concat(inside, F.transform(gaps, folded)))


def probe(word: Column | str, boundary: str = "ascii") -> Column:
    """The run of a word that texts are looked up by: its longest inner run."""
    w = _unicode_folded(word) if boundary == "unicode" else folded(word)
    letters = CLASSES["unicode"] if boundary == "unicode" else "0-9a-z_"
    inside = F.regexp_extract_all(w, F.lit(f"([{letters}]+)"), F.lit(1))
    longest = F.array_max(
        F.transform(inside, lambda r: F.struct(F.length(r).alias("n"), r.alias("r")))
    )["r"]
    return F.coalesce(longest, w)


def is_run(probed: Column | str, boundary: str = "ascii") -> Column:
    """Is this probe a run of word characters?"""
    letters = CLASSES["unicode"] if boundary == "unicode" else "0-9a-z_"
    return F.rlike(col(probed), F.lit(f"^[{letters}]+$"))


def listed_candidates(text: Column | str, words: Sequence[tuple[str, str]], boundary: str = "ascii") -> Column:
    """The words of a (word, probe) list that a text may contain, sorted.

    One hashed intersection of the text's runs with the probes, within the row.
    A word without any run of word characters that contains a star can match a
    text only after another mask; such words are always candidates.
    """
    ordered = sorted(words, key=lambda w: w[0].encode())
    word_runs = re.compile(r"\w+" if boundary == "unicode" else "[0-9a-z_]+")
    late = [w for w, p in ordered if not word_runs.fullmatch(p) and "*" in w]
    between = any(not word_runs.fullmatch(p) for _, p in ordered)
    probes = F.array(*[F.lit(p) for p in dict.fromkeys(p for _, p in ordered)])
    met = F.array_intersect(runs(text, between, boundary), probes)
    if all(w == p for w, p in ordered) and not late:
        return F.array_sort(met)
    pairs = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(p).alias("p")) for w, p in ordered])
    always = F.array(*map(F.lit, late)).cast("array<string>")

    def chosen(found: Column) -> Column:
        kept = F.filter(
            pairs, lambda s: F.array_contains(found, s["p"]) | F.array_contains(always, s["w"])
        )
        return F.transform(kept, lambda s: s["w"])

    return F.get(F.transform(F.array(met), chosen), F.lit(0))


def mask_listed(text: Column | str, words: Sequence[tuple[str, str]], boundary: str = "ascii") -> Column:
    """Mask a (word, probe) list, of which a text meets only the words it may contain."""
    if not words:
        return col(text)

    def masked(found: Column) -> Column:
        return F.when(F.size(found) == 0, col(text)).otherwise(mask_each(text, found, boundary))

    return F.get(F.transform(F.array(listed_candidates(text, words, boundary)), masked), F.lit(0))
