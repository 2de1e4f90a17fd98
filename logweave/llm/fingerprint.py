"""Document fingerprints: one-permutation MinHash in DataFrame functions only.

Every shingle is hashed once.  The top bits of the hash choose one of ``BINS`` bins
and a bin keeps its least hash.  An empty bin borrows from a full one by optimal
densification: each pair of bins has a fixed random priority, and the full bin with
the least priority lends.  Of every bin the ``BITS`` low-order bits are stored,
packed as hexadecimal.  Two fingerprints agree on a bin with probability
``J + (1 - J) / 2**BITS``; the likeness takes that bias out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.llm.rows import ranked
from logweave.plans.sizing import settled

BINS = 64
BITS = 8
SHINGLE = 5

_BIN_SHIFT = 64 - (BINS - 1).bit_length()
_DIGITS = BITS // 4


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def bin_of(h: Column) -> Column:
    return F.shiftrightunsigned(h, _BIN_SHIFT).cast("int")


def shingles(text: Column) -> Column:
    """Hashes of every run of ``SHINGLE`` words; a shorter text is one run, a blank one has none."""
    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def hashed(words: Column) -> Column:
        runs = F.transform(
            F.sequence(F.lit(0), F.size(words) - SHINGLE),
            lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(SHINGLE))),
        )
        short = F.when(F.size(words) > 0, F.array(F.xxhash64(words)))
        return F.when(F.size(words) >= SHINGLE, runs).otherwise(short)

    return let(words, hashed)


def least_by_bin(hashes: Column) -> Column:
    """The least hash of each bin that has one: sorted, the first after a change of bin."""

    def firsts(ordered: Column) -> Column:
        return F.filter(ordered, lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(ordered, i - 1))))

    return let(F.array_sort(hashes), firsts)


def densified(least: Column) -> Column:
    """All ``BINS`` bins in order, as ``BITS``-bit numbers; empty bins borrow."""

    def filled(full: Column) -> Column:
        low = F.transform(full, lambda h: h.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int"))

        def looked_up(held: Column, by_bin: Column) -> Column:
            def value(own: Column) -> Column:
                turns = F.transform(held, lambda other: F.struct(F.xxhash64(own, other), other.alias("bin")))
                return F.coalesce(F.try_element_at(by_bin, own), F.try_element_at(by_bin, F.array_min(turns)["bin"]))

            return F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), value)

        return let(F.transform(full, bin_of), lambda held: let(F.map_from_arrays(held, low), lambda m: looked_up(held, m)))

    return let(least, filled)


def fingerprint(text: Column) -> Column:
    """The packed fingerprint of a text; empty for a text without words (null included)."""
    bins = densified(least_by_bin(shingles(F.coalesce(text, F.lit("")))))
    digits = F.transform(bins, lambda b: F.lpad(F.lower(F.hex(b)), _DIGITS, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def likeness(one: Column, two: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets behind two fingerprints, 0 to 1.

    Without words on both sides it is 1, on one side 0.
    """
    same = F.aggregate(
        F.sequence(F.lit(0), F.lit(BINS - 1)),
        F.lit(0),
        lambda n, i: n
        + (F.substr(one, i * _DIGITS + 1, F.lit(_DIGITS)) == F.substr(two, i * _DIGITS + 1, F.lit(_DIGITS))).cast("int"),
    )
    chance = 1.0 / (1 << BITS)
    corrected = F.greatest((same / F.lit(float(BINS)) - F.lit(chance)) / F.lit(1 - chance), F.lit(0.0))
    return F.when(one == two, F.lit(1.0)).when((one == "") | (two == ""), F.lit(0.0)).otherwise(corrected)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``fingerprint`` of every row; null, empty and blank texts have an empty one."""
    return docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col).cast("string")).alias("fingerprint"))


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every row, of its edited text and of the next document, compared.

    The edited text has the last half (rounded down) of the code points replaced by
    as many of the next document's first ones, or all of them.  Documents follow one
    another by descending id, nulls last, and after the last comes the first.  Rows
    with the same id and text are one document here and get the same values; rows
    that only share an id follow one another by a hash of their text.  A null text
    counts as empty.  Texts of any length are fingerprinted whole, within their row; an
    empty table gives no rows, and other columns are not read.

    Columns: ``id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.  Texts are shuffled once,
    by document; the halves handed to the neighbours a second time.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # Of the type that it has when read back: a key of another nullability is cast in
    # joins, and rows dealt by the key itself would be dealt once more.
    read_back = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("mark", T.LongType())])
    key = F.struct(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark")).cast(read_back)
    rows = docs.select(key.alias("key"), text.alias("text"))
    ring = settled(rows.groupBy("key").agg(F.max(F.length("text")).cast("long").alias("n_chars")), "ring")
    ring = ranked(ring, [F.col("key.id").desc_nulls_last(), F.col("key.mark").desc()], "ring-order")
    after = F.pmod(F.col("rank") + 1, F.lit(max(1, ring.count())))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    readers = ring.select(F.col("key").alias("reader"), half.alias("half"), after.alias("rank"))
    asked = settled(readers.join(ring.select("rank", "key"), "rank").select("key", "reader", "half"), "ring-asked")
    texts = rows.groupBy("key").agg(F.any_value("text").alias("text"))
    tails = texts.join(asked, "key").select(
        F.col("reader").alias("key"), F.col("key").alias("next"), "half", F.expr("left(text, half)").alias("tail")
    )
    both = texts.join(tails, "key").select(
        "key",
        "next",
        "text",
        F.length("text").cast("long").alias("n_chars"),
        F.expr("concat(left(text, length(text) - half), tail)").alias("edited"),
    )
    marked = both.select(
        "key",
        "next",
        "n_chars",
        F.unhex(F.sha2("edited", 256)).alias("sha"),
        F.unhex(fingerprint(F.col("text"))).alias("own"),
        F.unhex(fingerprint(F.col("edited"))).alias("other"),
    )
    # Bytes until the end: half of what hexadecimal takes on the way.
    marked = settled(marked, "ring-marked")
    found = marked.join(marked.select(F.col("key").alias("next"), F.col("own").alias("after")), "next").drop("next")
    if rows.count() > marked.count():  # rows that repeat get their document's values
        found = rows.select("key").join(found, "key")

    def told(name: str) -> Column:
        return F.lower(F.hex(name))

    found = found.select(
        F.col("key.id").alias("id"),
        "n_chars",
        told("sha").alias("edited_sha256"),
        told("own").alias("fingerprint"),
        told("other").alias("edited_fingerprint"),
        told("after").alias("next_fingerprint"),
    )
    near = {
        "near_edited": likeness(F.col("fingerprint"), F.col("edited_fingerprint")),
        "near_next": likeness(F.col("fingerprint"), F.col("next_fingerprint")),
    }
    return found.withColumns(near).drop("next_fingerprint")
