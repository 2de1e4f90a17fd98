"""Line dedup over sorted line hashes, told as one keep bitmap per document; DataFrame functions only.

Every line becomes two 64-bit hashes of its key, its document and its position.
The hashes are range-partitioned with a secondary sort by document (largest id
first) and position, so a scan of a piece meets a key's lines in one run whose
first document is the one that keeps them.  Only positions leave that scan, and
what a document gets back is a bitmap over its lines, 64 to a word, in which
stretches of words without a dropped line are only counted.

The key of a line is the line without white space at its ends, A-Z in lower
case.  A key with a large share of all lines is dealt over several runs by a hash of the
document; each run tells its documents and its largest id, and those few rows
are added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.fingerprint import let
from logweave.plans.sizing import settled

SPACES = " \t\n\x0b\x0c\r"
SHORTEST = 20
DOCUMENTS = 3
WORD = 64

# A key is dealt over runs of about this share of all lines; so at most RUNS keys are dealt.
RUNS = 10_000
# Leading bits of a hash that are counted to find the keys to deal.
_BUCKET_BITS = 20


def line_key(line: Column) -> Column:
    stripped = F.btrim(line, F.lit(SPACES))
    upper, lower = (bytes(range(first, first + 26)).decode() for first in (0x41, 0x61))
    ascii_only = F.octet_length(stripped) == F.char_length(stripped)
    return F.when(ascii_only, F.lower(stripped)).otherwise(F.translate(stripped, upper, lower))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``mark`` and ``text``: rows of one id and one text are told apart by nothing."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def line_hashes(rows: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """``h1``, ``h2``, ``id``, ``mark``, ``pos`` of every line whose key has ``shortest`` code points or more."""
    lines = rows.select("id", "mark", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keyed = lines.select("id", "mark", "pos", line_key(F.col("line")).alias("key"))
    long_enough = keyed.filter(F.char_length("key") >= shortest)
    return long_enough.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "id", "mark", "pos")


def hot_keys(hashes: DataFrame, runs: int = RUNS) -> DataFrame:
    """Keys with over one in ``runs`` of all lines, and how many runs each is dealt over.

    There are fewer than ``runs`` of them, however large the table.  Leading bits
    are counted first, so that only keys below a crowded prefix are counted.
    """
    most = F.lit(max(1.0, hashes.count() / runs))
    bucket = F.shiftrightunsigned("h1", 64 - _BUCKET_BITS)
    crowded = hashes.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
    crowded = settled(crowded.select("bucket"), "line-buckets")
    within = hashes.withColumn("bucket", bucket).join(F.broadcast(crowded), "bucket", "left_semi")
    counted = within.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
    return counted.select("h1", "h2", F.ceil(F.col("n") / most).cast("int").alias("runs"))


def dropped_lines(hashes: DataFrame, documents: int = DOCUMENTS, runs: int = RUNS) -> DataFrame:
    """``id``, ``mark``, ``pos`` of the lines that go; ``hashes`` is a settled table.

    Lines go whose key is in ``documents`` ids or more, but for those of the
    largest id that holds it.  Null is an id of its own and the least.
    """
    hot = F.broadcast(settled(hot_keys(hashes, runs), "line-hot"))
    run = F.coalesce(F.pmod(F.xxhash64("id"), F.col("runs")).cast("int"), F.lit(0))
    dealt = hashes.join(hot, ["h1", "h2"], "left").withColumn("run", run)
    # The window needs no exchange of its own: a range of (h1, h2, run) holds whole runs.
    placed = dealt.repartitionByRange("h1", "h2", "run")
    whole = Window.partitionBy("h1", "h2", "run")
    down = whole.orderBy(F.col("id").desc_nulls_last(), "mark", "pos")
    all_of_run = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    is_new = (F.row_number().over(down) == 1) | ~F.col("id").eqNullSafe(F.lag("id").over(down))
    seen = placed.withColumn("is_new", is_new.cast("int"))
    seen = seen.withColumn("turn", F.sum("is_new").over(down.rowsBetween(Window.unboundedPreceding, 0)))
    seen = seen.withColumn("held_by", F.max("turn").over(all_of_run))
    cold = F.col("runs").isNull()
    found = seen.filter(~cold | ((F.col("held_by") >= documents) & (F.col("turn") > 1)))
    found = settled(found.select("h1", "h2", "runs", "turn", "held_by", "id", "mark", "pos"), "line-runs")
    firsts = found.filter(~cold & (F.col("turn") == 1)).select("h1", "h2", "id", "held_by", "mark", "pos")
    # One row per run of a dealt key; a document is in one run, with all its lines.
    ends = firsts.groupBy("h1", "h2", F.struct("id").alias("one")).agg(F.max("held_by").alias("held_by"))
    ends = ends.groupBy("h1", "h2").agg(F.sum("held_by").alias("in_all"), F.max("one").alias("last"))
    ends = F.broadcast(settled(ends.filter(F.col("in_all") >= documents), "line-ends"))
    hot_lines = found.filter(~cold).join(ends, ["h1", "h2"]).filter(~F.col("id").eqNullSafe(F.col("last.id")))
    lines = ["id", "mark", "pos"]
    return found.filter(cold).select(*lines).union(hot_lines.select(*lines))


def bitmaps(lines: DataFrame) -> DataFrame:
    """Per document ``n_dropped`` and ``keep``: (skip, bits) per word of 64 lines with a dropped one.

    ``skip`` counts the words before it in which every line stays; in ``bits``, bit
    k is set if line k of the word stays.  After the last word every line stays.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos") % WORD)
    words = lines.groupBy("id", "mark", F.floor(F.col("pos") / WORD).cast("int").alias("word"))
    words = words.agg(F.bit_or(bit).alias("gone"))
    per_doc = words.groupBy("id", "mark").agg(
        F.sum(F.bit_count("gone")).alias("n_dropped"),
        F.array_sort(F.collect_list(F.struct("word", F.bitwise_not("gone").alias("bits")))).alias("words"),
    )

    def skipped(words: Column) -> Column:
        def one(w: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(words, i - 1)["word"]).otherwise(F.lit(-1))
            return F.struct((w["word"] - before - 1).alias("skip"), w["bits"].alias("bits"))

        return F.transform(words, one)

    return per_doc.select("id", "mark", "n_dropped", let(F.col("words"), skipped).alias("keep"))


def kept_text(text: Column, keep: Column) -> Column:
    """The lines of ``text`` whose bit is set in ``keep``, joined by a line feed."""
    filled = F.flatten(
        F.transform(keep, lambda w: F.concat(F.array_repeat(F.lit(-1).cast("long"), w["skip"]), F.array(w["bits"])))
    )

    def stays(bits: Column) -> Column:
        def set_bit(_: Column, i: Column) -> Column:
            word = F.coalesce(F.get(bits, F.floor(i / WORD).cast("int")), F.lit(-1).cast("long"))
            return F.getbit(word, i % WORD) == 1

        return F.filter(F.split(text, "\n"), set_bit)

    return F.when(keep.isNull(), text).otherwise(F.array_join(let(filled, stays), "\n"))


def _judged(rows: DataFrame, shortest: int, documents: int, runs: int) -> DataFrame:
    hashes = settled(line_hashes(rows, shortest), "line-hashes")
    return settled(bitmaps(dropped_lines(hashes, documents, runs)), "line-bitmaps")


def _with_bitmaps(rows: DataFrame, found: DataFrame) -> DataFrame:
    found = found.select(F.col("id").alias("of"), F.col("mark").alias("of_mark"), "n_dropped", "keep")
    on = F.col("id").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("of_mark"))
    joined = rows.join(found, on, "left")
    return joined.withColumn("n_dropped", F.coalesce("n_dropped", F.lit(0)).cast("long")).drop("of", "of_mark")


def keep_bitmaps(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shortest: int = SHORTEST,
    documents: int = DOCUMENTS,
    runs: int = RUNS,
) -> DataFrame:
    """``id``, ``n_lines``, ``n_dropped`` and ``keep`` of every row of ``docs``, without its text.

    A key of ``shortest`` code points or more that is found in ``documents`` ids or
    more loses its lines, all but those of the largest id that holds it.  ``keep``
    is null where every line stays; its form is that of :func:`bitmaps`.

    Null and empty texts are one empty line, which stays.  Rows that share an id
    are one document: they count once, and if it is the largest, all its rows keep
    their lines.  Null ids are one document, the least.  Texts may be of any
    length: a bitmap has one word per 64 lines at most.  Other columns are not read.
    """
    rows = _rows(docs, id_col, text_col)
    counted = rows.select("id", "mark", F.size(F.split("text", "\n")).cast("long").alias("n_lines"))
    return _with_bitmaps(counted, _judged(rows, shortest, documents, runs)).drop("mark")


def dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shortest: int = SHORTEST,
    documents: int = DOCUMENTS,
    runs: int = RUNS,
) -> DataFrame:
    """As :func:`keep_bitmaps`, with ``kept``, the lines that stay joined by a line feed.

    Texts are moved once, to their bitmaps.  A document all of whose lines go has
    the empty text.
    """
    rows = _rows(docs, id_col, text_col)
    counted = rows.withColumn("n_lines", F.size(F.split("text", "\n")).cast("long"))
    found = _with_bitmaps(counted, _judged(rows, shortest, documents, runs))
    return found.select("id", "n_lines", "n_dropped", "keep", kept_text(F.col("text"), F.col("keep")).alias("kept"))
