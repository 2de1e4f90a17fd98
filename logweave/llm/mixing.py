"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Every document of a source is expected ``target / source size`` times in the mix.
Those expectations are summed in order within the source, one random offset per
source is added, and a document is emitted once per integer boundary that its
stretch of the sum crosses.  The order is by size, which makes the sample
stratified: the words taken differ from the target by about one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.rows import AT, FILE, free_name, in_files, located, ranked, with_locator
from logweave.plans.sizing import settled

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"
MOST_COPIES = 3
WEIGHTS = (1, 2, 3)


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def offset(source: Column, seed: str = SEED) -> Column:
    """The source's random offset in [0, 1), the same on every run."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("n")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def targets(sizes: DataFrame) -> DataFrame:
    """Per source its size, number of documents, first rank and target.

    Weights repeat ``WEIGHTS`` over the sources by code point, null last.  A target
    is the weight's share of all sizes but at most ``MOST_COPIES`` times the
    source's size; the excess goes to the others by weight until none is above.
    That limit is closed: in the order of size over weight the capped sources come
    first, up to the first whose share of what is left is below its cap.  The
    windows see one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    before = by_name.rowsBetween(Window.unboundedPreceding, -1)
    place = F.row_number().over(by_name)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((place - 1) % len(WEIGHTS) + 1).cast("int"))
    listed = per_source.select(
        "*",
        place.alias("place"),
        weight.cast("long").alias("weight"),
        F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("first_rank"),
        (MOST_COPIES * F.col("source_size")).alias("cap"),
    )
    everything = Window.partitionBy()
    by_need = Window.orderBy(F.col("cap").cast("double") / F.col("weight"), "place")
    below = by_need.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(below), F.lit(0))
    weights_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(below), F.lit(0))
    capped = F.col("cap").cast("double") * weights_left.cast("double") <= F.col("weight").cast("double") * left.cast(
        "double"
    )
    marked = listed.withColumn("capped", capped)
    rest = F.sum("source_size").over(everything) - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(
        everything
    )
    rest_weight = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(everything)
    share = F.col("weight").cast("double") * (rest.cast("double") / F.nullif(rest_weight, F.lit(0)).cast("double"))
    return marked.select(
        "source",
        "source_size",
        "first_rank",
        F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Every row of ``docs`` with ``size``, its source's ``source_size`` and ``target``, and ``copies``.

    A null or blank text has size 0 and adds no words; an empty source has target
    0 and is not drawn.  Rows that repeat whole are drawn each for itself.  Null
    ids come first within a size.  A text of any length is one document, taken whole
    or not at all.  Of rows equal in source, size and id the locator decides the order.
    An empty table gives no rows, and other columns are not read.
    """
    docs = in_files(docs, "mix-docs")
    sizes = located(
        docs, F.col(id_col).alias("id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size")
    )
    sizes = settled(sizes, "mix-sizes")
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("id"), F.col(FILE), F.col(AT)]
    placed = ranked(sizes, order, "mix-order")
    aims = targets(sizes).withColumn("key", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))
    placed = placed.withColumn("key", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))
    found = placed.join(aims.drop("source"), "key")
    expected = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)).cast("double"), F.lit(0.0))
    place = (F.col("rank") - F.col("first_rank")).cast("double")
    start = offset(F.col("source"))
    crossed = F.floor(expected * (place + 1) + start) - F.floor(expected * place + start)
    return found.select(
        "id",
        "source",
        "size",
        "source_size",
        "target",
        F.least(crossed, F.lit(MOST_COPIES)).cast("long").alias("copies"),
        FILE,
        AT,
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every row of ``docs`` with all its columns, as often as it is drawn."""
    docs = in_files(docs, "mix-docs")
    rows, name = with_locator(docs)
    copy = free_name(rows, "_copy_number")
    drawn = mixed(docs, id_col, text_col, source_col).filter("copies > 0")
    drawn = drawn.select(F.struct(FILE, AT).alias(name), F.expr("sequence(1L, copies)").alias(copy))
    return rows.join(drawn, name).withColumn(copy, F.explode(copy)).drop(name, copy)
