"""Rows that can be found again: where a row lies in its file, and its rank in an order."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.plans.sizing import settled, small_side

FILE, AT = "_row_file", "_row_at"
_PIECE_BITS = 33  # monotonically_increasing_id: partition above, row below


def in_files(df: DataFrame, label: str) -> DataFrame:
    """``df`` read straight from Parquet files, so that every row has a file and a position.

    A table that is not such a read is written to the shared scratch folder first.
    """
    if "_metadata" not in df.columns:
        try:
            df.select("_metadata.file_path", "_metadata.row_index")
            return df
        except AnalysisException:
            pass
    plain = df.drop("_metadata")
    return settled(plain.select(*(plain[c].cast("string") if t == "void" else plain[c] for c, t in plain.dtypes)), label)


def located(df: DataFrame, *columns: Column | str) -> DataFrame:
    """``columns`` of a table from :func:`in_files`, with the content locator of each row.

    The locator tells rows apart even if they repeat whole, ids included.
    """
    return df.select(*columns, F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(AT))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def with_locator(docs: DataFrame) -> tuple[DataFrame, str]:
    """All columns of a table from :func:`in_files` and a struct that locates each row, under the name told."""
    name = free_name(docs, "_locator")
    place = F.struct(F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(AT))
    return docs.select(*(F.col(f"`{c}`") for c in docs.columns), place.alias(name)), name


def without(docs: DataFrame, gone: DataFrame, label: str) -> DataFrame:
    """The rows of a table from :func:`in_files` whose locator is not in ``gone``, with all their columns."""
    rows, name = with_locator(docs)
    listed = small_side(settled(gone.select(F.struct(FILE, AT).alias(name)), label))
    return rows.join(listed, name, "left_anti").drop(name)


def ranked(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """``df`` with ``rank``, its 0-based place in ``order`` over the whole table.

    A range partitioning sorts the rows over many tasks, cut at quantiles of the
    whole order, so a hot leading key is cut by the columns after it.  The sorted
    pieces are written once; a piece's offset is the number of rows before it.
    Only one count per piece is summed in order and sent to all tasks: as many
    rows as there are partitions, whatever the data.  Rows equal in all of
    ``order`` are ranked in any order.
    """
    pieces = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    pieces = settled(pieces, label)
    piece = F.shiftright("_slot", _PIECE_BITS)
    counts = pieces.groupBy(piece.alias("_piece")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_piece", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.col("_slot").bitwiseAND(F.lit((1 << _PIECE_BITS) - 1))
    return (
        pieces.withColumn("_piece", piece)
        .join(F.broadcast(starts), "_piece")
        .withColumn("rank", F.col("_start") + within)
        .drop("_piece", "_start", "_slot")
    )
