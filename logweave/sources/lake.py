"""Files: JSON Lines tables, control files, result folders, archives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logweave import schemas
from logweave.functions import records
from logweave.functions.text import trimmed
from logweave.operators import logs
from logweave.operators.changelog import ADD
from logweave.operators.validate import product_error
from logweave.plans.sizing import settled, small_side

# Fixed value: a line of this many bytes or more is refused.
MAX_LINE_BYTES = 4 * 1024 * 1024


def read_json_lines(
    spark: SparkSession, paths: str | Sequence[str], schema: StructType, stream: bool = False
) -> DataFrame:
    """JSON Lines below a folder or glob, always with a declared schema."""
    if stream:
        return spark.readStream.schema(schema).json(paths)
    return spark.read.schema(schema).json(paths)


def product_lines(lines: DataFrame, on_error: str = "fail"):
    """Text lines (column ``value``) as checked product records keyed by product_id.

    Blank lines are skipped.  ``on_error`` is one of the policies of
    :func:`logweave.functions.records.apply_policy`.
    """
    filled = lines.filter(trimmed("value") != "")
    decoded = records.decode(filled, schemas.PRODUCT)
    reason = (
        F.when(F.octet_length("value") >= MAX_LINE_BYTES, F.lit("line is too long"))
        .when(F.col("reject_reason").isNotNull(), F.col("reject_reason"))
        .otherwise(
            product_error("record.product_id", "record.name", "record.price.amount", "record.store_id")
        )
    )
    judged = decoded.withColumn("reject_reason", reason).withColumn("key", F.col("record.product_id"))
    return records.apply_policy(judged, on_error)


def numbered_lines(spark: SparkSession, path: str | Sequence[str], one_log: bool = False) -> DataFrame:
    """Text lines (``value``) with their ``file`` and ``line``, the number in that file from 1.

    With ``one_log`` the files are one text in the order of their names, and lines are
    numbered through all of them.

    A file is read in splits by many tasks.  A first scan counts the lines of every
    split; sums of those counts, one row per split, say at which number each begins,
    and within a split lines come in order.  Both scans are of one list of files; if
    they were split differently, because the cluster grew in between, the job fails.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__at"),
    )
    splits = lines.groupBy("file", "__block").agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("__first"))
    # One row per split, in one task only where all splits are one text.
    before = Window.orderBy("file", "__block") if one_log else Window.partitionBy("file").orderBy("__block")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("__before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    found = lines.join(small_side(starts), ["file", "__block"], "left")
    number = F.col("__before") + F.col("__at") - F.col("__first") + 1
    told = F.coalesce(number, F.raise_error(F.lit("a file was split differently")).cast("bigint"))
    return found.select("value", "file", told.alias("line"))


def read_products(spark: SparkSession, path: str, on_error: str = "fail"):
    """Product file scan; every row has its file and line, blank lines counted.

    Beside the policies of :func:`logweave.functions.records.apply_policy` there is
    ``stop``: a pair of the rows before the first bad line of each file, and those bad
    lines.
    """
    if on_error != "stop":
        return product_lines(numbered_lines(spark, path), on_error)
    judged = product_lines(numbered_lines(spark, path), "raw")
    bad = judged.filter(F.col("reject_reason").isNotNull())
    first = bad.groupBy("file").agg(F.min_by(F.struct("line", "value", "reject_reason"), "line").alias("bad"))
    first = small_side(settled(first.select("file", "bad.*"), "first-bad"))
    ends = first.select("file", F.col("line").alias("__end"))
    before = judged.join(ends, "file", "left").filter(F.col("__end").isNull() | (F.col("line") < F.col("__end")))
    return before.drop("__end", "reject_reason"), first


def read_deny_file(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of (product_id, reason) as one ``add`` command each, stamped now."""
    rows = spark.read.option("multiLine", True).schema(schemas.DENY_FILE_ROW).json(path)
    return rows.select(
        F.lit(ADD).alias("action"),
        "product_id",
        "reason",
        F.current_timestamp().alias("updated_at"),
    )


def read_results(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Only the files of a result folder whose names start with ``part-``."""
    return spark.read.option("pathGlobFilter", "part-*").schema(schema).json(folder)


def read_keyed_text(spark: SparkSession, path: str, one_log: bool = False) -> DataFrame:
    """Lines ``key<TAB>json`` with their file and number; blank lines and ``#`` comments are skipped."""
    parts = F.split("value", "\t", 2)
    return (
        numbered_lines(spark, path, one_log)
        .filter((trimmed("value") != "") & ~F.startswith("value", F.lit("#")))
        .select(
            parts[0].alias("key"),
            F.get(parts, F.lit(1)).alias("value"),
            "file",
            F.col("line").alias("row_order"),
        )
    )


def write_json(df: DataFrame, path: str) -> None:
    """Replace a JSON result folder: one write, one run of the plan."""
    df.write.mode("overwrite").json(path)


def write_lines(log: DataFrame, path: str) -> None:
    """Append the values of a log as text lines."""
    log.select("value").write.mode("append").text(path)


def archive_lines(log: DataFrame) -> DataFrame:
    return log.select(logs.archive_folder("topic").alias("dataset"), "value")


def write_archive(log: DataFrame, path: str, mode: str = "append") -> None:
    """JSON Lines per dataset folder, large files rather than one per record."""
    archive_lines(log).write.mode(mode).partitionBy("dataset").text(path)


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """(dataset, file) of an archive, for the readiness check; contents are not read."""
    return spark.read.format("binaryFile").load(path).select("dataset", F.col("path").alias("file"))


def move_folder(spark: SparkSession, folder: str, to: str) -> None:
    """Rename a folder of finished files, so that whoever lists ``to``'s parent sees them all at once."""
    here, there = (spark._jvm.org.apache.hadoop.fs.Path(path) for path in (folder, to))
    files = here.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(there.getParent())
    if not files.rename(here, there):
        raise OSError(f"cannot move {folder} to {to}")
