"""Topic logs on files, and the same layout from a broker where the connector is present."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logweave import schemas
from logweave.plans import pieces


def read_log(
    spark: SparkSession,
    path: str,
    topics: Sequence[str] = (),
    schema: StructType = schemas.LOG,
    stream: bool = False,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Log rows from the earliest record; ``topics`` empty means all.

    A stream takes at most ``max_files`` files or ``max_bytes`` bytes a batch, but one file at least.
    """
    if stream:
        reader = spark.readStream.schema(schema)
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        if max_bytes:
            reader = reader.option("maxBytesPerTrigger", max_bytes)
        log = reader.parquet(path)
    else:
        log = spark.read.schema(schema).parquet(path)
    return log.filter(F.col("topic").isin(*topics)) if topics else log


def broker_options(
    servers: Sequence[str], topics: Sequence[str], max_offsets: int | None = None
) -> dict[str, str]:
    """Reader options: several topics, start at the earliest offset."""
    options = {
        "kafka.bootstrap.servers": ",".join(servers),
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_broker(spark: SparkSession, options: dict[str, str], stream: bool = True) -> DataFrame:
    """Log rows with text values from a broker (needs Spark's connector package)."""
    reader = spark.readStream if stream else spark.read
    log = reader.format("kafka").options(**options).load()
    return log.select(
        "topic",
        "partition",
        "offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "timestamp",
    )


def placed(
    records: DataFrame,
    partitions: int,
    position: str,
    rows_per_piece: int | None = None,
    partition: Column | None = None,
) -> DataFrame:
    """Records (topic, key, value, position) with partition by key and dense offsets."""
    by_key = F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int")
    spread = records.withColumn(
        "partition", by_key if partition is None else partition
    ).withColumn("__one", F.lit(1).cast("bigint"))
    split = pieces.cut(spread, ["topic", "partition"], position, rows_per_piece)
    counted = split.running_total([position], "__one", "__n").rows()
    return counted.withColumn("offset", F.col("__n") - 1).drop("__one", "__n")


def write_log(log: DataFrame, path: str) -> None:
    log.select(*schemas.LOG.names).write.mode("append").parquet(path)
