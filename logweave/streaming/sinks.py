"""Stream sinks whose replays are harmless.

A micro-batch writes its own ``batch=<id>`` folder and overwrites it when it is
replayed, so at-least-once delivery leaves no duplicates.  Tables kept by key
are stored as small per-batch deltas over a base and merged when read, so a
batch never rewrites the table; :func:`fold` makes a new base now and then.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from logweave.operators import keyed, logs
from logweave.plans.sizing import settled
from logweave.sources import tables

# Deltas of a state table that are read before they are folded into a base.
FOLD_EVERY = 8

Writer = Callable[[DataFrame, int], None]


def run(
    stream: DataFrame,
    checkpoint: str,
    path: str | None = None,
    writer: Writer | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a stream into the exactly-once file sink or into a batch writer.

    The default trigger reads everything there is and stops; pass
    ``{"processingTime": "5 seconds"}`` to keep going.
    """
    out = stream.writeStream.option("checkpointLocation", checkpoint)
    out = out.trigger(**(trigger or {"availableNow": True}))
    if writer is not None:
        return out.foreachBatch(writer).start()
    if partition_by:
        out = out.partitionBy(*partition_by)
    return out.format(fmt).option("path", path).outputMode("append").start()


def folder_writer(path: str, fmt: str = "parquet", change: Callable[[DataFrame], DataFrame] | None = None) -> Writer:
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if change is None else change(batch)
        rows.write.mode("overwrite").format(fmt).save(f"{path}/batch={batch_id}")

    return write


def upsert_writer(path: str, keys: Sequence[str], arrival: Sequence[str]) -> Writer:
    """Per batch the last arrival of each key."""
    return folder_writer(path, change=lambda batch: keyed.latest(batch, keys, arrival))


def read_table(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], arrival: Sequence[str]
) -> DataFrame:
    """The table behind :func:`upsert_writer`: newest batch, then last arrival, per key."""
    stored = StructType([*schema.fields, StructField("batch", LongType())])
    rows = spark.read.schema(stored).parquet(path)
    return keyed.latest(rows, keys, ["batch", *arrival]).drop("batch")


def fold(
    spark: SparkSession,
    path: str,
    target: str,
    schema: StructType,
    keys: Sequence[str],
    arrival: Sequence[str],
) -> None:
    """All deltas as one base at ``target`` (batch -1, older than any later delta)."""
    table = read_table(spark, path, schema, keys, arrival)
    table.write.mode("overwrite").parquet(f"{target}/batch=-1")


_OPEN = "topic string, partition int, batch bigint, rows bigint, bad bigint, first_offset bigint, last_offset bigint"


def gate_writer(
    good: str, quarantine: str, report: str, is_bad: Column, size: int = 10, rows_per_piece: int | None = None
) -> Writer:
    """Good records, bad records and the full batches of one micro-batch.

    A record whose verdict is null is bad.  The batch that a micro-batch leaves
    unfinished is kept, per topic and partition, in a table below ``report`` and
    filled up by the next, so batches are the same however the log was cut.
    :func:`close_gate` reports the ones still open at the end.
    """
    is_bad = F.coalesce(is_bad, F.lit(True))

    def write(batch: DataFrame, batch_id: int) -> None:
        open_batches = _open_batches(batch.sparkSession, report)
        batch = batch.persist()
        try:
            here = f"batch={batch_id}"
            batch.filter(~is_bad).write.mode("overwrite").parquet(f"{good}/{here}")
            batch.filter(is_bad).write.mode("overwrite").parquet(f"{quarantine}/{here}")
            now = open_batches.current()
            if now.done >= batch_id:
                return
            opened = open_batches.read(now)
            found = settled(logs.batch_gate(batch, is_bad, size, rows_per_piece, opened=opened), "gate")
            found.filter("full").write.mode("overwrite").parquet(f"{report}/full/micro_batch={batch_id}")
            last = found.groupBy("topic", "partition").agg(F.max_by(F.struct("*"), "batch").alias("last")).select("last.*")
            # Where the last batch is full, the next begins empty.
            next_empty = {"batch": F.col("batch") + 1, "rows": F.lit(0), "bad": F.lit(0)}
            next_empty |= {c: F.lit(None) for c in ("first_offset", "last_offset")}
            after = last.withColumns({c: F.when(F.col("full"), v).otherwise(F.col(c)) for c, v in next_empty.items()})
            open_batches.add(after, batch_id)
            if len(open_batches.current().deltas) >= FOLD_EVERY:
                open_batches.fold()
        finally:
            batch.unpersist()

    return write


def _open_batches(spark: SparkSession, report: str) -> tables.Table:
    return tables.table(spark, f"{report}/open", _OPEN, ["topic", "partition"])


def close_gate(spark: SparkSession, report: str) -> DataFrame:
    """The whole report at the end of a log: the full batches, and the short last ones."""
    opened = _open_batches(spark, report).read().filter("rows > 0")
    short = opened.withColumn("commit", F.col("bad") == 0).withColumn("full", F.lit(False))
    full = spark.read.schema(f"{_OPEN}, commit boolean, full boolean").parquet(f"{report}/full")
    return full.select(*short.columns).unionByName(short)


def insert_ignore_writer(path: str, keys: Sequence[str], arrival: Sequence[str]) -> Writer:
    """Per batch the first arrival of each key; :func:`read_first` ignores it if a batch before had the key."""
    return folder_writer(path, change=lambda batch: keyed.first(batch, keys, arrival))


def read_first(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], arrival: Sequence[str]
) -> DataFrame:
    """The table behind :func:`insert_ignore_writer`: oldest batch, then first arrival, per key."""
    stored = StructType([*schema.fields, StructField("batch", LongType())])
    rows = spark.read.schema(stored).parquet(path)
    return keyed.first(rows, keys, ["batch", *arrival]).drop("batch")


def first_requests(stream: DataFrame, key: str = "request_id", ts: str = "requested_at", delay: str = "1 hour") -> DataFrame:
    """Repeats within the delay are left out, with bounded state; a key seen again later passes again.

    :func:`insert_ignore_writer` never inserts a key twice.
    """
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
