"""Operators over topic logs: (topic, partition, offset, key, value, timestamp)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.functions.text import col
from logweave.plans import pieces, sizing

# Log names, archive folders, key rules.
MIRRORED_TOPICS = ("products.filtered", "client.events")
MIRROR_PREFIX = "primary."
ROUTES = (("products.filtered", "products"), ("client.events", "client-events"))
OTHER_ROUTE = "unknown"
KEY_RULES = {
    "products.raw": ("product_id",),
    "products.filtered": ("product_id",),
    "client.events": ("user_id",),
    "recommendations": ("user_id", "product_id"),
    "messages": ("recipient_id",),
    "censored_messages": ("recipient_id",),
    "filtered_messages": ("recipient_id",),
    "blocked_users": ("user_id",),
    "orders": ("customer_id",),
    "notices": ("event_id",),
}


def archive_folder(topic: Column | str) -> Column:
    """Folder by the ending of the topic name, so prefixed copies share it."""
    t = col(topic)
    chosen = F.when(F.endswith(t, F.lit(ROUTES[0][0])), F.lit(ROUTES[0][1]))
    for ending, folder in ROUTES[1:]:
        chosen = chosen.when(F.endswith(t, F.lit(ending)), F.lit(folder))
    return chosen.otherwise(F.lit(OTHER_ROUTE))


def mirror(
    log: DataFrame, topics: Sequence[str] = MIRRORED_TOPICS, prefix: str = MIRROR_PREFIX
) -> DataFrame:
    """Copy of the listed topics under prefixed names."""
    return log.filter(F.col("topic").isin(*topics)).withColumn(
        "topic", F.concat(F.lit(prefix), "topic")
    )


def merged(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Several topics as one log."""
    for other in others:
        first = first.unionByName(other)
    return first


def keyed_json(
    records: DataFrame,
    topic: str,
    key: Sequence[str] | None = None,
    omit_empty: Sequence[str] = (),
) -> DataFrame:
    """Records as (topic, key, value) for a log, keyed by the rule of the topic."""
    parts = key or KEY_RULES[topic]
    fields = [
        F.nullif(F.col(c), F.lit("")).alias(c) if c in omit_empty else F.col(c)
        for c in records.columns
    ]
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in parts])
    return records.select(
        F.lit(topic).alias("topic"), name.alias("key"), F.to_json(F.struct(*fields)).alias("value")
    )


def topic_offsets(log: DataFrame) -> DataFrame:
    """End offsets summed over the partitions of each topic."""
    ends = log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    return ends.groupBy("topic").agg(F.sum("end_offset").alias("total_offsets"))


def consumer_lag(log: DataFrame, commits: DataFrame) -> DataFrame:
    """End offset less committed offset; a partition never committed lags in full.

    ``commits`` has group, topic, partition, committed.  Groups and partitions
    are few, records many: the log is aggregated first.
    """
    ends = log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    groups = commits.select("group", "topic").distinct()
    expected = groups.join(ends, "topic")
    current = commits.groupBy("group", "topic", "partition").agg(F.max("committed").alias("committed"))
    joined = expected.join(current, ["group", "topic", "partition"], "left")
    committed = F.coalesce("committed", F.lit(0).cast("bigint"))
    return joined.select(
        "group",
        "topic",
        "partition",
        "end_offset",
        committed.alias("committed"),
        (F.col("end_offset") - committed).alias("lag"),
    )


def batch_gate(
    log: DataFrame,
    is_bad: Column,
    size: int = 10,
    rows_per_piece: int | None = None,
    keys: Sequence[str] = ("topic", "partition"),
    opened: DataFrame | None = None,
) -> DataFrame:
    """Batches of ``size`` records in arrival order; one bad record blocks its commit.

    Offsets may have gaps, so records are counted, not divided by offset.
    ``full`` is false for a short last batch.  ``opened`` has the short last batches
    of the records before these, in this form: they are filled up first.  One without
    records says at which number to go on.
    """
    ones = log.withColumn("__one", F.lit(1).cast("bigint"))
    split = pieces.cut(ones, keys, "offset", rows_per_piece)
    counted = split.running_total(["offset"], "__one", "__n").rows()
    counts = ("rows", "bad", "first_offset", "last_offset")
    if opened is not None:
        before = opened.select(*keys, F.col("batch").alias("__batch"), F.col("rows").alias("__rows"))
        counted = _beside(counted, sizing.small_side(before), keys)
    at = F.col("__n") - 1 + (F.lit(0) if opened is None else F.coalesce("__rows", F.lit(0)))
    first = F.lit(0) if opened is None else F.coalesce("__batch", F.lit(0))
    found = (
        counted.withColumn("batch", (F.floor(at / size) + first).cast("bigint"))
        .groupBy(*keys, "batch")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(is_bad).alias("bad"),
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
        )
    )
    if opened is not None:
        both = found.unionByName(opened.filter("rows > 0").select(*keys, "batch", *counts))
        found = both.groupBy(*keys, "batch").agg(
            F.sum("rows").alias("rows"),
            F.sum("bad").alias("bad"),
            F.min("first_offset").alias("first_offset"),
            F.max("last_offset").alias("last_offset"),
        )
    return found.withColumn("commit", F.col("bad") == 0).withColumn("full", F.col("rows") == size)


def _beside(rows: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Null-safe left join on ``keys``."""
    renamed = other.withColumnsRenamed({k: f"__k_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    return rows.join(renamed, same, "left").drop(*(f"__k_{k}" for k in keys))


def first_records(log: DataFrame, count: int) -> DataFrame:
    """Stop after ``count`` records, 0 meaning all."""
    if count == 0:
        return log
    return log.orderBy("timestamp", "topic", "partition", "offset").limit(count)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, "object"]:
    """The same rows with a row counter that is filled by the action that runs them."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def ready(files: DataFrame, datasets: Sequence[str], column: str = "dataset") -> DataFrame:
    """One row per required dataset: how many files it has and whether that is enough."""
    found = files.groupBy(F.col(column).alias("__d")).agg(
        F.count_distinct("file").alias("files")
    )
    wanted = files.sparkSession.createDataFrame([(d,) for d in datasets], "dataset string")
    return wanted.join(found, F.col("dataset") == F.col("__d"), "left").select(
        "dataset",
        F.coalesce("files", F.lit(0)).alias("files"),
        (F.coalesce("files", F.lit(0)) > 0).alias("ready"),
    )
