"""Exact dedup: a stateful stream over content digests, hits confirmed on full bytes.

The stream's state is one row per digest in the disk-backed RocksDB store and
never expires: the digest, how often it came, the content locator (file and row)
of its first bearer, and the stable identifier that stays (the largest id, then
the last locator).  Counts and extremes are combined before the shuffle, so a
digest borne by a third of all rows costs one state row per task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.rows import AT, FILE, in_files, located, without
from logweave.plans.sizing import settled, small_side
from logweave.session import ROCKSDB, scratch_dir

# Copies compared with one replica of their representative's text.
COPIES_PER_REPLICA = 256

# Many small stores: none may reserve space on disk ahead of its rows.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _whole(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def digest_states(stream: DataFrame) -> DataFrame:
    """The stateful step: one state row per digest, without a watermark and so without expiry.

    ``stream`` has ``digest``, ``id`` and the locator.  In update mode each
    micro-batch gives the changed states: ``copies``, the locator ``first`` of
    the representative and ``last``, the row that stays so far.
    """
    locator = F.struct(FILE, AT)
    return stream.groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"),
        F.min(locator).alias("first"),
        F.max(F.struct(F.col("id"), F.col(FILE), F.col(AT))).alias("last"),
    )


def _streamed_states(arrivals: DataFrame, path: str, files_per_trigger: int) -> DataFrame:
    spark = arrivals.sparkSession
    out = scratch_dir(spark, "digest-states")

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    try:
        stream = (
            spark.readStream.schema(arrivals.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
        )
        states = digest_states(stream)
        (
            states.writeStream.outputMode("update")
            .option("checkpointLocation", scratch_dir(spark, "digest-checkpoint"))
            .trigger(availableNow=True)
            .foreachBatch(write)
            .start()
            .awaitTermination()
        )
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    schema = states.schema.add("batch", "long")
    changed = spark.createDataFrame([], schema) if not _batches(arrivals) else spark.read.schema(schema).parquet(out)
    return changed.groupBy("digest").agg(
        F.max("copies").alias("copies"), F.min("first").alias("first"), F.max("last").alias("last")
    )


def _batches(arrivals: DataFrame) -> bool:
    return not arrivals.isEmpty()


def _collided(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """Digests under which some row's bytes differ from the representative's.

    The representative's text is replicated per ``COPIES_PER_REPLICA`` copies and
    the copies are spread over the replicas, so that no group meets in one task.
    """
    replicas = F.floor((F.col("copies") - 1) / COPIES_PER_REPLICA).cast("int") + 1
    bearers = rows.join(hits, "digest").withColumn("replicas", replicas)
    chosen = bearers.filter(F.struct(FILE, AT) == F.col("first")).select(
        "digest", F.col("text").alias("chosen"), F.explode(F.sequence(F.lit(0), F.col("replicas") - 1)).alias("salt")
    )
    others = bearers.filter(F.struct(FILE, AT) != F.col("first")).select(
        "digest", "text", F.pmod(F.xxhash64(FILE, AT), F.col("replicas")).cast("int").alias("salt")
    )
    return others.join(chosen, ["digest", "salt"]).filter("text <> chosen").select("digest").distinct()


def groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    files_per_trigger: int = 256,
) -> DataFrame:
    """Every row of ``docs`` (a table from :func:`rows.in_files`) with its group of equal texts.

    Columns: ``id``, ``digest``, ``keep_id`` (id of the row that stays: the
    largest id, nulls least, then the last locator), ``group_size``, ``kept`` and
    the row's locator.  A null text counts as empty; empty texts are equal to one
    another; of rows that repeat whole, ids included, exactly one stays.  Texts
    that share a digest but differ in bytes are grouped by their bytes.  Texts of any
    length are digested and compared whole.  An empty table gives no rows, and other
    columns are not read.  State lives as long as the run: a second run starts anew.
    """
    text = _whole(text_col)
    rows = located(docs, F.col(id_col).alias("id"), digest(text).alias("digest"), text.alias("text"))
    path = scratch_dir(docs.sparkSession, "digest-arrivals")
    rows.drop("text").write.parquet(path)
    arrivals = docs.sparkSession.read.schema(rows.drop("text").schema).parquet(path)
    states = settled(_streamed_states(arrivals, path, files_per_trigger), "digest-final")
    hits = small_side(states.filter("copies > 1"))
    collided = settled(_collided(rows, hits.select("digest", "copies", "first")), "digest-collided")
    row = F.struct(F.col("id"), F.col(FILE), F.col(AT))

    def decided(found: DataFrame) -> DataFrame:
        lone = F.col("copies").isNull()
        return found.select(
            "id",
            "digest",
            F.when(lone, F.col("id")).otherwise(F.col("last.id")).alias("keep_id"),
            F.coalesce("copies", F.lit(1)).cast("long").alias("group_size"),
            (lone | row.eqNullSafe(F.col("last"))).alias("kept"),
            FILE,
            AT,
        )

    if collided.isEmpty():
        return decided(arrivals.join(hits.select("digest", "copies", "last"), "digest", "left"))
    split = rows.join(collided, "digest")
    by_bytes = split.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("copies"), F.max(row).alias("last"))
    apart = decided(split.join(by_bytes, ["digest", "text"]))
    plain = arrivals.join(collided, "digest", "left_anti")
    return decided(plain.join(hits.select("digest", "copies", "last"), "digest", "left")).unionByName(apart)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``digest``, ``keep_id``, ``group_size``, ``kept``."""
    return groups(in_files(docs, "exact-docs"), id_col, text_col).drop(FILE, AT)


def kept_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    docs = in_files(docs, "exact-docs")
    return without(docs, groups(docs, id_col, text_col).filter("NOT kept"), "exact-dropped")
