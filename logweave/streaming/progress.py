"""How far streams have come: positions and keyed state read from checkpoints, and streams that stop when idle."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from logweave.plans.sizing import small_side

_ENTRY = "path string, batchId bigint"


def committed_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """(file) that a stream over files has read in batches it has committed.

    The source notes the files of a batch before it runs; only those of batches that
    are in the log of commits count.
    """
    noted = spark.read.text(f"{checkpoint}/sources/{source}").select(F.from_json("value", _ENTRY).alias("e"))
    done = spark.read.text(f"{checkpoint}/commits").select(F.regexp_extract("_metadata.file_name", r"^(\d+)", 1).alias("b"))
    last = done.agg(F.max(F.col("b").cast("bigint")).alias("last")).first()["last"]
    found = noted.filter(F.col("e.batchId") <= F.lit(-1 if last is None else last))
    return found.select(_plain(F.col("e.path")).alias("file")).distinct()


def _plain(path):
    """Paths are written with one slash after the scheme or with three."""
    return F.regexp_replace(path, "^file:/+", "/")


def positions(spark: SparkSession, log: DataFrame, checkpoint: str, group: str) -> DataFrame:
    """(group, topic, partition, committed): one past the last offset that a reading group has committed.

    ``log`` is read straight from the files that the group's stream reads.
    """
    read = log.select("topic", "partition", "offset", _plain(F.col("_metadata.file_path")).alias("file"))
    seen = read.join(small_side(committed_files(spark, checkpoint)), "file", "left_semi")
    ends = seen.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("committed"))
    return ends.select(F.lit(group).alias("group"), "topic", "partition", "committed")


def keyed_state(spark: SparkSession, checkpoint: str, variable: str = "current") -> DataFrame:
    """The rows of a state variable (its grouping key's columns, then its own) as a checkpoint holds them."""
    rows = spark.read.format("statestore").option("stateVarName", variable).load(checkpoint)
    return rows.select("key.*", "value.*")


class Idleness(StreamingQueryListener):
    """Notes when each query last had rows."""

    def __init__(self) -> None:
        self._busy: dict[str, float] = {}
        self._lock = threading.Lock()

    def _mark(self, run_id) -> None:
        with self._lock:
            self._busy[str(run_id)] = time.monotonic()

    def idle_seconds(self, run_id) -> float:
        with self._lock:
            return time.monotonic() - self._busy.setdefault(str(run_id), time.monotonic())

    def onQueryStarted(self, event) -> None:
        self._mark(event.runId)

    def onQueryProgress(self, event) -> None:
        if event.progress.numInputRows:
            self._mark(event.progress.runId)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def until_idle(spark: SparkSession, start, seconds: float) -> StreamingQuery:
    """Run the query that ``start`` starts until no rows have come for ``seconds``, then stop it.

    A batch that is running is not idle: it is finished first.
    """
    seen = Idleness()
    spark.streams.addListener(seen)
    try:
        query = start()
        while not query.awaitTermination(1):
            working = query.status["isTriggerActive"] and query.status["isDataAvailable"]
            if working:
                seen._mark(query.runId)
            elif seen.idle_seconds(query.runId) >= seconds:
                query.stop()
        return query
    finally:
        spark.streams.removeListener(seen)
