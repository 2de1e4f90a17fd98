"""Size checks made before anything is treated as small, and settled results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.session import scratch_dir

# What counts as small enough to send to every executor.
SMALL_ROWS = 100_000
SMALL_BYTES = 32 * 1024 * 1024


def at_most(df: DataFrame, rows: int) -> list | None:
    """The rows of ``df`` if there are at most ``rows`` of them, else None.

    The driver never receives more than ``rows + 1`` rows, so callers can offer
    a small-input plan without betting on the input being small.
    """
    found = df.limit(rows + 1).collect()
    return found if len(found) <= rows else None


def small_side(df: DataFrame, rows: int = SMALL_ROWS, size: int = SMALL_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it was counted and weighed and found small, else as it is.

    Spark shuffles both sides of a join before it can learn that one was small;
    asking first saves the shuffle of the large side.  Beyond the bounds the
    join stays a shuffle join, whose skewed partitions Spark splits.
    """
    weight = F.octet_length(F.to_json(F.struct(*df.columns)))
    found = df.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(weight), F.lit(0))).first()
    return F.broadcast(df) if found[0] <= rows and found[1] <= size else df


def settled(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a written table in the shared scratch folder, its lineage cut.

    For results that are dear and read several times: they are computed once,
    and a lost executor costs a re-read, not a re-run.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
