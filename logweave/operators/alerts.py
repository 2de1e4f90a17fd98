"""Alert payloads: flattening, grouping, changes and repeats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave import schemas
from logweave.functions import records
from logweave.functions.text import col
from logweave.functions.times import epoch_micros
from logweave.plans import pieces, sizing

# Largest payload, grouping columns, least time between repeats.
MAX_PAYLOAD_BYTES = 1 << 20
GROUP_BY = ("alertname", "cluster")
REPEAT_SECONDS = 3600


def entry(labels: Column | str, name: str) -> Column:
    """Map lookup where a missing key is empty."""
    return F.coalesce(F.try_element_at(col(labels), F.lit(name)), F.lit(""))


def flatten(payloads: DataFrame, value: str = "value", strict: bool = True) -> DataFrame:
    """One row per alert of each payload; unreadable payloads keep one row with their reason."""
    keep = [c for c in payloads.columns if c != value]
    decoded = records.decode(payloads, schemas.ALERT_PAYLOAD, value, strict=strict)
    too_big = F.octet_length(value) > MAX_PAYLOAD_BYTES
    reason = F.when(too_big, F.lit("payload is too large")).otherwise(F.col("reject_reason"))
    judged = decoded.withColumn("reject_reason", reason)
    alerts = F.when(
        F.col("reject_reason").isNotNull(), F.array(F.lit(None).cast(schemas.ALERT_PAYLOAD["alerts"].dataType.elementType))
    ).otherwise(F.col("record.alerts"))
    return judged.select(*keep, "reject_reason", F.explode(alerts).alias("a")).select(
        *keep,
        "reject_reason",
        F.col("a.status").alias("status"),
        *[
            F.when(F.col("a").isNotNull(), entry("a.labels", n)).alias(n)
            for n in ("alertname", "instance", "cluster")
        ],
        F.when(F.col("a").isNotNull(), entry("a.annotations", "summary")).alias("summary"),
    )


def groups(alerts: DataFrame, by: Sequence[str] = GROUP_BY, ts: str = "ts") -> DataFrame:
    """One row per group: times, counts by status, distinct instances."""
    return alerts.groupBy(*by).agg(
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
        F.count(F.lit(1)).alias("alerts"),
        F.count_if(F.col("status") == "firing").alias("firing"),
        F.count_if(F.col("status") == "resolved").alias("resolved"),
        F.count_distinct("instance").alias("instances"),
    )


def status_changes(
    alerts: DataFrame,
    keys: Sequence[str] = (*GROUP_BY, "instance"),
    ts: str = "ts",
    rows_per_piece: int | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Rows whose status differs from the one before (``was``, null at first).

    Alerts of one time follow one another by ``order``, then by status.
    """
    placed = alerts.withColumn("__pos", epoch_micros(ts))
    split = pieces.cut(placed, keys, "__pos", rows_per_piece)
    seen = split.last_known(["__pos", *order, "status"], "status", "was", strictly_before=True)
    return seen.filter(~F.col("status").eqNullSafe(F.col("was"))).rows().drop("__pos")


def notices(
    alerts: DataFrame,
    by: Sequence[str] = GROUP_BY,
    ts: str = "ts",
    seconds: int = REPEAT_SECONDS,
    order: Sequence[str] = (),
    rows_per_piece: int | None = None,
) -> DataFrame:
    """The alerts that are told: every change of a group's status, and repeats of it.

    ``changed`` says which.  A status that stays is told again by the first alert at
    least ``seconds`` after the last notice, so each repeat depends on the one
    before.  Every alert points to the alert that would repeat it; the pointers are
    doubled, and after k rounds the first 2**k notices of every chain are known:
    as many rounds as the longest chain has binary digits, whatever a group's size.

    Alerts of one time follow one another by ``order`` and then by status; rows that
    are equal in all of these are one alert.  An alert without a time is not told.
    """
    place = ["__pos", *order, "status"]
    placed = alerts.withColumn("__pos", epoch_micros(ts)).filter("__pos IS NOT NULL").dropDuplicates([*by, ts, *place[1:]])
    split = pieces.cut(placed, by, "__pos", rows_per_piece).with_column("__told", F.struct("status"))
    seen = split.last_known(place, "__told", "__was", strictly_before=True)
    is_new = F.col("__was").isNull() | ~F.col("__was.status").eqNullSafe(F.col("status"))
    seen = seen.with_column("__new", is_new.cast("bigint")).running_total(place, "__new", "__run")
    runs = seen.rows().withColumn("__id", F.monotonically_increasing_id())
    runs = sizing.settled(runs, "alert-runs")
    steps = _repeated_by(runs, [*by, "__run"], place, seconds * 1_000_000, rows_per_piece)
    told = _reached(runs.filter("__new = 1").select("__id"), sizing.settled(steps, "alert-steps"))
    found = runs.join(told, "__id", "left_semi").withColumn("changed", F.col("__new") == 1)
    return found.select(*alerts.columns, "changed")


def _repeated_by(
    runs: DataFrame, keys: Sequence[str], place: Sequence[str], wait: int, rows_per_piece: int | None
) -> DataFrame:
    """(id, next): the first alert of the same run that is ``wait`` or more after each."""
    # Read from the end: the last alert before the one asked for, the first of its time.
    firsts = runs.groupBy(*keys, "__pos").agg(F.min_by("__id", F.struct(*place)).alias("__to"))
    firsts = firsts.select(*keys, (-F.col("__pos")).alias("__at"), F.lit(0).alias("__kind"), "__to")
    asked = runs.select(*keys, (-F.col("__pos") - wait).alias("__at"), F.lit(1).alias("__kind"), "__id")
    both = asked.unionByName(firsts, allowMissingColumns=True)
    found = pieces.cut(both, keys, "__at", rows_per_piece).last_known(["__at", "__kind"], "__to", "__next")
    return found.filter((F.col("__kind") == 1) & F.col("__next").isNotNull()).rows().select("__id", "__next")


def _reached(starts: DataFrame, steps: DataFrame) -> DataFrame:
    """All ids that ``steps`` lead to from ``starts``, by doubling the steps."""
    found = sizing.settled(starts, "alert-told")
    while True:
        further = found.join(steps, "__id").select(F.col("__next").alias("__id"))
        further = sizing.settled(further, "alert-told")
        if further.isEmpty():
            return found
        found = found.union(further)
        twice = steps.select("__id", F.col("__next").alias("__by")).join(
            steps.select(F.col("__id").alias("__by"), "__next"), "__by"
        )
        steps = sizing.settled(twice.select("__id", "__next"), "alert-steps")
