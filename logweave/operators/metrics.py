"""Series operators: rows of (series keys, ts, value).

Rates and held conditions need each row's predecessor; hot series are cut
along time (see :mod:`logweave.plans.pieces`).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.functions.times import epoch_micros
from logweave.plans import pieces

MICROS = 1_000_000


def label_key(labels: str = "labels") -> Column:
    """Labels as sorted entries: maps cannot be grouped by."""
    return F.array_sort(F.map_entries(F.col(labels)))


def counter_rate(
    samples: DataFrame,
    keys: Sequence[str],
    ts: str = "ts",
    value: str = "value",
    seconds: int = 60,
    rows_per_piece: int | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Per-second increase over the trailing ``seconds`` at each sample.

    A value below its predecessor is a counter reset and counts as the increase.
    A null, NaN or infinite sample is no sample: it adds nothing and precedes
    nothing, but its row still gets the rate of its window.  Rates are sums of the
    increases inside the window and so never negative.  Window edges are not
    extrapolated.  Samples of one time follow one another by ``order``, then by
    value, and all are in each other's windows.
    """
    number = F.col(value).cast("double")
    finite = F.when(~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))), number)
    placed = samples.withColumns({"__pos": epoch_micros(ts), "__now": finite})
    split = pieces.cut(placed, keys, "__pos", rows_per_piece)
    now, prev = F.col("__now"), F.col("__prev")
    gain = F.when(now < prev, F.greatest(now, F.lit(0.0))).otherwise(now - prev)
    increase = F.coalesce(gain, F.lit(0.0))
    total = (
        split.last_known(["__pos", *order, "__now"], "__now", "__prev", strictly_before=True)
        .with_column("__inc", increase)
        .trailing_sum(seconds * MICROS, "__inc", "__sum")
    )
    return (
        total.rows()
        .withColumn("rate", F.col("__sum") / seconds)
        .drop("__pos", "__now", "__prev", "__inc", "__sum")
    )


def sum_by(series: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    return series.groupBy(*by).agg(F.sum(value).alias(out))


def current_values(
    samples: DataFrame, metric: str | None = None, where: Column | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """Newest value of each series, chosen by metric name and label condition.

    Of samples at the newest time the greatest by ``order`` counts, then the greatest value.
    """
    newest = F.struct("ts", *order, "value")
    chosen = samples if metric is None else samples.filter(F.col("metric") == metric)
    chosen = chosen if where is None else chosen.filter(where)
    return (
        chosen.groupBy("metric", label_key().alias("label_entries"))
        .agg(F.max_by("value", newest).alias("value"), F.max("ts").alias("ts"))
        .withColumn("labels", F.map_from_entries("label_entries"))
        .drop("label_entries")
    )


def running_connectors(samples: DataFrame, connector: str, state: str = "running") -> DataFrame:
    """How many tasks of a connector report ``state`` in their newest sample."""
    where = (F.col("labels")["connector"] == connector) & (F.col("labels")["status"] == state)
    newest = current_values(samples, "kafka_connect_connector_status", where)
    return newest.agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("running"))


def held(
    samples: DataFrame,
    keys: Sequence[str],
    condition: Column,
    seconds: int,
    ts: str = "ts",
    rows_per_piece: int | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Rows on which ``condition`` holds, with the start of their unbroken run and ``firing``.

    Firing means that the run has lasted at least ``seconds``.  Rows of one time
    follow one another by ``order``; of those still equal, the ones on which the
    condition does not hold come first.
    """
    placed = samples.withColumn("__pos", epoch_micros(ts)).withColumn(
        "__on", F.coalesce(condition, F.lit(False))
    )
    split = pieces.cut(placed, keys, "__pos", rows_per_piece)
    begins = F.col("__on") & ~F.coalesce("__was", F.lit(False))
    runs = (
        split.last_known(["__pos", *order, "__on"], "__on", "__was", strictly_before=True)
        .with_column("__start", F.when(begins, F.col("__pos")))
        .last_known(["__pos", *order, "__on"], "__start", "since_us")
    )
    return (
        runs.filter("__on")
        .rows()
        .withColumn("firing", F.col("__pos") - F.col("since_us") >= seconds * MICROS)
        .drop("__pos", "__on", "__was", "__start")
    )


@dataclass(frozen=True)
class AlertRule:
    alert: str
    metric: str
    op: str
    threshold: float
    seconds: int
    severity: str
    summary: str
    description: str
    labels: tuple[tuple[str, str], ...] = ()


# The two alert rules of the broker set.
ALERT_RULES = (
    AlertRule(
        "KafkaBrokerDown",
        "up",
        "==",
        0,
        30,
        "critical",
        "Kafka broker {instance} is unavailable",
        "Prometheus has not scraped {instance} for at least 30 seconds.",
        (("job", "kafka-brokers"),),
    ),
    AlertRule(
        "KafkaUnderReplicatedPartitions",
        "kafka_server_replicamanager_underreplicatedpartitions",
        ">",
        0,
        60,
        "warning",
        "Kafka has under-replicated partitions",
        "Broker {instance} reports under-replicated partitions.",
    ),
)


def firing_alerts(samples: DataFrame, rules: Sequence[AlertRule] = ALERT_RULES) -> DataFrame:
    """(alert, severity, instance, cluster, ts, since_us, summary, description) while firing."""
    found = None
    for rule in rules:
        chosen = samples.filter(F.col("metric") == rule.metric)
        for name, wanted in rule.labels:
            chosen = chosen.filter(F.col("labels")[name] == wanted)
        keyed = chosen.withColumn("__series", label_key())
        value = F.col("value")
        condition = value == rule.threshold if rule.op == "==" else value > rule.threshold
        instance = F.coalesce(F.col("labels")["instance"], F.lit(""))
        part = (
            held(keyed, ["__series"], condition, rule.seconds)
            .filter("firing")
            .select(
                F.lit(rule.alert).alias("alert"),
                F.lit(rule.severity).alias("severity"),
                instance.alias("instance"),
                F.coalesce(F.col("labels")["cluster"], F.lit("")).alias("cluster"),
                "ts",
                "since_us",
                F.replace(F.lit(rule.summary), F.lit("{instance}"), instance).alias("summary"),
                F.replace(F.lit(rule.description), F.lit("{instance}"), instance).alias("description"),
            )
        )
        found = part if found is None else found.unionByName(part)
    return found
