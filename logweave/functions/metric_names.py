"""From the names of a management interface to series names, labels and kinds.

Input text: ``domain<key=value, ...><>attribute``, and the attribute's value.
The first rule that matches decides; a record no rule matches is left out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    pattern: str
    name: str
    kind: str
    labels: dict[str, str] = field(default_factory=dict)
    value: float | None = None
    factor: float = 1.0
    help: str = ""


# Patterns, names, labels and kinds of the broker rules.
BROKER_RULES = (
    Rule(r"kafka.server<type=(.+), name=(.+)PerSec\w*><>Count", "kafka_server_$1_$2_total", "COUNTER"),
    Rule(r"kafka.server<type=(.+), name=(.+)><>Value", "kafka_server_$1_$2", "GAUGE"),
    Rule(r"kafka.controller<type=(.+), name=(.+)><>Value", "kafka_controller_$1_$2", "GAUGE"),
    Rule(r"kafka.network<type=(.+), name=(.+)><>Value", "kafka_network_$1_$2", "GAUGE"),
)

# Patterns, names, labels and kinds of the connector rules.
CONNECT_RULES = (
    Rule(
        r"kafka.(.+)<type=app-info, client-id=(.+)><>start-time-ms",
        "kafka_$1_start_time_seconds",
        "GAUGE",
        {"clientId": "$2"},
        factor=0.001,
        help="Kafka $1 JMX metric start time seconds",
    ),
    Rule(
        r"kafka.(.+)<type=app-info, client-id=(.+)><>(commit-id|version): (.+)",
        "kafka_$1_$3_info",
        "GAUGE",
        {"clientId": "$2", "$3": "$4"},
        value=1.0,
        help="Kafka $1 JMX metric info version and commit-id",
    ),
    Rule(
        r"kafka.(.+)<type=(.+)-metrics, client-id=(.+), topic=(.+), partition=(.+)><>"
        r"(.+-total|compression-rate|.+-avg|.+-replica|.+-lag|.+-lead)",
        "kafka_$2_$6",
        "GAUGE",
        {"clientId": "$3", "topic": "$4", "partition": "$5"},
        help="Kafka $1 JMX metric type $2",
    ),
    Rule(
        r"kafka.(.+)<type=(.+)-metrics, client-id=(.+), topic=(.+)><>"
        r"(.+-total|compression-rate|.+-avg)",
        "kafka_$2_$5",
        "GAUGE",
        {"clientId": "$3", "topic": "$4"},
        help="Kafka $1 JMX metric type $2",
    ),
    Rule(
        r"kafka.(.+)<type=(.+)-metrics, client-id=(.+), node-id=(.+)><>(.+-total|.+-avg)",
        "kafka_$2_$5",
        "UNTYPED",
        {"clientId": "$3", "nodeId": "$4"},
        help="Kafka $1 JMX metric type $2",
    ),
    Rule(
        r"kafka.(.+)<type=(.+)-metrics, client-id=(.*)><>"
        r"(.+-total|.+-avg|.+-bytes|.+-count|.+-ratio|.+-age|.+-flight|.+-threads|.+-connectors"
        r"|.+-tasks|.+-ago)",
        "kafka_$2_$4",
        "GAUGE",
        {"clientId": "$3"},
        help="Kafka $1 JMX metric type $2",
    ),
    Rule(
        r"kafka.connect<type=connector-task-metrics, connector=(.+), task=(.+)><>status: ([a-z-]+)",
        "kafka_connect_connector_status",
        "GAUGE",
        {"connector": "$1", "task": "$2", "status": "$3"},
        value=1.0,
        help="Kafka Connect JMX Connector status",
    ),
    Rule(
        r"kafka.connect<type=(.+)-metrics, connector=(.+), task=(.+)><>"
        r"(.+-total|.+-count|.+-ms|.+-ratio|.+-avg|.+-failures|.+-requests|.+-timestamp|.+-logged"
        r"|.+-errors|.+-retries|.+-skipped)",
        "kafka_connect_$1_$4",
        "GAUGE",
        {"connector": "$2", "task": "$3"},
        help="Kafka Connect JMX metric type $1",
    ),
    Rule(
        r"kafka.connect<type=connect-worker-metrics, connector=(.+)><>([a-z-]+)",
        "kafka_connect_worker_$2",
        "GAUGE",
        {"connector": "$1"},
        help="Kafka Connect JMX metric $1",
    ),
    Rule(
        r"kafka.connect<type=connect-worker-metrics><>([a-z-]+)",
        "kafka_connect_worker_$1",
        "GAUGE",
        help="Kafka Connect JMX metric worker",
    ),
    Rule(
        r"kafka.connect<type=connect-worker-rebalance-metrics><>([a-z-]+)",
        "kafka_connect_worker_rebalance_$1",
        "GAUGE",
        help="Kafka Connect JMX metric rebalance information",
    ),
)


_GAP = "\u001f"


def _whole(rule: Rule) -> str:
    return f"^.*(?:{rule.pattern}).*$"


def _literals(rule: Rule) -> list[str]:
    """Texts every match of the rule contains; cheap to look for."""
    variable = r"\([^)]*\)[*+?]?|\[[^\]]*\][*+?]?|\\\w[*+?]?|\."
    return [piece for piece in re.split(variable, rule.pattern) if piece]


def _rewritten(rule: Rule) -> str:
    """All parts of the outcome as one replacement text."""
    fixed = "" if rule.value is None else repr(rule.value)
    parts = [rule.name, rule.kind, rule.help, fixed, repr(rule.factor)]
    for name, value in rule.labels.items():
        parts += [name, value]
    return _GAP.join(parts)


def _safe(text: Column, allowed: str) -> Column:
    joined = F.regexp_replace(text, f"[^{allowed}]+", "_")
    return F.when(joined.rlike("^[0-9]"), F.concat(F.lit("_"), joined)).otherwise(joined)


def rename(
    df: DataFrame,
    rules: tuple[Rule, ...],
    attribute: str = "attribute",
    value: str = "value",
    lower_labels: bool = False,
) -> DataFrame:
    """Add metric, labels, kind, help and the numeric metric_value.

    The pattern of a rule, slow on lines that almost match, runs only on lines
    with all its literal texts; it rewrites a line into all parts of the outcome.
    """
    line = F.col("__line")
    chosen = None
    for rule in rules:
        applies = F.rlike(line, F.lit(_whole(rule)))
        for piece in reversed(_literals(rule)):
            applies = F.contains(line, F.lit(piece)) & applies
        text = F.regexp_replace(line, F.lit(_whole(rule)), F.lit(_rewritten(rule)))
        chosen = F.when(applies, text) if chosen is None else chosen.when(applies, text)
    lines = df.withColumn("__line", F.concat_ws(": ", F.col(attribute), F.col(value)))

    def outcome(parts: Column) -> Column:
        rest = F.slice(parts, 6, F.greatest(F.size(parts) - 5, F.lit(0)))
        pairs = F.sequence(F.lit(0), F.size(rest).cast("int") - 2, F.lit(2))
        even = F.when(F.size(rest) > 0, pairs).otherwise(F.array().cast("array<int>"))

        def label_name(i: Column) -> Column:
            safe = _safe(F.get(rest, i), "a-zA-Z0-9")
            return F.lower(safe) if lower_labels else safe

        own = F.nullif(parts[3], F.lit("")).try_cast("double")
        number = F.col(value).try_cast("double") * parts[4].try_cast("double")
        return F.struct(
            F.lower(_safe(parts[0], "a-zA-Z0-9:")).alias("metric"),
            F.map_from_arrays(
                F.transform(even, label_name), F.transform(even, lambda i: F.get(rest, i + 1))
            ).alias("labels"),
            parts[1].alias("kind"),
            parts[2].alias("help"),
            F.coalesce(own, number).alias("metric_value"),
        )

    # A one-element list: the line is rewritten and split once, and unnamed lines vanish.
    named = F.transform(F.array(F.split(chosen, _GAP, -1)), outcome)
    kept = F.filter(named, lambda m: m["metric_value"].isNotNull())
    return lines.select(*df.columns, F.inline(kept))
