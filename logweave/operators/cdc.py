"""Change-data-capture logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.functions.records import pretty
from logweave.operators.keyed import latest
from logweave.plans.sizing import small_side

# The captured tables, and operation codes create, update, delete, snapshot read.
CAPTURED = ("public.users", "public.orders")
CREATE, UPDATE, DELETE, READ = "c", "u", "d", "r"


def topic_parts(log: DataFrame) -> DataFrame:
    """Topic ``prefix.schema.table`` as three columns."""
    parts = F.split("topic", r"\.", 3)
    return log.withColumns(
        {"prefix": parts[0], "schema": F.get(parts, F.lit(1)), "table": F.get(parts, F.lit(2))}
    )


def captured(log: DataFrame, tables: Sequence[str] = CAPTURED) -> DataFrame:
    """Only topics of the included tables."""
    named = topic_parts(log)
    return named.filter(F.concat_ws(".", "schema", "table").isin(*tables))


def event_view(log: DataFrame, value: str = "value") -> DataFrame:
    """Any record for reading: JSON indented, anything else raw with the flag off."""
    is_json = F.try_parse_json(value).isNotNull()
    return log.withColumns(
        {"is_json": is_json, "shown": F.coalesce(pretty(value), F.col(value))}
    )


def changes(log: DataFrame, fields: Mapping[str, Column | str]) -> DataFrame:
    """A concrete envelope as neutral changes (table, pk, op, seq, row): a projection."""
    return log.select(
        *[
            (F.col(c) if isinstance(c, str) else c).alias(name)
            for name, c in ((n, fields[n]) for n in ("table", "pk", "op", "seq", "row"))
        ]
    )


def current_rows(
    change_log: DataFrame,
    keys: Sequence[str] = ("table", "pk"),
    order: Sequence[str] = ("seq",),
    op: str = "op",
) -> DataFrame:
    """Last change per primary key, deleted rows gone."""
    return latest(change_log, keys, order).filter(F.col(op) != DELETE)


def broken_references(
    child: DataFrame, parent: DataFrame, column: str, parent_key: str
) -> DataFrame:
    """Child rows whose non-null reference has no parent."""
    keys = small_side(parent.select(F.col(parent_key).alias("__ref")).distinct())
    return child.filter(F.col(column).isNotNull()).join(
        keys, F.col(column) == F.col("__ref"), "left_anti"
    )
