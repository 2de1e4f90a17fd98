"""Instants and ids as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweave.functions.text import col

RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})$"


def parse_instant(value: Column | str) -> Column:
    """RFC 3339 text with any number of fraction digits to a timestamp, else null.

    Such texts do not sort as strings ("...00.5Z" < "...00Z"): parse, then order.
    """
    v = col(value)
    cut = F.regexp_replace(v, r"(\.\d{6})\d+", "$1")
    return F.when(v.rlike(RFC3339), F.try_to_timestamp(cut))


def second_text(value: Column | str) -> Column:
    """UTC text with whole seconds and a literal Z (session zone must be UTC)."""
    return F.date_format(col(value), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def nano_text(value: Column | str) -> Column:
    """UTC text whose fraction has no trailing zeros and vanishes when zero."""
    v = col(value)
    fraction = F.rtrim(F.date_format(v, "SSSSSS"), F.lit("0"))
    dotted = F.when(fraction == "", F.lit("")).otherwise(F.concat(F.lit("."), fraction))
    return F.concat(F.date_format(v, "yyyy-MM-dd'T'HH:mm:ss"), dotted, F.lit("Z"))


def epoch_millis(value: Column | str) -> Column:
    return F.unix_millis(col(value).cast("timestamp"))


def epoch_micros(value: Column | str) -> Column:
    return F.unix_micros(col(value).cast("timestamp"))


def order_keys(*columns: Column | str) -> Column:
    """Key of two or more parts, missing parts empty: ``user:product``."""
    return F.concat_ws(":", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in columns])


def random_request_id() -> Column:
    """32 random hex digits."""
    return F.replace(F.uuid(), F.lit("-"), F.lit(""))


def stable_request_id(*columns: Column | str) -> Column:
    """32 hex digits that repeat when the same record is replayed."""
    text = F.to_json(F.struct(*[col(c) for c in columns]))
    return F.substring(F.sha2(text, 256), 1, 32)
