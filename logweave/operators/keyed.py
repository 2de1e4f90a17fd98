"""Latest-per-key state, compaction, retention, and the merge forms of the sinks.

Latest-per-key is an aggregate (``max_by``), so rows of a hot key are combined
before the shuffle and a key never needs to sit in one task whole.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.operators.validate import split_valid, table_row_error
from logweave.plans import pieces
from logweave.plans.sizing import settled, small_side


def _order(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in columns])


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key (end it with a tie-breaker)."""
    return _pick(df, keys, order, F.max_by)


def first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(df, keys, order, F.min_by)


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = pick(F.struct(*rest), _order(order)).alias("__row")
    return (
        df.groupBy(*keys).agg(picked).select(*keys, "__row.*").select(*df.columns)
    )


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows per key; Spark cuts to k per key before the shuffle too."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= k)


def compact(
    log: DataFrame, order: Sequence[str] = ("offset",), keys: Sequence[str] = ("topic", "key")
) -> DataFrame:
    """Latest value per (topic, key).

    A key lives in one partition as long as the partition count is fixed; order
    by (timestamp, partition, offset) if it was changed.
    """
    return latest(log, keys, order)


def retain_recent(log: DataFrame, hours: float = 24.0, ts: str = "timestamp") -> DataFrame:
    """Drop records older than ``hours`` before the newest of their topic.

    Null is a topic; a record without a time has no age and stays.
    """
    newest = log.groupBy(F.col("topic").alias("__topic")).agg(F.max(ts).alias("__newest"))
    newest = small_side(newest)
    age = F.unix_micros("__newest") - F.unix_micros(F.col(ts))
    return (
        log.join(newest, F.col("topic").eqNullSafe(F.col("__topic")))
        .filter(age.isNull() | (age <= int(hours * 3_600_000_000)))
        .drop("__topic", "__newest")
    )


def retain_bytes(
    log: DataFrame,
    limit: int = 268_435_456,
    size: Column | None = None,
    rows_per_piece: int | None = None,
) -> DataFrame:
    """Newest records of each partition whose sizes together stay within ``limit``.

    A null value has no bytes.
    """
    size = F.octet_length("value") if size is None else size
    sized = log.withColumn("__size", F.coalesce(size.cast("bigint"), F.lit(0)))
    split = pieces.cut(sized, ["topic", "partition"], "offset", rows_per_piece)
    total = split.running_total(["offset"], "__size", "__bytes", newest_first=True)
    return total.filter(F.col("__bytes") <= limit).rows().drop("__size", "__bytes")


# --- merges into a table -----------------------------------------------------


def upsert(
    target: DataFrame,
    arrivals: DataFrame,
    keys: Sequence[str],
    arrival: Sequence[str],
    shape: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Whole-row replace by key: the last arrival wins, whatever its own dates say.

    ``arrival`` orders the incoming rows (partition and offset, say).  Rows of
    ``target`` without an arrival stay, also those a newer run no longer has.
    ``shape`` turns records into table rows, after all but the last are gone.
    """
    both = _stored_and_arrived(target, arrivals, keys, arrival, F.max_by)
    newest = both.filter("__new IS NOT NULL").select(*keys, "__new.*")
    newest = (newest if shape is None else shape(newest)).select(*target.columns)
    kept = both.filter("__new IS NULL").select(*keys, "__old.*").select(*target.columns)
    return kept.unionByName(newest)


def _stored_and_arrived(
    target: DataFrame, arrivals: DataFrame, keys: Sequence[str], arrival: Sequence[str], pick
) -> DataFrame:
    """Per key its stored row and the picked arrival, either of which may be null; a null key is a key.

    Rows are brought together by key before they are combined, in partitions that Spark
    cuts to a size, also those of a hot key, so what is sorted by key fits in memory;
    only one row per key and partition goes through the second shuffle.  The result is
    settled, as both kinds of keys are read from it.
    """

    def rest(df: DataFrame) -> Column:
        return F.struct(*[c for c in df.columns if c not in keys])

    old = target.select(*keys, rest(target).alias("__old"))
    new = arrivals.select(*keys, rest(arrivals).alias("__new"), _order(arrival).alias("__at"))
    both = old.unionByName(new, allowMissingColumns=True).hint("rebalance", *keys)
    picked = both.groupBy(*keys).agg(
        F.any_value("__old", True).alias("__old"), pick("__new", F.col("__at")).alias("__new")
    )
    return settled(picked, "merged")


def insert_ignore(
    target: DataFrame, arrivals: DataFrame, keys: Sequence[str], arrival: Sequence[str]
) -> DataFrame:
    """Insert rows whose key is new; of several arrivals the first wins."""
    both = _stored_and_arrived(target, arrivals, keys, arrival, F.min_by)
    kept = both.filter("__old IS NOT NULL").select(*keys, "__old.*").select(*target.columns)
    added = both.filter("__old IS NULL").select(*keys, "__new.*").select(*target.columns)
    return kept.unionByName(added)


def product_rows(products: DataFrame, *keep: str) -> DataFrame:
    """Product records as the 13 columns of the product table."""
    fields = [c for c in products.columns if c not in keep]
    return products.select(
        "product_id",
        "name",
        "description",
        F.col("price.amount").cast("decimal(14,2)").alias("price_amount"),
        F.col("price.currency").alias("currency"),
        "category",
        "brand",
        F.col("stock.available").alias("available"),
        F.col("stock.reserved").alias("reserved"),
        "sku",
        "store_id",
        F.to_json(F.struct(*fields)).alias("data"),
        "updated_at",
        *keep,
    )


def storable_products(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Product records as table rows, and the records that the table would refuse, with their reason."""
    error = table_row_error("price.currency", "price.amount")
    valid, refused = split_valid(products, error)
    return product_rows(valid), refused
