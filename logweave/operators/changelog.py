"""State folded from change events.

A fold in arrival order is expressed as "the last event per element decides",
an aggregate over (key, element), so no key is replayed in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.functions.text import is_blank, normal_word, or_default, trimmed
from logweave.functions.times import nano_text
from logweave.plans.sizing import small_side

# Action names and the key of the shared word list.
ADD, REMOVE = "add", "remove"
BLOCK, UNBLOCK = "block", "unblock"
REPLACE = "replace"
SHARED_KEY = "global"
DEFAULT_REASON = "blocked by operator"

# Lists are a view for readers that want arrays; what is stored and joined are the rows of
# block_pairs and active_words, one per key and item, whose form does not depend on size.
ITEMS_PER_PAGE = 100_000


def _position(order: Sequence[str]) -> Column:
    """One order column stays bare: flags picked by a number are hash-aggregated."""
    if len(order) == 1:
        return F.col(order[0])
    return F.struct(*[F.col(c) for c in order])


def with_log_time(events: DataFrame, time: str = "updated_at", ts: str = "timestamp") -> DataFrame:
    """An empty time becomes the record's own log time, so that replays repeat."""
    return events.withColumn(time, or_default(time, nano_text(ts)))


# --- denylist ----------------------------------------------------------------


def deny_state(commands: DataFrame, key: str = "key", order: Sequence[str] = ("offset",)) -> DataFrame:
    """Denied keys as the filter sees them: by record key, unknown actions ignored."""
    known = commands.filter(F.col("action").isin(ADD, REMOVE))
    entry = F.struct("action", "product_id", "reason", F.col("updated_at").alias("blocked_at"))
    return (
        known.groupBy(key)
        .agg(F.max_by(entry, _position(order)).alias("e"))
        .filter(F.col("e.action") == ADD)
        .select(key, "e.product_id", "e.reason", "e.blocked_at")
    )


def denied_keys(commands: DataFrame, key: str = "key", order: Sequence[str] = ("offset",)) -> DataFrame:
    """Only the keys of :func:`deny_state`: a hash aggregate over a flag."""
    return (
        commands.filter(F.col("action").isin(ADD, REMOVE))
        .groupBy(key)
        .agg(F.max_by(F.col("action") == ADD, _position(order)).alias("denied"))
        .filter("denied")
        .select(key)
    )


def deny_list(commands: DataFrame, order: Sequence[str] = ("offset",)) -> DataFrame:
    """The operator's listing: by payload id, the latest command of any action decides.

    Unlike :func:`deny_state` an unknown action hides the id.
    """
    entry = F.struct("action", "reason")
    return (
        commands.groupBy("product_id")
        .agg(F.max_by(entry, _position(order)).alias("e"))
        .filter(F.col("e.action") == ADD)
        .select("product_id", "e.reason")
        .orderBy("product_id")
    )


def with_default_reason(commands: DataFrame) -> DataFrame:
    reason = or_default("reason", F.lit(DEFAULT_REASON))
    return commands.withColumn("reason", F.when(F.col("action") == ADD, reason))


# --- block lists -------------------------------------------------------------


def valid_block_events(events: DataFrame, key: str = "key") -> DataFrame:
    """Known actions with both ids non-blank; ids trimmed; empty time becomes log time."""
    known = events.filter(
        ~is_blank("user_id") & ~is_blank("blocked_user_id") & F.col("action").isin(BLOCK, UNBLOCK)
    )
    return known.select(
        F.col(key).alias("user"),
        trimmed("blocked_user_id").alias("blocked"),
        (F.col("action") == BLOCK).alias("on"),
        *[c for c in events.columns if c not in {key, "user_id", "blocked_user_id", "action"}],
    )


def block_pairs(events: DataFrame, key: str = "key", order: Sequence[str] = ("offset",)) -> DataFrame:
    """(user, blocked) pairs in force."""
    return (
        valid_block_events(events, key)
        .groupBy("user", "blocked")
        .agg(F.max_by("on", _position(order)).alias("on"))
        .filter("on")
        .select("user", "blocked")
    )


def block_lists(
    events: DataFrame,
    key: str = "key",
    order: Sequence[str] = ("offset",),
    time: str = "updated_at",
    page_items: int = ITEMS_PER_PAGE,
) -> DataFrame:
    """Per user: sorted blocked ids, time of the last valid event, also when empty.

    A list longer than ``page_items`` continues on further rows (``page`` of
    ``pages``), each sorted, together the whole list.
    """
    valid = valid_block_events(events, key)
    last = valid.groupBy("user", "blocked").agg(
        F.max_by("on", _position(order)).alias("on"),
        F.max_by(time, _position(order)).alias("t"),
        F.max(_position(order)).alias("o"),
    )
    heads = last.groupBy("user").agg(
        F.max_by("t", "o").alias("updated_at"), F.count_if("on").alias("items")
    )
    active = last.filter("on").select("user", F.col("blocked").alias("item"))
    return _paged(heads, active, "user", page_items, "blocked_user_ids")


def _paged(heads: DataFrame, items: DataFrame, key: str, page_items: int, out: str) -> DataFrame:
    """Sorted lists of ``items`` (key, item) by key, on as many pages as they need.

    ``heads`` has the key, ``updated_at`` and the number of ``items``.  The many
    rows are the left side of an inner join, whose skewed partitions Spark can
    split, and a page, not a key, is what one task collects.
    """
    pages = F.greatest(F.lit(1), F.ceil(F.col("items") / page_items)).cast("int")
    sized = heads.withColumn("pages", pages)
    page = F.when(F.col("pages") == 1, F.lit(0)).otherwise(
        F.pmod(F.xxhash64("item"), F.col("pages")).cast("int")
    )
    columns = [key, "updated_at", "page", "pages"]
    full = (
        items.join(sized, key)
        .withColumn("page", page)
        .groupBy(*columns)
        .agg(F.array_sort(F.collect_list("item")).alias(out))
    )
    empty = sized.filter("items = 0").withColumn("page", F.lit(0))
    none = F.array().cast("array<string>").alias(out)
    return full.unionByName(empty.select(*columns, none))


# --- word lists --------------------------------------------------------------


def word_changes(
    updates: DataFrame, key: str = "key", order: Sequence[str] = ("offset",), keep: Sequence[str] = ()
) -> DataFrame:
    """One row per changed word: (key, word, on, order...), words normalised."""
    known = updates.filter(F.col("action").isin(REPLACE, ADD, REMOVE))
    words = F.array_distinct(F.transform("words", normal_word))
    return known.select(
        key,
        F.explode(words).alias("word"),
        (F.col("action") != REMOVE).alias("on"),
        *order,
        *keep,
    ).filter(F.col("word") != "")


def last_replace(updates: DataFrame, key: str = "key", order: Sequence[str] = ("offset",)) -> DataFrame:
    return (
        updates.filter(F.col("action") == REPLACE)
        .groupBy(key)
        .agg(F.max(_position(order)).alias("since"))
    )


def active_words(updates: DataFrame, key: str = "key", order: Sequence[str] = ("offset",)) -> DataFrame:
    """(key, word) in force: on after the last event of the word since the last replace."""
    last = (
        word_changes(updates, key, order)
        .groupBy(key, "word")
        .agg(F.max_by("on", _position(order)).alias("on"), F.max(_position(order)).alias("o"))
        .filter("on")
    )
    since = small_side(last_replace(updates, key, order))
    return (
        last.join(since, key, "left")
        .filter(F.col("since").isNull() | (F.col("o") >= F.col("since")))
        .select(key, "word")
    )


def word_lists(
    updates: DataFrame,
    key: str = "key",
    order: Sequence[str] = ("offset",),
    time: str = "updated_at",
    page_items: int = ITEMS_PER_PAGE,
) -> DataFrame:
    """Per key: sorted words and time of the last known update, paged like block lists."""
    active = active_words(updates, key, order).withColumnRenamed("word", "item")
    times = (
        updates.filter(F.col("action").isin(REPLACE, ADD, REMOVE))
        .groupBy(key)
        .agg(F.max_by(time, _position(order)).alias("updated_at"))
    )
    counts = active.groupBy(key).agg(F.count(F.lit(1)).alias("items"))
    heads = times.join(counts, key, "left").withColumn("items", F.coalesce("items", F.lit(0)))
    return _paged(small_side(heads), active, key, page_items, "words")
