"""Streams built from one mixed log: product filter, chat, mirror and archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave import schemas
from logweave.functions import records
from logweave.functions.times import epoch_micros
from logweave.functions.text import is_blank, mask_each, normal_word, trimmed
from logweave.operators import changelog as cl
from logweave.operators import filters, logs
from logweave.operators.validate import deliverable
from logweave.plans import pieces, sizing
from logweave.sources import tables
from logweave.streaming import asof, sinks

# Before every position and sequence: where the state of earlier batches stands.
FIRST = -(1 << 62)
# The topic of the row that ends a log.
CLOSING = "__closing"


def _decoded(log: DataFrame, topic: str, schema, on_error: str) -> DataFrame:
    """Records of a topic that the policy lets through; a job never takes an undecoded one for data.

    With ``quarantine`` or ``raw`` the rejected rows are :func:`rejected`'s, a stream of its own.
    """
    rows = log.filter(F.col("topic") == topic).select("key", "timestamp", "offset", "value")
    decoded = records.decode(rows, schema)
    return records.apply_policy(decoded, on_error if on_error == "fail" else "skip")


def rejected(log: DataFrame, topic: str, schema) -> DataFrame:
    """Rows of a topic that do not decode, with their text and ``reject_reason``."""
    rows = log.filter(F.col("topic") == topic).select("topic", "key", "timestamp", "offset", "value")
    return records.apply_policy(records.decode(rows, schema), "quarantine")[1]


def _control(rows: DataFrame, action: Column, arguments: Column, *keys: Column) -> DataFrame:
    return rows.select(
        *keys,
        "timestamp",
        F.col("offset").alias("seq"),
        F.lit(asof.CONTROL).alias("kind"),
        action.alias("action"),
        arguments.alias("arguments"),
    )


def _placed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("pos", F.coalesce(epoch_micros("timestamp"), F.lit(FIRST)))


def _data(rows: DataFrame, *columns: Column | str) -> DataFrame:
    return rows.select(
        *columns, "timestamp", F.col("offset").alias("seq"), F.lit(asof.DATA).alias("kind")
    )


def judged_products(
    log: DataFrame,
    products: str = "products.raw",
    commands: str = "blacklist.commands",
    delay: str | None = "10 seconds",
    salts: int = 1,
    on_error: str = "skip",
) -> DataFrame:
    """Every product of a mixed log with ``denied`` and, where there is a delay, ``late``.

    Rows of the topic :data:`CLOSING` are neither products nor commands; see
    :func:`closing_rows`.
    """
    data = _data(_decoded(log, products, schemas.PRODUCT, on_error), "key", "value")
    orders = _decoded(log, commands, schemas.DENY_COMMAND, on_error)
    known = orders.filter(F.col("record.action").isin(cl.ADD, cl.REMOVE))
    control = _control(known, F.col("record.action"), F.array(F.lit("denied")), F.col("key"))
    last = log.filter(F.col("topic") == CLOSING).select(
        "key", "timestamp", F.col("offset").alias("seq"), F.lit(asof.CLOSING).alias("kind")
    )
    mixed = data.unionByName(control, allowMissingColumns=True).unionByName(last, allowMissingColumns=True)
    seen = asof.as_of_stream(mixed, ["key"], "timestamp", delay, salts)
    return seen.withColumn("denied", F.size("items") > 0).drop("items")


def closing_rows(log: DataFrame, delay: str) -> DataFrame:
    """The row that ends a log: added to it, every product still held is judged."""
    at = asof.closing(log, "timestamp", delay)
    others = {"topic": F.lit(CLOSING), "partition": F.lit(0), "offset": F.lit(0).cast("bigint")}
    others |= {"key": F.lit(""), "value": F.lit(None).cast("string")}
    return at.withColumns(others).select(*schemas.LOG.names)


def filter_products(
    log: DataFrame,
    products: str = "products.raw",
    commands: str = "blacklist.commands",
    delay: str | None = "10 seconds",
    salts: int = 1,
    on_error: str = "skip",
) -> DataFrame:
    """Accepted products of a mixed log (topic, key, value, offset, timestamp)."""
    judged = judged_products(log, products, commands, delay, salts, on_error)
    return judged.filter("NOT denied").drop("denied")


def filter_products_writer(
    path: str,
    state: str,
    products: str = "products.raw",
    commands: str = "blacklist.commands",
    on_error: str = "skip",
    rows_per_piece: int | None = None,
) -> sinks.Writer:
    """:func:`filter_products` without a delay, for micro-batches of any size.

    A batch is resolved by :func:`pieces.as_of`, which cuts a hot key along time, so no
    task holds a key's rows.  What batches before it left denied comes first; what a
    batch changes is a delta of the table at ``state``, folded every so many batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        known = tables.table(batch.sparkSession, state, "key string, denied boolean", ["key"])
        now = known.current()
        if now.done >= batch_id:
            return
        orders = _decoded(batch, commands, schemas.DENY_COMMAND, on_error)
        ordered = _placed(orders.filter(F.col("record.action").isin(cl.ADD, cl.REMOVE)))
        denied = (F.col("record.action") == cl.ADD).alias("denied")
        # Decoded once: counts, the lookup and what the batch changes all read them.
        control = sizing.settled(ordered.select("key", "pos", F.col("offset").alias("seq"), denied), "commands")
        before = known.read(now).filter("denied").select("key", *_at_first(), "denied")
        data = _data(_placed(_decoded(batch, products, schemas.PRODUCT, on_error)), "key", "value", "pos").drop("kind")
        data = sizing.settled(data, "products")
        seen = pieces.as_of(
            data, _renamed(before.unionByName(control), "denied"), ["key"], "pos", "seq", _ON, rows_per_piece
        )
        kept = seen.filter(~F.coalesce(_ON, F.lit(False))).select("key", "value", "timestamp", "seq")
        kept.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        changed = control.groupBy("key").agg(F.max_by("denied", F.struct("pos", "seq")).alias("denied"))
        _put(known, changed, batch_id)

    return write


_ON = "__on"


def _renamed(control: DataFrame, state: str) -> DataFrame:
    return control.withColumnRenamed(state, _ON)


def _at_first() -> list[Column]:
    return [F.lit(FIRST).alias("pos"), F.lit(FIRST).alias("seq")]


def _put(table: tables.Table, rows: DataFrame, batch_id: int) -> None:
    """One more delta; now and then all of them as a base, and what no reader can want any more goes."""
    if len(table.add(rows, batch_id).deltas) >= sinks.FOLD_EVERY:
        table.fold()
        table.expire()


def chat_writer(
    path: str,
    state: str,
    messages: str = "messages",
    events: str = "blocked_users",
    updates: str = "banned_words",
    on_error: str = "skip",
    rows_per_piece: int | None = None,
) -> sinks.Writer:
    """The chat as one chained stream: valid messages, not blocked, masked, all as of their time.

    State is two tables with versions: the blocks in force by pair of users, and per
    word the interval in which it is or last was in force.  A batch joins its messages
    to the intervals that reach them and those its own updates begin and end, word by
    word; no key stands for the whole list.  Messages are decided in the batch that
    brings them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        blocks = tables.table(spark, f"{state}/blocks", _BLOCKS, ["user", "other"])
        words = tables.table(spark, f"{state}/words", _WORDS, ["word"])
        if words.current().done >= batch_id:
            return
        blocks_now, words_now = blocks.current(before=batch_id), words.current()
        sent = _placed(_decoded(batch, messages, schemas.CHAT_MESSAGE, on_error))
        sent = sent.select("*", "record.*").filter(deliverable()).withColumn("seq", F.col("offset"))
        # Decoded once: every count and lookup below reads them.
        sent = sizing.settled(sent.select("recipient_id", "sender_id", "message_id", "text", "timestamp", "pos", "seq"), "sent")

        given = _placed(_decoded(batch, events, schemas.BLOCK_EVENT, on_error)).select("key", "record.*", "pos", "offset")
        given = cl.valid_block_events(given).select("user", F.col("blocked").alias("other"), "on", "pos", F.col("offset").alias("seq"))
        given = sizing.settled(given, "given")
        known = blocks.read(blocks_now).filter("on").select("user", "other", "on", *_at_first())
        control = _renamed(known.unionByName(given), "on")
        control = control.withColumnsRenamed({"user": "recipient_id", "other": "sender_id"})
        seen = pieces.as_of(sent, control, ["recipient_id", "sender_id"], "pos", "seq", _ON, rows_per_piece)
        kept = sizing.settled(seen.filter(~F.coalesce(_ON, F.lit(False))).drop(_ON), "unblocked")

        told = _placed(_decoded(batch, updates, schemas.WORDS_UPDATE, on_error)).select("key", "record.*", "pos", "offset")
        told = told.filter(F.col("key") == cl.SHARED_KEY).withColumnRenamed("offset", "seq")
        told = sizing.settled(told.select(*_UPDATE), "told")
        stored = words.read(words_now)
        first = kept.agg(F.min("pos")).first()[0]
        standing = stored.filter(F.col("until").isNull() | (F.col("until.pos") > F.lit(first)))
        both = _as_updates(standing).unionByName(told)
        intervals = sizing.settled(filters.word_intervals(both, rows_per_piece=rows_per_piece), "intervals")
        found = filters.mask_in_force(kept, intervals, rows_per_piece=rows_per_piece)
        found = found.select("message_id", "recipient_id", "sender_id", "text", "timestamp", "seq")
        found.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

        changed = given.groupBy("user", "other").agg(F.max_by("on", F.struct("pos", "seq")).alias("on"))
        _put(blocks, changed, batch_id)
        last = F.max_by(F.struct(F.struct("pos", "seq").alias("since"), "until"), F.struct("pos", "seq")).alias("last")
        latest = intervals.groupBy("word").agg(last).select("word", "last.*")
        _put(words, latest.subtract(stored.select(*latest.columns)), batch_id)

    return write


_UPDATE = ("key", "words", "action", "pos", "seq")


def _as_updates(intervals: DataFrame) -> DataFrame:
    """Stored intervals as the updates that begin and end them."""
    word, shared = F.array("word").alias("words"), F.lit(cl.SHARED_KEY).alias("key")
    begun = intervals.select(shared, word, F.lit(cl.ADD).alias("action"), "since.*")
    ended = intervals.filter("until IS NOT NULL").select(shared, word, F.lit(cl.REMOVE).alias("action"), "until.*")
    return begun.unionByName(ended)


_BLOCKS = "user string, other string, on boolean"
_WORDS = "word string, since struct<pos: bigint, seq: bigint>, until struct<pos: bigint, seq: bigint>"


def unblocked_messages(
    log: DataFrame,
    messages: str = "messages",
    events: str = "blocked_users",
    delay: str | None = "10 seconds",
    salts: int = 1,
    on_error: str = "skip",
) -> DataFrame:
    """Valid messages whose recipient had not blocked the sender at their time."""
    sent = _decoded(log, messages, schemas.CHAT_MESSAGE, on_error)
    valid = sent.select("*", "record.*").filter(deliverable())
    data = _data(valid, F.col("recipient_id").alias("user"), F.col("sender_id").alias("other"), "message_id", "text")
    changes = _decoded(log, events, schemas.BLOCK_EVENT, on_error).select("*", "record.*")
    known = changes.filter(
        ~is_blank("user_id")
        & ~is_blank("blocked_user_id")
        & F.col("action").isin(cl.BLOCK, cl.UNBLOCK)
    )
    action = F.when(F.col("action") == cl.BLOCK, F.lit("add")).otherwise(F.lit("remove"))
    control = _control(
        known,
        action,
        F.array(F.lit("blocked")),
        F.col("key").alias("user"),
        trimmed("blocked_user_id").alias("other"),
    )
    mixed = data.unionByName(control, allowMissingColumns=True)
    seen = asof.as_of_stream(mixed, ["user", "other"], "timestamp", delay, salts)
    return asof.without_items(seen)


def masked_messages(
    kept: DataFrame,
    log: DataFrame,
    updates: str = "banned_words",
    delay: str | None = "10 seconds",
    salts: int = 8,
    on_error: str = "skip",
) -> DataFrame:
    """Messages of :func:`unblocked_messages`, masked with the shared words at their time.

    ``kept`` is a stream of its output.  All messages meet the one shared list,
    so they are spread over ``salts`` copies of it.
    """
    data = kept.select(
        F.lit(cl.SHARED_KEY).alias("key"),
        "user",
        "other",
        "message_id",
        "text",
        "timestamp",
        "seq",
        F.lit(asof.DATA).alias("kind"),
    )
    changes = _decoded(log, updates, schemas.WORDS_UPDATE, on_error).select("*", "record.*")
    known = changes.filter(
        (F.col("key") == cl.SHARED_KEY) & F.col("action").isin(cl.REPLACE, cl.ADD, cl.REMOVE)
    )
    words = F.transform("words", normal_word)
    control = _control(known, F.col("action"), words, F.col("key"))
    mixed = data.unionByName(control, allowMissingColumns=True)
    seen = asof.as_of_stream(mixed, ["key"], "timestamp", delay, salts)
    return seen.select(
        F.col("user").alias("recipient_id"),
        F.col("other").alias("sender_id"),
        "message_id",
        mask_each("text", "items").alias("text"),
        "timestamp",
        "seq",
    )


def archived(log: DataFrame) -> DataFrame:
    """Mirrored topics as archive lines, for a text sink partitioned by dataset."""
    copy = logs.mirror(log)
    return copy.select(logs.archive_folder("topic").alias("dataset"), "value")
