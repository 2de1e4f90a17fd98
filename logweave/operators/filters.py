"""Filters and masks driven by changelogs, against a snapshot or as of event time.

As-of forms are the specification of the streaming filters: a data row sees
the control events at or before its own time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.functions.text import (
    is_run,
    listed_candidates,
    mask_each,
    mask_listed,
    mask_with,
    normal_word,
    probe,
    runs,
)
from logweave.operators import changelog as cl
from logweave.operators.validate import deliverable
from logweave.plans import pieces, sizing

# Up to this many words are masked by a fixed chain of patterns, and up to this many
# by a lookup within the row; both without a shuffle.
CHAIN_WORDS = 8
LISTED_WORDS = 1000

# Is a row stopped by the last control event before it?
STOPPED = "__stopped"


def deny_filter(
    products: DataFrame, commands: DataFrame, key: str = "key", order: Sequence[str] = ("offset",)
) -> DataFrame:
    """Products whose key is not denied after all commands."""
    denied = sizing.small_side(cl.denied_keys(commands, key, order))
    return products.join(denied, key, "left_anti")


def deny_filter_as_of(
    products: DataFrame,
    commands: DataFrame,
    key: str = "key",
    position: str = "pos",
    sequence: str = "seq",
    rows_per_piece: int | None = None,
) -> DataFrame:
    """Products whose key was not denied at their time."""
    control = commands.filter(F.col("action").isin(cl.ADD, cl.REMOVE)).select(
        key, position, sequence, (F.col("action") == cl.ADD).alias(STOPPED)
    )
    seen = pieces.as_of(products, control, [key], position, sequence, STOPPED, rows_per_piece)
    return seen.filter(~F.coalesce(STOPPED, F.lit(False))).drop(STOPPED)


def block_filter(
    messages: DataFrame, events: DataFrame, key: str = "key", order: Sequence[str] = ("offset",)
) -> DataFrame:
    """Messages whose recipient has not blocked the sender after all events.

    The list membership test becomes a pair anti join: no arrays to scan or ship.
    """
    pairs = cl.block_pairs(events, key, order).select(
        F.col("user").alias("recipient_id"), F.col("blocked").alias("sender_id")
    )
    return messages.join(sizing.small_side(pairs), ["recipient_id", "sender_id"], "left_anti")


def block_filter_as_of(
    messages: DataFrame,
    events: DataFrame,
    key: str = "key",
    position: str = "pos",
    sequence: str = "seq",
    rows_per_piece: int | None = None,
) -> DataFrame:
    control = cl.valid_block_events(events, key).select(
        F.col("user").alias("recipient_id"),
        F.col("blocked").alias("sender_id"),
        position,
        sequence,
        F.col("on").alias(STOPPED),
    )
    seen = pieces.as_of(
        messages, control, ["recipient_id", "sender_id"], position, sequence, STOPPED, rows_per_piece
    )
    return seen.filter(~F.coalesce(STOPPED, F.lit(False))).drop(STOPPED)


# --- masking -----------------------------------------------------------------


def _vocabulary(words: DataFrame, boundary: str = "ascii") -> DataFrame:
    """Distinct normalised words with the run texts are looked up by."""
    normal = words.select(normal_word("word").alias("word")).filter("word <> ''").distinct()
    return normal.withColumn("run", probe("word", boundary))


def word_candidates(
    messages: DataFrame,
    words: DataFrame,
    keep: Sequence[str],
    text: str,
    listed_words: int = LISTED_WORDS,
    boundary: str = "ascii",
) -> DataFrame:
    """(``keep``..., word) for every message that holds the probe run of a word.

    A list of at most ``listed_words`` is looked up within the row.  A longer
    one is an equi-join on runs that moves ids and runs, never whole texts.
    """
    probed = _vocabulary(words, boundary)
    few = sizing.at_most(probed, listed_words)
    if few is not None:
        found = listed_candidates(text, [(r["word"], r["run"]) for r in few], boundary)
        return messages.select(*keep, F.explode(found).alias("word"))
    # Words made of stars and marks alone match what another word's mask has left, or a text's own stars.
    late = ~is_run("run", boundary) & F.contains(F.col("word"), F.lit("*"))
    kinds = probed.agg(F.bool_or(late).alias("late"), F.bool_or(~is_run("run", boundary)).alias("gaps")).first()
    found = runs(text, bool(kinds["gaps"]), boundary)
    held = messages.select(*keep, F.explode(found).alias("run"))
    plain = held.join(sizing.small_side(probed.filter(~late)), "run").select(*keep, "word")
    if not kinds["late"]:
        return plain
    plain = sizing.settled(plain, "candidates")
    starred = messages.filter(F.contains(text, F.lit("*"))).select(*keep)
    after = plain.select(*keep).union(starred).distinct()
    return plain.union(_with_each(after, probed.filter(late).select("word"), listed_words))


def _with_each(rows: DataFrame, words: DataFrame, at_once: int) -> DataFrame:
    """Rows with each of a few ``words``: all of them can match, so all are candidates.

    Up to ``at_once`` words are held by the row itself.  More of them are dealt over
    as many groups, and each row goes to every group, so no task has them all.
    """
    few = sizing.at_most(words, at_once)
    if few is not None:
        listed = F.array(*(F.lit(r["word"]) for r in few)).cast("array<string>")
        return rows.select("*", F.explode(listed).alias("word"))
    groups = -(-words.count() // max(1, at_once))
    dealt = words.withColumn("__group", F.pmod(F.xxhash64("word"), F.lit(groups)))
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<bigint>")).alias("__group")
    return rows.select("*", every).join(dealt, "__group").drop("__group")


def _apply_candidates(
    messages: DataFrame, pairs: DataFrame, id_col: str, text: str, boundary: str
) -> DataFrame:
    lists = pairs.groupBy(F.col(id_col).alias("__id")).agg(
        F.array_sort(F.collect_set("word")).alias("__words")
    )
    masked = F.when(F.col("__words").isNull(), F.col(text)).otherwise(
        mask_each(text, "__words", boundary)
    )
    return (
        messages.join(lists, F.col(id_col) == F.col("__id"), "left")
        .withColumn(text, masked)
        .drop("__id", "__words")
    )


def mask_snapshot(
    messages: DataFrame,
    words: DataFrame,
    id_col: str = "message_id",
    text: str = "text",
    boundary: str = "ascii",
    chain_words: int = CHAIN_WORDS,
    listed_words: int = LISTED_WORDS,
) -> DataFrame:
    """Mask with a relation of words (column ``word``), its length looked at first.

    A short list becomes a chain of literal patterns and a longer one a lookup
    within the row: no shuffle.  A list above ``listed_words`` is joined to the
    texts by run.  In the last two a text meets only the words it may contain.
    """
    most = max(chain_words, listed_words)
    few = sizing.at_most(_vocabulary(words, boundary), most) if most else None
    if few is not None and len(few) <= chain_words:
        ordered = sorted((r["word"] for r in few), key=str.encode)
        return messages.withColumn(text, mask_with(text, ordered, boundary))
    if few is not None and len(few) <= listed_words:
        return messages.withColumn(text, mask_listed(text, [(r["word"], r["run"]) for r in few], boundary))
    pairs = word_candidates(messages, words, [id_col], text, listed_words, boundary)
    return _apply_candidates(messages, pairs, id_col, text, boundary)


def shared_words(updates: DataFrame, key: str = "key", order: Sequence[str] = ("offset",)) -> DataFrame:
    """Words in force under the shared key; other keys have no effect on masking."""
    shared = updates.filter(F.col(key) == cl.SHARED_KEY)
    return cl.active_words(shared, key, order).select("word")


def censor(
    messages: DataFrame, updates: DataFrame, key: str = "key", order: Sequence[str] = ("offset",)
) -> DataFrame:
    """Valid messages, masked with the shared words after all updates."""
    valid = messages.filter(deliverable())
    return mask_snapshot(valid, shared_words(updates, key, order))


def mask_as_of(
    messages: DataFrame,
    updates: DataFrame,
    key: str = "key",
    position: str = "pos",
    sequence: str = "seq",
    id_col: str = "message_id",
    text: str = "text",
    rows_per_piece: int | None = None,
) -> DataFrame:
    """Mask each message with the shared words in force at its time.

    Changes and replaces become the intervals in which each word is in force.  The
    (id, word) pairs a text may contain look up the last interval begun before
    them, so no list is rebuilt per update and texts without any listed word take
    no part.
    """
    shared = updates.filter(F.col(key) == cl.SHARED_KEY)
    found = sizing.settled(word_intervals(shared, key, position, sequence, rows_per_piece), "intervals")
    return mask_in_force(messages, found, position, sequence, id_col, text, rows_per_piece)


def word_intervals(
    shared: DataFrame,
    key: str = "key",
    position: str = "pos",
    sequence: str = "seq",
    rows_per_piece: int | None = None,
) -> DataFrame:
    """(word, position, sequence, until): from where to where each word is in force.

    An interval begins with an addition or a replace that names the word and ends
    with the next change of the word or the next replace, whichever comes first;
    ``until`` is that event's (position, sequence), null while the word is in force.
    """
    at = F.struct(F.col(position).alias("pos"), F.col(sequence).alias("seq"))
    back = {"__back": -F.col(position), "__back_seq": -F.col(sequence)}
    changes = cl.word_changes(shared, key, (position, sequence)).select("word", "on", position, sequence)
    changes = changes.withColumns({**back, "__at": at})
    # Read from the end, what comes next has come before.
    split = pieces.cut(changes, ["word"], "__back", rows_per_piece)
    begun = split.last_known(["__back", "__back_seq"], "__at", "__next", strictly_before=True).rows().filter("on")
    resets = shared.filter(F.col("action") == cl.REPLACE).select(
        position, sequence, at.alias("__reset"), F.lit(1).alias("__kind")
    )
    both = begun.drop("__at").withColumn("__kind", F.lit(0)).unionByName(
        resets.withColumns(back), allowMissingColumns=True
    )
    # All words end with a replace: one key, of changes alone, cut along time where there are many.
    split = pieces.cut(both.withColumn("__whole_list", F.lit(0)), ["__whole_list"], "__back", rows_per_piece)
    seen = split.last_known(["__back", "__back_seq", "__kind"], "__reset", "__ends", strictly_before=True)
    until = F.least("__next", "__ends").alias("until")
    return seen.filter(F.col("__kind") == 0).rows().select("word", position, sequence, until)


def mask_in_force(
    messages: DataFrame,
    intervals: DataFrame,
    position: str = "pos",
    sequence: str = "seq",
    id_col: str = "message_id",
    text: str = "text",
    rows_per_piece: int | None = None,
) -> DataFrame:
    """Mask each message with the words whose interval (see :func:`word_intervals`) holds its time."""
    # Settled: ids and words only, and texts are taken apart once.
    pairs = word_candidates(messages, intervals, [id_col, position, sequence], text)
    begun = intervals.select("word", position, sequence, F.struct("until").alias("__begun"))
    seen = pieces.as_of(sizing.settled(pairs, "pairs"), begun, ["word"], position, sequence, "__begun", rows_per_piece)
    until = F.col("__begun.until.pos")
    active = seen.filter(F.col("__begun").isNotNull() & (until.isNull() | (until > F.col(position))))
    return _apply_candidates(messages, active.select(id_col, "word"), id_col, text, "ascii")


def chat(
    messages: DataFrame,
    events: DataFrame,
    updates: DataFrame,
    key: str = "key",
    position: str = "pos",
    sequence: str = "seq",
    rows_per_piece: int | None = None,
) -> DataFrame:
    """Delivered messages as of their time: valid, not blocked, masked.

    Blocking goes first: same result as masking first, fewer texts to mask.
    """
    valid = messages.filter(deliverable())
    kept = block_filter_as_of(valid, events, key, position, sequence, rows_per_piece)
    kept = sizing.settled(kept, "unblocked")
    return mask_as_of(kept, updates, key, position, sequence, rows_per_piece=rows_per_piece)
