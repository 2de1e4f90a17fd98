"""Relational folds against sequential replays, and the chat fixture."""

import random

import pytest
from pyspark.sql import functions as F

from logweave import schemas
from logweave.functions import records
from logweave.functions.times import epoch_micros, parse_instant
from logweave.operators import changelog as cl
from logweave.operators import filters, keyed
from logweave.sources import lake


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_deny_fold(spark, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice("abcd"), rng.choice(["add", "remove", "x"]), rng.choice("abcd"), f"r{i}", i)
        for i in range(rng.randint(1, 25))
    ]
    df = spark.createDataFrame(rows, "key string, action string, product_id string, reason string, offset bigint")
    df = df.withColumn("updated_at", F.col("offset"))
    state, listing = {}, {}
    for key, action, product, reason, _ in rows:
        if action == "add":
            state[key] = (product, reason)
        elif action == "remove":
            state.pop(key, None)
        listing[product] = (action, reason)
    found = {r["key"]: (r["product_id"], r["reason"]) for r in cl.deny_state(df).collect()}
    assert found == state
    assert {r["key"] for r in cl.denied_keys(df).collect()} == set(state)
    wanted = [(p, r) for p, (a, r) in sorted(listing.items()) if a == "add"]
    assert [tuple(r) for r in cl.deny_list(df).collect()] == wanted


def test_unknown_action_is_ignored_by_the_filter_and_hides_in_the_listing(spark):
    df = spark.createDataFrame(
        [("k", "add", "p", "", 0, 0), ("k", "pause", "p", "", 1, 1)],
        "key string, action string, product_id string, reason string, offset bigint, updated_at bigint",
    )
    assert cl.deny_state(df).count() == 1 and cl.deny_list(df).count() == 0
    assert [r["reason"] for r in cl.with_default_reason(df).orderBy("offset").collect()] == [
        "blocked by operator",
        None,
    ]


@pytest.mark.parametrize("seed,page", [(1, 100), (2, 2), (3, 1)])
def test_block_fold(spark, seed, page):
    rng = random.Random(seed)
    rows = []
    for i in range(60):
        user = rng.choice("uvw")
        rows.append((user, user, rng.choice([" a", "b", "c ", "", "d", "e"]), rng.choice(["block", "block", "unblock", "x"]), str(i), i))
    rows.append(("z", "z", "a", "unblock", "60", 60))
    df = spark.createDataFrame(
        rows, "key string, user_id string, blocked_user_id string, action string, updated_at string, offset bigint"
    )
    state = {}
    for key, _, blocked, action, at, _ in rows:
        blocked = blocked.strip()
        if not blocked or action not in ("block", "unblock"):
            continue
        items = state.setdefault(key, [set(), None])
        (items[0].add if action == "block" else items[0].discard)(blocked)
        items[1] = at
    pages = cl.block_lists(df, page_items=page).collect()
    for r in pages:
        assert r["blocked_user_ids"] == sorted(r["blocked_user_ids"])
    found = {}
    for r in pages:
        found.setdefault(r["user"], [[], r["updated_at"]])[0].extend(r["blocked_user_ids"])
    assert {u: [sorted(ids), at] for u, (ids, at) in found.items()} == {
        u: [sorted(ids), at] for u, (ids, at) in state.items()
    }
    pairs = {(r["user"], r["blocked"]) for r in cl.block_pairs(df).collect()}
    assert pairs == {(u, b) for u, (ids, _) in state.items() for b in ids}


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_word_fold(spark, seed):
    rng = random.Random(seed)
    rows = [
        (
            rng.choice(["global", "other"]),
            rng.sample([" A", "b", "C ", "", "d"], rng.randint(0, 3)),
            rng.choice(["add", "add", "remove", "replace", "x"]),
            str(i),
            i,
        )
        for i in range(rng.randint(1, 40))
    ]
    df = spark.createDataFrame(rows, "key string, words array<string>, action string, updated_at string, offset bigint")
    state = {}
    for key, words, action, at, _ in rows:
        words = {w.strip().lower() for w in words} - {""}
        if action == "x":
            continue
        old = state.get(key, (set(), ""))[0]
        new = {"replace": words, "add": old | words, "remove": old - words}[action]
        state[key] = (new, at)
    found = {r["key"]: (set(r["words"]), r["updated_at"]) for r in cl.word_lists(df).collect()}
    assert found == state
    assert {r["word"] for r in filters.shared_words(df).collect()} == state.get("global", (set(),))[0]


CHAT = """# one evening; the second column is a record

global\t{"words":["nettle"],"action":"add","updated_at":"2019-11-30T21:00:00Z"}
odo\t{"message_id":"a","sender_id":"pia","recipient_id":"odo","text":"Nettle soup again","created_at":"2019-11-30T21:05:00Z"}
pia\t{"message_id":"b","sender_id":"odo","recipient_id":"pia","text":"fern salad, no nettle","created_at":"2019-11-30T21:06:00Z"}
global\t{"words":["fern"],"action":"add","updated_at":"2019-11-30T21:10:00Z"}
pia\t{"message_id":"c","sender_id":"rex","recipient_id":"pia","text":"fern; nettle; FERN","created_at":"2019-11-30T21:12:00Z"}
pia\t{"user_id":"pia","blocked_user_id":"rex","action":"block","updated_at":"2019-11-30T21:15:00Z"}
pia\t{"message_id":"d","sender_id":"rex","recipient_id":"pia","text":"why so quiet","created_at":"2019-11-30T21:16:00Z"}
# rex may still be written to
rex\t{"message_id":"e","sender_id":"pia","recipient_id":"rex","text":"nothing personal","created_at":"2019-11-30T21:17:00Z"}
global\t{"words":["nettle"],"action":"remove","updated_at":"2019-11-30T21:20:00Z"}
odo\t{"message_id":"f","sender_id":"rex","recipient_id":"odo","text":"nettle or fern","created_at":"2019-11-30T21:21:00Z"}
odo\t{"user_id":"odo","blocked_user_id":"pia","action":"block","updated_at":"2019-11-30T21:25:00Z"}
odo\t{"message_id":"g","sender_id":"pia","recipient_id":"odo","text":"good night","created_at":"2019-11-30T21:26:00Z"}
"""
DELIVERED = {
    "a": "****** soup again",
    "b": "fern salad, no ******",
    "c": "****; ******; ****",
    "e": "nothing personal",
    "f": "nettle or ****",
}


def chat_tables(rows):
    """Messages, block events and word updates of a keyed text, placed by their own time."""

    def typed(schema, time):
        decoded = records.apply_policy(records.decode(rows, schema), "fail")
        flat = decoded.select("key", "record.*", F.col("row_order").alias("seq"))
        return flat.withColumn("pos", epoch_micros(parse_instant(time)))

    messages = typed(schemas.CHAT_MESSAGE, "created_at").filter("message_id <> ''")
    events = typed(schemas.BLOCK_EVENT, "updated_at").filter("blocked_user_id <> ''")
    updates = typed(schemas.WORDS_UPDATE, "updated_at").filter("words IS NOT NULL")
    return messages, events, updates


@pytest.mark.parametrize("limit", [None, 1])
def test_chat_fixture(spark, tmp_path, limit):
    (tmp_path / "chat.txt").write_text(CHAT)
    rows = lake.read_keyed_text(spark, str(tmp_path / "chat.txt"))
    assert rows.count() == 12
    messages, events, updates = chat_tables(rows)
    found = filters.chat(messages, events, updates, rows_per_piece=limit)
    assert {r["message_id"]: r["text"] for r in found.collect()} == DELIVERED
    # Against the final state, blocks that came after a message stop it too, and only the last word list masks.
    kept = filters.block_filter(messages, events, order=("seq",)).collect()
    assert sorted(r["message_id"] for r in kept) == ["b", "e", "f"]
    masked = {r["message_id"]: r["text"] for r in filters.censor(messages, updates, order=("seq",)).collect()}
    assert masked["a"] == "Nettle soup again" and masked["c"] == "****; nettle; ****"


@pytest.mark.parametrize("seed,limit", [(1, None), (2, 7)])
def test_mask_as_of_random(spark, seed, limit):
    rng = random.Random(seed)
    vocabulary = ["ab", "b c", "x", "abx", "c"]
    updates = []
    for i in range(25):
        words = rng.sample(vocabulary, rng.randint(0, 2))
        updates.append((rng.choice(["global", "global", "other"]), words, rng.choice(["add", "remove", "replace", "no"]), i * 10, i))
    messages = [(i, " ".join(rng.choice("ab abx b c x c y".split()) for _ in range(6)), rng.randint(0, 260), 1000 + i) for i in range(60)]
    u = spark.createDataFrame(updates, "key string, words array<string>, action string, pos bigint, seq bigint")
    m = spark.createDataFrame(messages, "message_id int, text string, pos bigint, seq bigint")
    found = {r["message_id"]: r["text"] for r in filters.mask_as_of(m, u, rows_per_piece=limit).collect()}
    from test_text import plain_mask

    for mid, text, pos, _ in messages:
        words = set()
        for key, given, action, at, _ in updates:
            if key != "global" or at > pos or action == "no":
                continue
            given = set(given)
            words = {"replace": given, "add": words | given, "remove": words - given}[action]
        assert found[mid] == plain_mask(text, sorted(words))


def test_upsert_and_insert_ignore(spark):
    target = spark.createDataFrame([("a", "old", 9), ("b", "old", 9)], "id string, v string, updated int")
    arrivals = spark.createDataFrame(
        [("a", "late-date", 5, 0), ("a", "early-date", 1, 1), ("c", "new", 3, 2), ("c", "newer", 2, 3)],
        "id string, v string, updated int, offset int",
    )
    merged = {tuple(r) for r in keyed.upsert(target, arrivals, ["id"], ["offset"]).collect()}
    assert merged == {("a", "early-date", 1), ("b", "old", 9), ("c", "newer", 2)}
    null_key = spark.createDataFrame([(None, "old", 1)], "id string, v string, updated int")
    replaced = keyed.upsert(null_key, arrivals.withColumn("id", F.lit(None).cast("string")), ["id"], ["offset"])
    assert [tuple(r) for r in replaced.collect()] == [(None, "newer", 2)]
    ignored = {tuple(r) for r in keyed.insert_ignore(target, arrivals, ["id"], ["offset"]).collect()}
    assert ignored == {("a", "old", 9), ("b", "old", 9), ("c", "new", 3)}


def test_empty_time_becomes_log_time(spark):
    df = spark.createDataFrame([("", "2026-05-15 00:00:01.25"), ("t", "2026-05-15 00:00:01")], "updated_at string, ts string")
    out = cl.with_log_time(df.withColumn("timestamp", F.col("ts").cast("timestamp"))).collect()
    assert [r["updated_at"] for r in out] == ["2026-05-15T00:00:01.25Z", "t"]


def test_merges_read_arrivals_once_and_bring_keys_together_before_they_sort(spark, monkeypatch):
    seen, settled, plans = spark.sparkContext.accumulator(0), keyed.settled, []

    def noted(df, label):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return settled(df, label)

    monkeypatch.setattr(keyed, "settled", noted)
    read = F.udf(lambda v: seen.add(1) or v, "string")
    target = spark.createDataFrame([("a", "old", 0), ("z", "old", 0)], "id string, v string, offset int")
    rows = [("hot" if n % 4 else f"k{n}", f"v{n}", n) for n in range(200)]
    arrivals = spark.createDataFrame(rows, "id string, v string, offset int").withColumn("v", read("v"))
    found = {r["id"]: r["v"] for r in keyed.upsert(target, arrivals, ["id"], ["offset"]).collect()}
    assert found == {"a": "old", "z": "old", "hot": "v199", **{f"k{n}": f"v{n}" for n in range(0, 200, 4)}}
    assert seen.value == 200
    # The shuffle that brings keys together lies below both aggregates.
    lines = [line for line in plans[0].splitlines() if "Aggregate" in line or "Exchange" in line or "Rebalance" in line]
    assert "REBALANCE" in lines[-1].upper()
