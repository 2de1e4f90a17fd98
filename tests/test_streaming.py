"""Streams give what the batch operators give, also when cut in files and restarted."""

import json
import random

import pytest
from pyspark.sql import functions as F

from logweave import schemas
from logweave.catalogue import queries
from logweave.operators import filters, keyed
from logweave.sources import generate
from logweave.streaming import asof, jobs, sinks


def write(spark, rows, path):
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, key string, value string, t double")
    df.withColumn("timestamp", F.timestamp_seconds("t")).drop("t").coalesce(1).write.mode("append").parquet(path)


def closing(topic, offset, t):
    return (topic, 0, offset, "", "{}", t + 86400.0)


@pytest.mark.parametrize("salts", [1, 3])
def test_deny_stream_equals_as_of_and_survives_restart(spark, tmp_path, salts):
    rng = random.Random(salts)
    rows = []
    for i in range(160):
        key = rng.choice("hhha")
        t = 1_700_000_000 + i + rng.choice([0.0, 0.25, 0.000001])
        if rng.random() < 0.5:
            rows.append(("products.raw", 0, i, key, json.dumps({"product_id": key, "name": f"p{i}"}), t))
        else:
            action = rng.choice(["add", "remove", "pause"])
            rows.append(("blacklist.commands", 0, i, key, json.dumps({"action": action, "product_id": key}), t))
    path, out, ckpt = (str(tmp_path / n) for n in ("log", "out", "ckpt"))
    log = spark.readStream.schema(schemas.LOG).option("maxFilesPerTrigger", 1)

    def run():
        stream = jobs.filter_products(log.parquet(path), delay="1 hour", salts=salts)
        sinks.run(stream, ckpt, out).awaitTermination()
        return stream.schema

    shuffled = rows[:80]
    rng.shuffle(shuffled)
    for part in (shuffled[:40], shuffled[40:]):
        write(spark, part, path)
    run()
    write(spark, rows[80:], path)
    write(spark, [closing("products.raw", 1000, rows[-1][5])], path)
    schema = run()
    found = [r["seq"] for r in spark.read.schema(schema).parquet(out).collect()]
    assert len(found) == len(set(found))

    flat = [(r[3], round(r[5] * 1_000_000), r[2], json.loads(r[4])) for r in rows]
    data = [(k, p, s) for (k, p, s, v), r in zip(flat, rows) if r[0] == "products.raw"]
    control = [(k, p, s, v["action"]) for (k, p, s, v), r in zip(flat, rows) if r[0] != "products.raw"]
    batch = filters.deny_filter_as_of(
        spark.createDataFrame(data, "key string, pos bigint, seq bigint"),
        spark.createDataFrame(control, "key string, pos bigint, seq bigint, action string"),
    )
    assert sorted(found) == sorted(r["seq"] for r in batch.collect())


def test_nothing_is_held_back_or_lost_without_a_delay(spark, tmp_path):
    path, out, ckpt = (str(tmp_path / n) for n in ("log", "out", "ckpt"))
    log = spark.readStream.schema(schemas.LOG).option("maxFilesPerTrigger", 1)

    def product(n, key, t):
        return ("products.raw", 0, n, key, json.dumps({"product_id": key, "name": f"p{n}"}), 1_700_000_000.0 + t)

    def command(n, key, action, t):
        return ("blacklist.commands", 0, n, key, json.dumps({"action": action, "product_id": key}), 1_700_000_000.0 + t)

    def run():
        accepted = jobs.filter_products(log.parquet(path), delay=None, on_error="quarantine")
        sinks.run(accepted, ckpt, out).awaitTermination()
        return sorted(r["seq"] for r in spark.read.schema(accepted.schema).parquet(out).collect())

    write(spark, [product(0, "a", 10), product(1, "b", 11), command(2, "a", "add", 12), product(3, "a", 13)], path)
    assert run() == [0, 1]
    # Far in the past, and the last row of the input: both decided by what is known now.
    write(spark, [product(4, "b", -90000), product(5, "a", 14), ("products.raw", 0, 6, "b", "no json", 1.7e9)], path)
    assert run() == [0, 1, 4]
    bad = jobs.rejected(spark.read.schema(schemas.LOG).parquet(path), "products.raw", schemas.PRODUCT).collect()
    assert [(r["offset"], r["value"]) for r in bad] == [(6, "no json")]


def test_hot_keys_of_a_micro_batch_are_cut(spark, tmp_path, monkeypatch):
    """The query holds no key's rows in one processor, and batches in turn equal the log as a whole."""
    rng = random.Random(5)
    rows = []
    for i in range(120):
        key = rng.choice("hhhha")
        t = 1_700_000_000.0 + i // 3
        action = rng.choice(["add", "remove", "pause"])
        value = {"product_id": key, "name": "p"} if i % 2 else {"action": action, "product_id": key}
        rows.append(("products.raw" if i % 2 else "blacklist.commands", 0, i, key, json.dumps(value), t))
    path, out, ckpt, state = (str(tmp_path / n) for n in ("log", "out", "ckpt", "state"))
    writer = jobs.filter_products_writer(out, state, rows_per_piece=7)
    for first in (0, 60):
        write(spark, rows[first : first + 60], path)
        log = spark.readStream.schema(schemas.LOG).parquet(path)
        sinks.run(log, ckpt, writer=writer).awaitTermination()
    wanted, denied = [], set()
    for topic, _, i, key, value, _ in sorted(rows, key=lambda r: (r[5], r[0] == "products.raw", r[2])):
        if topic == "products.raw":
            wanted += [] if key in denied else [i]
        else:
            denied = asof.changed(denied, json.loads(value)["action"], [key]) if "pause" not in value else denied
    assert sorted(r["seq"] for r in spark.read.parquet(out).collect()) == sorted(wanted)
    # A replayed batch sees what came before it, not what it wrote itself.
    writer(spark.read.schema(schemas.LOG).parquet(path).filter("offset >= 60"), 1)
    assert sorted(r["seq"] for r in spark.read.parquet(out).collect()) == sorted(wanted)

    def held(*_):
        raise AssertionError("rows of a key are sorted in one processor")

    monkeypatch.setattr(asof, "DecideAtOnce", held)
    assert queries.all_queries()["q_stream_deny"](spark, "/root/testdata/sf0.001").count() > 0


def test_ranges_are_batches_that_many_tasks_write(spark, tmp_path):
    src, ckpt, seen = str(tmp_path / "in"), str(tmp_path / "c"), []
    rows = spark.range(400).select(F.col("id").alias("seq")).repartition(5)

    def write(batch, batch_id):
        found = batch.agg(F.min("seq"), F.max("seq"), F.count("seq")).first()
        seen.append((*found, len(list((tmp_path / "in").glob("*/part-*")))))

    queries._in_turn(
        rows,
        queries._range_of(rows, F.col("seq"), 4),
        src,
        lambda: sinks.run(spark.readStream.schema(rows.schema).parquet(src), ckpt, writer=write),
    )
    assert len(seen) == 4 and sum(n for _, _, n, _ in seen) == 400
    assert all(a[1] < b[0] for a, b in zip(seen, seen[1:]))
    assert all(b[3] - a[3] > 1 for a, b in zip([(0, 0, 0, 0), *seen], seen))


def test_requests_are_never_inserted_twice(spark, tmp_path):
    src, path = str(tmp_path / "in"), str(tmp_path / "table")
    schema = "request_id string, body string, offset bigint"
    for rows in ([("a", "1", 0), ("a", "2", 1)], [("b", "1", 2), ("a", "3", 3)], [("a", "4", 4)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        writer = sinks.insert_ignore_writer(path, ["request_id"], ["offset"])
        sinks.run(stream, str(tmp_path / "c"), writer=writer).awaitTermination()
    found = sinks.read_first(spark, path, spark.createDataFrame([], schema).schema, ["request_id"], ["offset"])
    assert sorted(map(tuple, found.collect())) == [("a", "1", 0), ("b", "1", 2)]


def test_gate_quarantines_null_verdicts(spark, tmp_path):
    good, bad, report = (str(tmp_path / n) for n in ("good", "bad", "report"))
    rows = spark.createDataFrame(
        [("t", 0, 0, True), ("t", 0, 1, None), ("t", 0, 2, False)], "topic string, partition int, offset bigint, bad boolean"
    )
    sinks.gate_writer(good, bad, report, F.col("bad"))(rows, 0)
    assert [r["offset"] for r in spark.read.parquet(good).collect()] == [2]
    assert sorted(r["offset"] for r in spark.read.parquet(bad).collect()) == [0, 1]
    assert [(r["rows"], r["commit"]) for r in sinks.close_gate(spark, report).collect()] == [(3, False)]


def test_chat_stream(spark, tmp_path):
    from test_changelog import CHAT, DELIVERED

    topics = {"words": "banned_words", "blocked_user_id": "blocked_users", "message_id": "messages"}
    rows = []
    for line in CHAT.splitlines():
        if line and not line.startswith("#"):
            key, value = line.split("\t")
            topic = next(t for field, t in topics.items() if field in json.loads(value))
            rows.append((topic, 0, len(rows), key, value, 1_700_000_000.0 + 60 * len(rows)))
    far = rows[-1][5]
    message = json.dumps({"sender_id": "end", "recipient_id": "end", "message_id": "end", "text": ""})
    rows.append(("messages", 0, 100, "end", message, far + 86400))
    rows.append(("messages", 0, 101, "end", message, far + 2 * 86400))
    path, mid, out = (str(tmp_path / n) for n in ("log", "kept", "out"))
    write(spark, rows, path)
    read = spark.readStream.schema(schemas.LOG)
    kept = jobs.unblocked_messages(read.parquet(path))
    sinks.run(kept, str(tmp_path / "c1"), mid).awaitTermination()
    masked = jobs.masked_messages(
        spark.readStream.schema(kept.schema).parquet(mid), read.parquet(path), salts=2
    )
    sinks.run(masked, str(tmp_path / "c2"), out).awaitTermination()
    found = {r["message_id"]: r["text"] for r in spark.read.schema(masked.schema).parquet(out).collect()}
    assert {k: v for k, v in found.items() if k != "end"} == DELIVERED


def test_upsert_deltas(spark, tmp_path):
    src, path = str(tmp_path / "in"), str(tmp_path / "table")
    schema = "id string, v string, offset bigint"

    def push(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        writer = sinks.upsert_writer(path, ["id"], ["offset"])
        sinks.run(stream, str(tmp_path / "c"), writer=writer).awaitTermination()

    push([("a", "1", 0), ("a", "2", 1), ("b", "1", 2)])
    push([("a", "3", 3), ("c", "1", 4)])
    table_schema = spark.createDataFrame([], schema).schema
    table = sinks.read_table(spark, path, table_schema, ["id"], ["offset"])
    wanted = {("a", "3", 3), ("b", "1", 2), ("c", "1", 4)}
    assert set(map(tuple, table.collect())) == wanted
    sinks.fold(spark, path, str(tmp_path / "base"), table_schema, ["id"], ["offset"])
    folded = sinks.read_table(spark, str(tmp_path / "base"), table_schema, ["id"], ["offset"])
    assert set(map(tuple, folded.collect())) == wanted
    # A replayed batch overwrites its own folder.
    writer = sinks.upsert_writer(path, ["id"], ["offset"])
    writer(spark.createDataFrame([("a", "3", 3), ("c", "1", 4)], schema), 1)
    assert set(map(tuple, sinks.read_table(spark, path, table_schema, ["id"], ["offset"]).collect())) == wanted


def test_batch_gate_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [("t", 0, i, "k", "bad" if i == 13 else "{}", 1_700_000_000.0) for i in range(27)]
    write(spark, rows, src)
    good, bad, report = (str(tmp_path / n) for n in ("good", "bad", "report"))
    stream = spark.readStream.schema(schemas.LOG).parquet(src)
    writer = sinks.gate_writer(good, bad, report, F.try_parse_json("value").isNull())
    sinks.run(stream, str(tmp_path / "c"), writer=writer).awaitTermination()
    assert (spark.read.parquet(good).count(), spark.read.parquet(bad).count()) == (26, 1)
    gates = sinks.close_gate(spark, report).orderBy("first_offset").collect()
    assert [(r["rows"], r["commit"], r["full"]) for r in gates] == [(10, True, True), (10, False, True), (7, True, False)]


def test_set_fold():
    assert asof.changed({"a"}, "add", ["b", ""]) == {"a", "b"}
    assert asof.changed({"a"}, "remove", ["a"]) == set()
    assert asof.changed({"a"}, "replace", ["c"]) == {"c"}


def test_generator_stream(spark):
    stream = generate.order_messages(generate.number_stream(spark, 50), "i")
    query = stream.writeStream.format("memory").queryName("made").start()
    try:
        for _ in range(100):
            query.processAllAvailable()
            if spark.table("made").count():
                break
        assert spark.table("made").filter("order_id like 'order-0000%'").count() > 0
    finally:
        query.stop()


def test_first_requests_is_keyed(spark):
    df = spark.createDataFrame([("r", 1), ("r", 2)], "request_id string, n int")
    assert keyed.first(df, ["request_id"], ["n"]).first()["n"] == 1


class _Held:
    """State of one key, and how often its chunks are read and written."""

    def __init__(self):
        self.maps, self.values, self.timers, self.calls = {}, {}, [], 0

    def getMapState(self, name, *_):
        held, chunks = self, self.maps.setdefault(name, {})

        class Map:
            def keys(self):
                return iter(list(chunks))

            def getValue(self, key):
                held.calls += 1
                return chunks[tuple(key)]

            def updateValue(self, key, value):
                held.calls += 1
                chunks[tuple(key)] = value

            def removeKey(self, key):
                del chunks[tuple(key)]

        return Map()

    def getValueState(self, name, *_):
        values = self.values

        class Value:
            def exists(self):
                return name in values

            def get(self):
                return values[name]

            def update(self, value):
                values[name] = value

        return Value()

    def registerTimer(self, at):
        self.timers.append(at)


class _At:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at

    def getExpiryTimeInMs(self):
        return self.at


def _hold(**sizes):
    from pyspark.sql.types import StructType

    held = StructType.fromDDL("seq long, kind int, action string, arguments array<string>, pos long")
    hold, handle = asof.HoldInChunks(held, ["seq"], **sizes), _Held()
    hold.init(handle)
    return hold, handle


def _fired(hold, handle, mark):
    """What the timers give that a watermark fires, until none is left."""
    out = []
    while due := sorted(t for t in handle.timers if t <= mark):
        handle.timers.remove(due[0])
        out += hold.handleExpiredTimer(("k",), _At(mark), _At(due[0]))
    return out


def test_held_rows_cost_state_calls_per_chunk_not_per_row():
    from pyspark.sql import Row

    hold, handle = _hold()
    rows = [Row(seq=i, kind=asof.DATA, action=None, arguments=None, pos=i * 5_000_000) for i in range(5_000)]
    assert list(hold.handleInputRows(("k",), iter(rows), _At(0))) == []
    assert [r["seq"] for r in _fired(hold, handle, 5_000 * 5_000)] == list(range(5_000))
    assert handle.calls <= 20 and not any(handle.maps.values())


@pytest.mark.parametrize("sizes", [{"run_rows": 7, "chunk_rows": 3}, {"run_rows": 40, "chunk_rows": 5}, {}])
def test_chunks_release_what_the_watermark_has_passed(sizes):
    """Random arrivals and watermarks against a list of all rows, late ones and repeats included."""
    from pyspark.sql import Row

    for seed in range(20):
        rng, (hold, handle) = random.Random(seed), _hold(**sizes)
        waiting, denied, last, mark, n = [], set(), None, 0, 0

        def replay(rows, late):
            nonlocal denied, last
            told = []
            for r in sorted(rows, key=asof._turn):
                if r["kind"] == asof.DATA:
                    told.append((r["seq"], sorted(denied), late))
                elif last is None or (r["pos"] is not None and r["pos"] >= last):
                    denied, last = asof.changed(denied, r["action"], r["arguments"]), r["pos"]
            return told

        for _ in range(8):
            batch = []
            for _ in range(rng.randrange(40)):
                n += 1
                pos = None if rng.random() < 0.03 else mark * 1000 + rng.randrange(-3_000_000, 20_000_000)
                kind = rng.choice([asof.DATA, asof.CONTROL])
                action = rng.choice(["add", "remove"])
                batch.append(Row(seq=n, kind=kind, action=action, arguments=[rng.choice("ab")], pos=pos))
            batch += [b for b in batch if rng.random() < 0.1]
            end = lambda r: (r["pos"] // 1_000_000 + 1) * 1000
            late = [r for r in batch if r["pos"] is None or end(r) <= mark]
            waiting += [r for r in batch if r not in late]
            found = list(hold.handleInputRows(("k",), iter(batch), _At(mark)))
            mark += rng.randrange(9_000)
            wanted = replay(late, True) + replay([r for r in waiting if end(r) <= mark], False)
            waiting = [r for r in waiting if end(r) > mark]
            found += _fired(hold, handle, mark)
            assert [(r["seq"], list(r["items"]), r["late"]) for r in found] == wanted


def _packed_hold(**sizes):
    from pyspark.sql.types import StructType

    held = StructType.fromDDL("seq long, kind int, action string, arguments array<string>, pos long")
    hold, handle = asof.HoldPacked(held, ["seq"], **sizes), _Held()
    hold.init(handle)
    return hold, handle, held


def _packs(rows, held, size=7):
    """Rows of one key as a map task packs them, so many at a time."""
    import pyarrow as pa
    from pyspark.sql import Row

    given = pa.schema([pa.field("key", pa.string()), *asof._columns(held)])
    for at in range(0, len(rows), size):
        table = pa.Table.from_pylist([{"key": "k", **r.asDict()} for r in rows[at : at + size]], given)
        for batch in asof.packed(["key"], held)(iter(table.to_batches())):
            yield from (Row(rows=blob) for blob in batch["rows"].to_pylist())


def _told(rows):
    import pyarrow as pa

    schema = pa.schema([("seq", pa.int64()), ("items", pa.list_(pa.string())), ("late", pa.bool_())])
    found = [pa.ipc.read_record_batch(pa.py_buffer(r["rows"]), schema).to_pylist() for r in rows]
    return [(r["seq"], r["items"], r["late"]) for pack in found for r in pack]


def test_rows_reach_the_hold_in_packs_and_not_one_by_one():
    from pyspark.sql import Row

    hold, handle, held = _packed_hold()
    rows = [Row(seq=i, kind=asof.DATA, action=None, arguments=None, pos=i * 5_000_000) for i in range(5_000)]
    packs = list(_packs(rows, held, size=5_000))
    assert len(packs) == 1
    assert list(hold.handleInputRows(("k",), iter(packs), _At(0))) == []
    found = _fired(hold, handle, 5_000 * 5_000)
    assert len(found) == 1 and [seq for seq, _, _ in _told(found)] == list(range(5_000))
    assert handle.calls <= 20 and not any(handle.maps.values())


@pytest.mark.parametrize("sizes", [{"run_rows": 7, "chunk_rows": 3}, {"run_rows": 40, "chunk_rows": 5}, {}])
@pytest.mark.parametrize("result_items", [1, 3, 500_000])
def test_packed_rows_come_out_as_single_rows_do(monkeypatch, sizes, result_items):
    """Random arrivals and watermarks: the same as the hold that takes rows one by one."""
    from pyspark.sql import Row

    monkeypatch.setattr(asof, "RESULT_ITEMS", result_items)
    for seed in range(15):
        rng, mark, n = random.Random(seed), 0, 0
        (plain, plain_handle), (hold, handle, held) = _hold(**sizes), _packed_hold(**sizes)
        for _ in range(8):
            batch = []
            for _ in range(rng.randrange(40)):
                n += 1
                pos = None if rng.random() < 0.03 else mark * 1000 + rng.randrange(-3_000_000, 20_000_000)
                kind = rng.choice([asof.DATA, asof.CONTROL, asof.CONTROL, asof.CLOSING])
                control = kind == asof.CONTROL
                action = rng.choice(["add", "remove", "replace"]) if control else None
                arguments = rng.choice([["a"], ["b"], ["é", "a"], [None, ""], None]) if control else None
                batch.append(Row(seq=n, kind=kind, action=action, arguments=arguments, pos=pos))
            wanted = list(plain.handleInputRows(("k",), iter(batch), _At(mark)))
            found = list(hold.handleInputRows(("k",), _packs(batch, held), _At(mark)))
            mark += rng.randrange(9_000)
            wanted += _fired(plain, plain_handle, mark)
            found += _fired(hold, handle, mark)
            assert _told(found) == [(r["seq"], list(r["items"]), r["late"]) for r in wanted]
            assert handle.values.get("current") == plain_handle.values.get("current")


def test_packs_keep_keys_apart_null_ones_too():
    import pyarrow as pa
    from pyspark.sql.types import StructType

    held = StructType.fromDDL("key string, seq long, kind int, pos long")
    rows = [{"key": k, "salt": i % 2, "seq": i, "kind": asof.DATA, "pos": -i} for i, k in enumerate(["b", None, "a", ""] * 6)]
    table = pa.Table.from_pylist(rows, pa.schema([*asof._columns(held), ("salt", pa.int32())]))
    found = {}
    for batch in asof.packed(["key", "salt"], held)(iter(table.to_batches(max_chunksize=5))):
        for pack in batch.to_pylist():
            inner = pa.ipc.read_record_batch(pa.py_buffer(pack["rows"]), asof._columns(held)).to_pylist()
            assert {r["key"] for r in inner} == {pack["key"]} and (pack["key"], pack["salt"]) not in found
            found[pack["key"], pack["salt"]] = [r["seq"] for r in inner]
    wanted = {}
    for r in reversed(rows):
        wanted.setdefault((r["key"], r["salt"]), []).append(r["seq"])
    assert found == wanted


def test_a_micro_batch_is_decoded_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    read = F.udf(lambda v: seen.add(1) or v, "string").asNondeterministic()

    def batch(rows):
        df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, key string, value string, t double")
        return df.withColumn("timestamp", F.timestamp_seconds("t")).drop("t").withColumn("value", read("value"))

    product = json.dumps({"product_id": "a", "name": "p"})
    command = json.dumps({"action": "add", "product_id": "a"})
    rows = [("products.raw" if n < 5 else "blacklist.commands", 0, n, "a", product if n < 5 else command, 1e9 + n) for n in range(10)]
    jobs.filter_products_writer(str(tmp_path / "out"), str(tmp_path / "state"), rows_per_piece=3)(batch(rows), 0)
    assert [r["seq"] for r in spark.read.parquet(str(tmp_path / "out")).orderBy("seq").collect()] == [0, 1, 2, 3, 4]
    # Once for each of the two topics.
    assert seen.value <= 2 * len(rows)

    message = json.dumps({"sender_id": "s", "recipient_id": "r", "message_id": "m", "text": "a bad word"})
    event = json.dumps({"user_id": "r", "blocked_user_id": "x", "action": "block"})
    update = json.dumps({"words": ["bad"], "action": "add"})
    rows = [("messages", 0, 3, "r", message, 1e9 + 3), ("blocked_users", 0, 1, "r", event, 1e9), ("banned_words", 0, 2, "global", update, 1e9)]
    seen.value = 0
    jobs.chat_writer(str(tmp_path / "told"), str(tmp_path / "chat"))(batch(rows), 0)
    assert [r["text"] for r in spark.read.parquet(str(tmp_path / "told")).collect()] == ["a *** word"]
    assert seen.value <= 3 * len(rows)
