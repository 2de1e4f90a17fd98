"""Tables with manifests, files with line numbers, and streams that go on where they stopped."""

import json
import random

import pytest
from pyspark.sql import functions as F

from logweave import schemas
from logweave.catalogue import queries
from logweave.operators import alerts as al
from logweave.operators import filters, keyed, logs, metrics
from logweave.sources import lake, tables
from logweave.sources import log as log_source
from logweave.streaming import asof, jobs, progress, sinks


def rows_of(table, version=None):
    return sorted(tuple(r) for r in table.read(version).collect())


def test_a_reader_keeps_its_version_over_a_fold(spark, tmp_path):
    table = tables.table(spark, str(tmp_path / "t"), "k string, n int", ["k"], ["n"])
    assert rows_of(table) == [] and table.current().number == tables.NONE
    for batch, rows in enumerate([[("a", 1), ("b", 1)], [("a", 2), ("a", 3), ("c", 1)], [("b", 0)]]):
        table.add(spark.createDataFrame(rows, "k string, n int"), batch)
    pinned = table.current()
    opened = table.read(pinned)
    folded = table.fold()
    table.add(spark.createDataFrame([("a", -1), ("d", 9)], "k string, n int"), 3)
    old, new = [("a", 3), ("b", 0), ("c", 1)], [("a", -1), ("b", 0), ("c", 1), ("d", 9)]
    assert sorted(tuple(r) for r in opened.collect()) == old == rows_of(table, pinned) == rows_of(table, folded)
    assert rows_of(table) == new
    assert len(folded.deltas) == 0 and table.current().done == 3


def test_a_batch_counts_once_and_old_files_age_out(spark, tmp_path):
    table = tables.table(spark, str(tmp_path / "t"), "k string, n int", ["k"])
    for batch in range(4):
        table.add(spark.createDataFrame([("a", batch)], "k string, n int"), batch)
    again = table.add(spark.createDataFrame([("a", 77)], "k string, n int"), 2)
    assert again == table.current() and rows_of(table) == [("a", 3)]
    assert rows_of(table, table.current(before=2)) == [("a", 1)]
    table.fold()
    assert len(list((tmp_path / "t/data").iterdir())) == 5
    table.expire(keep=2)
    # The newest two versions name the four deltas and the base; one more fold and they go.
    assert rows_of(table) == [("a", 3)] and len(list((tmp_path / "t/data").iterdir())) == 5
    table.add(spark.createDataFrame([("b", 0)], "k string, n int"), 4)
    table.fold()
    table.expire(keep=1)
    assert rows_of(table) == [("a", 3), ("b", 0)] and len(list((tmp_path / "t/data").iterdir())) == 1


def test_a_second_writer_of_a_version_fails(spark, tmp_path):
    table = tables.table(spark, str(tmp_path / "t"), "k string, n int", ["k"])
    first = table.add(spark.createDataFrame([("a", 0)], "k string, n int"), 0)
    with pytest.raises(Exception, match="already exists"):
        table._commit(first)


# --- gates ------------------------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2])
def test_gate_batches_are_the_same_however_the_log_is_cut(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows, offset = [], {}
    for _ in range(140):
        topic, part = rng.choice([("a", 0), ("a", 1), (None, 0)])
        offset[topic, part] = offset.get((topic, part), 0) + rng.choice([1, 1, 5])
        rows.append((topic, part, offset[topic, part], "k", rng.choice(["ok", "ok", "bad", None])))
    log = spark.createDataFrame(rows, "topic string, partition int, offset long, key string, value string")
    is_bad = F.col("value") == "bad"
    writer = sinks.gate_writer(*(str(tmp_path / n) for n in ("good", "bad", "report")), is_bad, size=6)
    cuts = sorted(rng.sample(range(1, 140), 4))
    for batch, (first, last) in enumerate(zip([0, *cuts], [*cuts, 140], strict=True)):
        part = spark.createDataFrame(rows[first:last], log.schema)
        writer(part, batch)
        if batch == 2:
            writer(part, batch)  # replayed
    found = sinks.close_gate(spark, str(tmp_path / "report"))
    wanted = logs.batch_gate(log, F.coalesce(is_bad, F.lit(True)), size=6).select(*found.columns)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect()))
    assert spark.read.parquet(str(tmp_path / "good")).count() + spark.read.parquet(str(tmp_path / "bad")).count() == 140


# --- held rows --------------------------------------------------------------------


def test_late_rows_are_told_and_the_end_lets_go_of_the_rest(spark, tmp_path):
    def product(n, key, t):
        return ("products.raw", 0, n, key, json.dumps({"product_id": key, "name": f"p{n}"}), 1_700_000_000.0 + t)

    def command(n, key, action, t):
        return ("blacklist.commands", 0, n, key, json.dumps({"action": action, "product_id": key}), 1_700_000_000.0 + t)

    path, out, ckpt = (str(tmp_path / n) for n in ("log", "out", "ckpt"))

    def run(rows):
        df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, key string, value string, t double")
        df = df.withColumn("timestamp", F.timestamp_seconds("t")).drop("t")
        df.coalesce(1).write.mode("append").parquet(path)
        judged = jobs.judged_products(spark.readStream.schema(schemas.LOG).parquet(path), delay="1 minute")
        sinks.run(judged, ckpt, out).awaitTermination()
        found = spark.read.schema(judged.schema).parquet(out).collect()
        return {r["seq"]: (r["late"], r["denied"]) for r in found}

    assert run([product(0, "a", 5), command(1, "a", "add", 6), product(2, "a", 200), product(3, "b", 100)]) == {
        0: (False, False),
        3: (False, False),
    }
    # A product and a command that come after the watermark has passed them; the command is newer than the last one.
    second = run([product(4, "a", 2), command(5, "b", "add", 90), product(6, "b", 91), command(7, "a", "remove", 1), product(8, "a", 201)])
    assert second == {0: (False, False), 3: (False, False), 4: (True, True), 6: (True, True)}
    log = spark.read.schema(schemas.LOG).parquet(path)
    last = jobs.closing_rows(log, "1 minute").select("*", (F.unix_micros("timestamp") / 1_000_000).alias("t"))
    ended = run([tuple(r)[:5] + (r["t"],) for r in last.select("topic", "partition", "offset", "key", "value", "t").collect()])
    assert ended == {**second, 2: (False, True), 8: (False, True)}
    assert len(ended) == log.filter("topic = 'products.raw'").count()


def test_the_hold_touches_one_bucket_at_a_time():
    """Arrivals and timers read and write the bucket they are about, not all that waits."""

    class Map(dict):
        touched = []

        def containsKey(self, key):
            return key in self

        def getValue(self, key):
            Map.touched.append(key)
            return self[key]

        def updateValue(self, key, value):
            self[key] = value

        def removeKey(self, key):
            del self[key]

    class Value:
        held = None

        def exists(self):
            return self.held is not None

        def get(self):
            return self.held

        def update(self, value):
            self.held = value

    class Handle:
        timers = []

        def __init__(self):
            self.map, self.value = Map(), Value()

        def getMapState(self, *_):
            return self.map

        def getValueState(self, *_):
            return self.value

        def registerTimer(self, at):
            self.timers.append(at)

    class Time:
        def __init__(self, at):
            self.at = at

        def getCurrentWatermarkInMs(self):
            return self.at

        def getExpiryTimeInMs(self):
            return self.at

    from pyspark.sql import Row
    from pyspark.sql.types import StructType

    held = StructType.fromDDL("seq long, kind int, action string, arguments array<string>, pos long")
    hold, handle = asof.HoldUntilWatermark(held, ["seq"]), Handle()
    hold.init(handle)
    rows = [Row(seq=i, kind=asof.DATA, action=None, arguments=None, pos=i * 500_000) for i in range(100)]
    assert list(hold.handleInputRows(("k",), iter(rows), Time(0))) == []
    assert len(handle.map) == 50 and handle.timers == [1000 * (i + 1) for i in range(50)] and Map.touched == []
    out = list(hold.handleExpiredTimer(("k",), Time(3000), Time(3000)))
    assert [r["seq"] for r in out] == [4, 5] and Map.touched == [(2,)]
    late = Row(seq=999, kind=asof.DATA, action=None, arguments=None, pos=1)
    assert [r["late"] for r in hold.handleInputRows(("k",), iter([late]), Time(3000))] == [True]


# --- ties and nulls ---------------------------------------------------------------


def both_ways(spark, rows, schema, run):
    """What ``run`` gives for two orders of arrival, which must be the same."""
    one, two = (sorted(map(repr, run(spark.createDataFrame(r, schema).coalesce(1)).collect())) for r in (rows, rows[::-1]))
    assert one == two
    return one


def test_equal_times_give_the_same_in_any_order_of_arrival(spark):
    rows = [("s", "2024-01-01 00:00:00", n, v) for n, v in [(1, 10.0), (2, 20.0), (3, 5.0)]]
    rows += [("s", "2024-01-01 00:01:00", n, v) for n, v in [(4, 30.0), (5, 30.0), (6, 8.0)]]
    schema = "k string, at string, seq int, value double"

    def at(df):
        return df.withColumn("ts", F.col("at").cast("timestamp"))

    for order in [("seq",), ()]:
        both_ways(spark, rows, schema, lambda d: metrics.counter_rate(at(d), ["k"], seconds=60, order=order).select("seq", "rate"))
        both_ways(spark, rows, schema, lambda d: metrics.held(at(d), ["k"], F.col("value") > 6, 30, order=order))
    labelled = lambda d: at(d).select(F.lit("m").alias("metric"), F.create_map(F.lit("k"), F.col("k")).alias("labels"), "ts", "value", "seq")
    (found,) = both_ways(spark, rows, schema, lambda d: metrics.current_values(labelled(d)).select("value"))
    assert "30.0" in found
    (found,) = both_ways(spark, rows, schema, lambda d: metrics.current_values(labelled(d), order=("seq",)).select("value"))
    assert "8.0" in found
    alerts = [("a", "c", "i", s, "2024-01-01 00:00:00", n) for n, s in [(1, "firing"), (2, "resolved"), (3, "firing")]]
    schema = "alertname string, cluster string, instance string, status string, at string, n int"
    for order, shown in [(("n",), ["n", "status"]), ((), ["status"])]:
        both_ways(spark, alerts, schema, lambda d: al.status_changes(at(d), order=order).select(*shown, "was"))
        both_ways(spark, alerts, schema, lambda d: al.notices(at(d), order=order).select(*shown, "changed"))


def test_retention_keeps_what_has_no_topic_time_or_value(spark):
    rows = [
        ("t", 0, 1, "2024-01-01 00:00:00", "x" * 60),
        ("t", 0, 2, "2024-01-03 00:00:00", "x" * 60),
        ("t", 0, 3, None, None),
        (None, 0, 1, "2024-01-01 00:00:00", "y"),
        (None, 0, 2, "2024-01-05 00:00:00", None),
    ]
    log = spark.createDataFrame(rows, "topic string, partition int, offset long, at string, value string")
    log = log.withColumn("timestamp", F.col("at").cast("timestamp"))
    recent = {(r["topic"], r["offset"]) for r in keyed.retain_recent(log).collect()}
    assert recent == {("t", 2), ("t", 3), (None, 2)}
    for limit in (None, 1):
        kept = {(r["topic"], r["offset"]) for r in keyed.retain_bytes(log, 100, rows_per_piece=limit).collect()}
        assert kept == {("t", 2), ("t", 3), (None, 1), (None, 2)}


def test_data_columns_named_like_the_flag_survive(spark):
    data = spark.createDataFrame([("a", 5, 1, "mine", "too")], "key string, pos long, seq long, state string, denied string")
    commands = spark.createDataFrame([("b", "add", 1, 0)], "key string, action string, pos long, seq long")
    found = filters.deny_filter_as_of(data, commands).collect()
    assert [(r["state"], r["denied"]) for r in found] == [("mine", "too")]


def _told_plainly(rows, wait):
    found = []
    for group in {r[:2] for r in rows}:
        last, at = None, None
        for r in sorted((r for r in rows if r[:2] == group), key=lambda r: (r[3], r[4])):
            if r[2] != last or r[3] - at >= wait:
                found.append((r[4], r[2] != last))
                last, at = r[2], r[3]
    return sorted(found)


@pytest.mark.parametrize(("seed", "limit"), [(1, None), (2, 7), (3, None)])
def test_notices_follow_one_another(spark, seed, limit):
    rng = random.Random(seed)
    rows = [
        (rng.choice("ab"), rng.choice(["x", None]), rng.choice(["firing"] * 6 + ["resolved"]), rng.randint(0, 2000), i)
        for i in range(250)
    ]
    alerts = spark.createDataFrame(rows, "alertname string, cluster string, status string, t int, n int")
    alerts = alerts.withColumn("ts", F.timestamp_seconds("t"))
    found = al.notices(alerts, seconds=60, order=("n",), rows_per_piece=limit).collect()
    assert sorted((r["n"], r["changed"]) for r in found) == _told_plainly(rows, 60)
    assert al.notices(alerts.limit(0), order=("n",)).collect() == []


# --- files and progress -----------------------------------------------------------


def test_lines_are_numbered_over_the_splits_of_a_file(spark, tmp_path):
    rng = random.Random(3)
    wanted = set()
    for name in ("one", "two", "none"):
        lines = ["x" * rng.randint(0, 300) + f" {name} {i}" if rng.random() < 0.9 else "" for i in range(0 if name == "none" else 900)]
        (tmp_path / f"{name}.txt").write_text("\n".join(lines))
        wanted |= {(name, i + 1, line) for i, line in enumerate(lines)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        found = lake.numbered_lines(spark, str(tmp_path / "*.txt"))
        assert found.select("file").distinct().count() == 2 and found.rdd.getNumPartitions() > 10
        name = F.regexp_extract("file", r"/(\w+)\.txt", 1)
        assert {tuple(r) for r in found.select(name, "line", "value").collect()} == wanted
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_scan_stops_at_the_first_bad_line_of_each_file(spark, tmp_path):
    good = json.dumps({"product_id": "p", "name": "n", "store_id": "s", "price": {"amount": 1.0, "currency": "x"}})
    (tmp_path / "a.txt").write_text("\n".join([good, "", "no json", good, "worse"]))
    (tmp_path / "b.txt").write_text("\n".join([good, good]))
    (tmp_path / "c.txt").write_text("{}\n" + good)
    kept, bad = lake.read_products(spark, str(tmp_path), "stop")
    at = F.regexp_extract("file", r"/(\w)\.txt", 1)
    assert sorted(tuple(r) for r in kept.select(at, "line").collect()) == [("a", 1), ("b", 1), ("b", 2)]
    assert sorted(tuple(r) for r in bad.select(at, "line", "value").collect()) == [("a", 3, "no json"), ("c", 1, "{}")]


def test_batches_stay_within_their_bytes_and_the_stream_ends_when_idle(spark, tmp_path):
    path, sizes = str(tmp_path / "log"), []
    rows = [("t", 0, i, "k", "v" * 50, None) for i in range(400)]
    log = spark.createDataFrame(rows, "topic string, partition int, offset bigint, key string, value string, timestamp timestamp")
    log.repartition(8).write.parquet(path)
    largest = max(f.stat().st_size for f in (tmp_path / "log").glob("part-*"))

    def write(batch, batch_id):
        files = batch.select("_metadata.file_path", "_metadata.file_size").distinct()
        sizes.append((files.agg(F.sum("file_size")).first()[0], batch.count()))

    def start():
        stream = log_source.read_log(spark, path, stream=True, max_bytes=2 * largest)
        return sinks.run(stream.select("*", "_metadata"), str(tmp_path / "c"), writer=write, trigger={"processingTime": "0 seconds"})

    query = progress.until_idle(spark, start, 2)
    assert not query.isActive and sum(n for _, n in sizes) == 400
    assert len(sizes) >= 4 and all(size <= 2 * largest for size, _ in sizes)


def test_only_committed_batches_count_as_read(spark, tmp_path):
    path, ckpt = str(tmp_path / "log"), str(tmp_path / "c")
    schema = "topic string, partition int, offset bigint, key string, value string, timestamp timestamp"

    def more(first, last):
        rows = [("t", 0, i, "k", "v", None) for i in range(first, last)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)

    def failing(batch, batch_id):
        if batch_id == 1:
            raise RuntimeError("stop here")

    more(0, 10)
    sinks.run(log_source.read_log(spark, path, stream=True), ckpt, writer=failing).awaitTermination()
    more(10, 25)
    with pytest.raises(Exception, match="stop here"):
        sinks.run(log_source.read_log(spark, path, stream=True), ckpt, writer=failing).awaitTermination()
    log = log_source.read_log(spark, path)
    (found,) = logs.consumer_lag(log, progress.positions(spark, log, ckpt, "g")).collect()
    assert (found["committed"], found["end_offset"], found["lag"]) == (10, 25, 15)


def test_a_text_in_several_files_is_numbered_through(spark, tmp_path, monkeypatch):
    from pathlib import Path

    for k, text in enumerate(["a\t1\n# x\n", "", "\nb\t2\nc\t3\n"]):
        (tmp_path / f"part-{k}.txt").write_text(text)
    found = lake.read_keyed_text(spark, str(tmp_path), one_log=True).orderBy("row_order").collect()
    assert [(r["key"], r["row_order"]) for r in found] == [("a", 1), ("b", 4), ("c", 5)]
    each = lake.read_keyed_text(spark, str(tmp_path)).orderBy("key").collect()
    assert [r["row_order"] for r in each] == [1, 2, 3]

    read, written = lake.read_keyed_text, []

    def noted(session, path, **given):
        written.append(path)
        return read(session, path, **given)

    monkeypatch.setattr(lake, "read_keyed_text", noted)
    monkeypatch.setattr(queries.lake, "read_keyed_text", noted)
    # More files than one: no task writes the whole text.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lines = [r["line"] for r in queries.all_queries()["q_chat_file"](spark, "/root/testdata/sf0.001").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list(Path(written[0].removeprefix("file:")).glob("part-*"))) > 1
    assert sorted(lines) == [3 * k + 2 for k in range(len(lines))]
