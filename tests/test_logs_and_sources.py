import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from logweave import schemas
from logweave.functions import frames
from logweave.operators import alerts, cdc, keyed, logs, metrics
from logweave.operators.frames import with_schema
from logweave.functions.metric_names import BROKER_RULES, CONNECT_RULES, rename
from logweave.plans import sizing
from logweave.sources import generate, lake
from logweave.sources import log as topic_log

LOG = "topic string, partition int, offset bigint, key string, value string, at string"


def make_log(spark, rows):
    df = spark.createDataFrame(rows, LOG)
    return df.withColumn("timestamp", F.col("at").cast("timestamp")).drop("at")


def test_routes(one):
    for topic, folder in [
        ("primary.products.filtered", "products"),
        ("primary.client.events", "client-events"),
        ("client.events", "client-events"),
        ("other", "unknown"),
    ]:
        assert one(logs.archive_folder("t"), t=topic) == folder


def test_mirror_archive_and_readiness(spark, tmp_path):
    rows = [
        ("products.filtered", 0, 0, "a", '{"a":1}', "2026-01-01 00:00:00"),
        ("client.events", 0, 0, "u", '{"b":1}', "2026-01-01 00:00:00"),
        ("secret", 0, 0, "s", "{}", "2026-01-01 00:00:00"),
    ]
    copy = logs.mirror(make_log(spark, rows))
    assert {r["topic"] for r in copy.collect()} == {"primary.products.filtered", "primary.client.events"}
    path = str(tmp_path / "lake")
    lake.write_archive(copy.filter("topic like '%products%'"), path)
    wanted = ("products", "client-events")
    state = {r["dataset"]: r["ready"] for r in logs.ready(lake.archive_files(spark, path), wanted).collect()}
    assert state == {"products": True, "client-events": False}
    lake.write_archive(copy.filter("topic not like '%products%'"), path)
    assert all(r["ready"] for r in logs.ready(lake.archive_files(spark, path), wanted).collect())
    back = spark.read.text(f"{path}/dataset=products")
    assert [r["value"] for r in back.collect()] == ['{"a":1}']
    lake.write_lines(copy, str(tmp_path / "lines"))
    lake.write_lines(copy, str(tmp_path / "lines"))
    assert spark.read.text(str(tmp_path / "lines")).count() == 4


def test_results_and_files(spark, tmp_path):
    recs = spark.createDataFrame([("u", "p", "n", "r")], "user_id string, product_id string, product_name string, reason string")
    out = str(tmp_path / "recs")
    lake.write_json(recs, out)
    lake.write_json(recs, out)
    (tmp_path / "recs" / "other.json").write_text('{"user_id":"x"}')
    back = lake.read_results(spark, out, schemas.RECOMMENDATION)
    assert [r["user_id"] for r in back.collect()] == ["u"]
    sent = logs.keyed_json(recs, "recommendations").first()
    assert sent["key"] == "u:p" and json.loads(sent["value"])["reason"] == "r"
    observed, seen = logs.counted(recs, "sent")
    observed.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 1


def test_product_file_policies(spark, tmp_path):
    good = {"product_id": "1", "name": "n", "price": {"amount": 1}, "store_id": "s"}
    bad = {**good, "store_id": " "}
    (tmp_path / "p.jsonl").write_text("\n".join(["", json.dumps(good), json.dumps(bad)]))
    ok, rejects = lake.read_products(spark, str(tmp_path / "p.jsonl"), "quarantine")
    assert ok.first()["key"] == "1"
    reject = rejects.first()
    assert reject["reject_reason"] == "store_id is required" and reject["file"].endswith("p.jsonl")
    with pytest.raises(PySparkException, match="store_id is required"):
        lake.read_products(spark, str(tmp_path / "p.jsonl"), "fail").count()


def test_log_files(spark, tmp_path):
    records = spark.createDataFrame([("t", f"k{i % 5}", "v", i) for i in range(40)], "topic string, key string, value string, n bigint")
    placed = topic_log.placed(records, 3, "n", rows_per_piece=4).withColumn("timestamp", F.timestamp_seconds("n"))
    topic_log.write_log(placed, str(tmp_path / "log"))
    back = topic_log.read_log(spark, str(tmp_path / "log"), ["t"])
    assert back.columns == schemas.LOG.names
    for part in back.select("partition").distinct().collect():
        offsets = sorted(r["offset"] for r in back.filter(F.col("partition") == part[0]).collect())
        assert offsets == list(range(len(offsets)))
    assert topic_log.read_log(spark, str(tmp_path / "log"), ["x"]).count() == 0
    assert logs.first_records(back, 7).count() == 7 and logs.first_records(back, 0).count() == 40
    assert topic_log.broker_options(["a:1", "b:2"], ["t"], 9) == {
        "kafka.bootstrap.servers": "a:1,b:2",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "9",
    }


def test_offsets_and_lag(spark):
    rows = [("t", p, o, "k", "v", "2026-01-01 00:00:00") for p in (0, 1) for o in range(4)]
    log = make_log(spark, rows)
    assert logs.topic_offsets(log).first()["total_offsets"] == 8
    commits = spark.createDataFrame([("g", "t", 0, 3)], "group string, topic string, partition int, committed bigint")
    lag = {r["partition"]: r["lag"] for r in logs.consumer_lag(log, commits).collect()}
    assert lag == {0: 1, 1: 4}


def test_compaction_and_retention(spark):
    rows = [
        ("t", 0, 0, "k", "a", "2026-01-01 00:00:00"),
        ("t", 0, 1, "k", "b", "2026-01-02 00:00:00"),
        ("t", 0, 2, "l", "c", "2026-01-02 00:00:01"),
    ]
    log = make_log(spark, rows)
    assert {(r["key"], r["value"]) for r in keyed.compact(log).collect()} == {("k", "b"), ("l", "c")}
    assert {r["offset"] for r in keyed.retain_recent(log, 24).collect()} == {1, 2}
    assert {r["offset"] for r in keyed.retain_recent(log, 25).collect()} == {0, 1, 2}


def test_cdc_fixture(spark):
    """Four users and five orders, then the changes: six and six, order 2 gone."""

    def change(table, pk, op, seq, **row):
        return (f"shop.public.{table}", str(pk), op, seq, json.dumps({"id": pk, **row}))

    rows = [change("users", i, "r", i, email=f"u{i}") for i in range(1, 5)]
    rows += [change("orders", i, "r", 10 + i, user_id=u, quantity=i) for i, u in enumerate([1, 1, 2, 3, 4], 1)]
    rows += [change("users", 5, "c", 20, email="c"), change("users", 6, "c", 21, email="d")]
    rows += [change("orders", 6, "c", 22, user_id=1, quantity=7), change("orders", 7, "c", 23, user_id=5, quantity=2)]
    rows += [change("users", 1, "u", 24, email="john.doe"), change("orders", 1, "u", 25, user_id=1, quantity=10)]
    rows += [change("orders", 2, "d", 26), ("shop.public.other", "1", "c", 27, "{}")]
    log = spark.createDataFrame(rows, "topic string, key string, op string, seq bigint, value string")
    named = cdc.captured(log)
    fields = {"table": "table", "pk": "key", "op": "op", "seq": "seq", "row": "value"}
    now = cdc.current_rows(cdc.changes(named, fields))
    users = now.filter("table = 'users'").select(F.from_json("row", schemas.USERS_TABLE).alias("r")).select("r.*")
    orders = now.filter("table = 'orders'").select(F.from_json("row", schemas.ORDERS_TABLE).alias("r")).select("r.*")
    assert (users.count(), orders.count(), now.count()) == (6, 6, 12)
    assert users.filter("id = 1").first()["email"] == "john.doe"
    assert {r["id"]: r["quantity"] for r in orders.collect()} == {1: 10, 3: 3, 4: 4, 5: 5, 6: 7, 7: 2}
    assert cdc.broken_references(orders, users, "user_id", "id").count() == 0
    assert cdc.broken_references(orders, users.filter("id <> 1"), "user_id", "id").count() == 2
    shown = {r["key"]: (r["is_json"], r["shown"]) for r in cdc.event_view(
        spark.createDataFrame([("a", '{"b":1}'), ("c", "raw")], "key string, value string")).collect()}
    assert shown == {"a": (True, '{\n  "b": 1\n}'), "c": (False, "raw")}


def test_frames(spark):
    rows = spark.createDataFrame([(1, "héllo"), (2, "")], "n int, text string")
    framed = rows.select("n", frames.build_frame(F.lit(17), F.encode("text", "UTF-8")).alias("value"))
    assert bytes(framed.first()["value"])[:6] == b"\x00\x00\x00\x00\x11h"
    known = spark.createDataFrame([(17, "notice")], "schema_id bigint, schema string")
    joined = with_schema(framed, known).orderBy("n")
    back = [(r["schema_id"], r["schema"], bytes(r["body"]).decode()) for r in joined.collect()]
    assert back == [(17, "notice", "héllo"), (17, "notice", "")]
    bad = spark.createDataFrame(
        [(b"\x01\x00\x00\x00\x11x",), (b"\x00\x00\x00\x00",), (b"\x00\x00\x00\x00\x12x",), (None,)], "value binary"
    )
    assert {r["reject_reason"] for r in with_schema(bad, known).collect()} == {
        "unsupported magic byte",
        "payload is too short",
        "unknown schema id",
        "no payload",
    }
    assert spark.range(1).select(frames.build_frame(F.lit(0), F.lit(b"x"))).first()[0] is None


NAMES = [
    ("kafka.server<type=BrokerTopicMetrics, name=MessagesInPerSec><>Count", "5", "kafka_server_brokertopicmetrics_messagesin_total", {}, 5.0),
    ("kafka.server<type=ReplicaManager, name=UnderReplicatedPartitions><>Value", "0", "kafka_server_replicamanager_underreplicatedpartitions", {}, 0.0),
    ("kafka.connect<type=connector-task-metrics, connector=src, task=0><>status", "running", "kafka_connect_connector_status", {"connector": "src", "task": "0", "status": "running"}, 1.0),
    ("kafka.connect<type=source-task-metrics, connector=src, task=0><>source-record-poll-total", "7", "kafka_connect_source_task_source_record_poll_total", {"connector": "src", "task": "0"}, 7.0),
    ("kafka.consumer<type=app-info, client-id=c1><>start-time-ms", "2000", "kafka_consumer_start_time_seconds", {"clientId": "c1"}, 2.0),
    ("kafka.consumer<type=app-info, client-id=c1><>version", "3.9", "kafka_consumer_version_info", {"clientId": "c1", "version": "3.9"}, 1.0),
    ("kafka.consumer<type=consumer-node-metrics, client-id=c1, node-id=n1><>request-total", "3", "kafka_consumer_node_request_total", {"clientId": "c1", "nodeId": "n1"}, 3.0),
    ("kafka.connect<type=connect-worker-metrics><>task-count", "2", "kafka_connect_worker_task_count", {}, 2.0),
    ("java.lang<type=Memory><>used", "1", None, None, None),
    ("kafka.server<type=app, name=x><>Value", "text", None, None, None),
]


def test_metric_names(spark):
    df = spark.createDataFrame([(i, a, v) for i, (a, v, *_) in enumerate(NAMES)], "n int, attribute string, value string")
    found = {r["n"]: r for r in rename(df, BROKER_RULES + CONNECT_RULES).collect()}
    for i, (_, _, name, labels, value) in enumerate(NAMES):
        if name is None:
            assert i not in found
        else:
            assert (found[i]["metric"], found[i]["labels"], found[i]["metric_value"]) == (name, labels, value)
    lowered = rename(df, CONNECT_RULES, lower_labels=True).filter("n = 4").first()
    assert lowered["labels"] == {"clientid": "c1"} and lowered["help"] == "Kafka consumer JMX metric start time seconds"


def samples(spark, rows):
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, t bigint, value double")
    return df.withColumn("ts", F.timestamp_seconds("t"))


def test_alert_rules_and_gauges(spark):
    broker = {"job": "kafka-brokers", "instance": "b1", "cluster": "primary"}
    rows = [("up", broker, t, 0.0 if 10 <= t < 60 else 1.0) for t in range(0, 100, 10)]
    rows += [("up", {**broker, "job": "x"}, t, 0.0) for t in range(0, 100, 10)]
    df = samples(spark, rows)
    fired = metrics.firing_alerts(df).orderBy("ts").collect()
    assert [(r["alert"], r["severity"], r["ts"].timestamp() % 100) for r in fired] == [
        ("KafkaBrokerDown", "critical", 40.0),
        ("KafkaBrokerDown", "critical", 50.0),
    ]
    assert fired[0]["summary"] == "Kafka broker b1 is unavailable"
    task = {"connector": "src", "status": "running"}
    status = samples(
        spark,
        [("kafka_connect_connector_status", {**task, "task": "0"}, 1, 0.0), ("kafka_connect_connector_status", {**task, "task": "0"}, 2, 1.0), ("kafka_connect_connector_status", {**task, "task": "1"}, 2, 1.0), ("kafka_connect_connector_status", {"connector": "src", "status": "failed", "task": "2"}, 2, 1.0)],
    )
    assert metrics.running_connectors(status, "src").first()["running"] == 2.0
    assert metrics.running_connectors(status, "none").first()["running"] == 0.0


def test_alert_payloads(spark):
    alert = {"status": "firing", "labels": {"alertname": "KafkaBrokerDown", "instance": "broker-3:9404", "cluster": "primary"}, "annotations": {"summary": "s"}}
    big = json.dumps({"status": "x" * (1 << 20), "alerts": []})
    df = spark.createDataFrame(
        [(0, json.dumps({"status": "firing", "alerts": [alert, {"status": "resolved"}]})), (1, "not-json"), (2, '{"alerts":[]}'), (3, big)], "n int, value string"
    )
    rows = [tuple(r) for r in alerts.flatten(df).orderBy("n", "status").collect()]
    assert rows[0] == (0, None, "firing", "KafkaBrokerDown", "broker-3:9404", "primary", "s")
    assert rows[1] == (0, None, "resolved", "", "", "", "")
    assert rows[2][0] == 1 and rows[2][1] is not None and rows[2][2] is None
    assert rows[3][:2] == (3, "payload is too large") and len(rows) == 4


def test_generators(spark):
    row = generate.order_messages(generate.numbers(spark, 1), "i").first()
    assert (row["message_id"], row["order_id"], row["customer_id"], row["status"], row["amount"]) == (
        "i-msg-000001",
        "order-000001",
        "customer-02",
        "validated",
        125.5,
    )
    note = generate.notices(generate.numbers(spark, 2), "s").orderBy("event_id").collect()[1]
    assert (note["event_id"], note["message"], note["created_at"].microsecond % 1000) == ("event-002", "message #2", 0)
    assert generate.number_stream(spark).isStreaming and generate.flow_stream(spark).isStreaming


def test_sizes_and_settled(spark):
    assert len(sizing.at_most(spark.range(5), 5)) == 5 and sizing.at_most(spark.range(6), 5) is None
    kept = sizing.settled(spark.range(3).withColumn("x", F.lit("a")), "t")
    assert kept.count() == 3 and kept.columns == ["id", "x"]
