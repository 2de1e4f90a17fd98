import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from logweave import schemas
from logweave.functions import records
from logweave.operators import validate
from logweave.sources import lake

GOOD = {
    "product_id": "1",
    "name": "n",
    "price": {"amount": 0, "currency": "RUB"},
    "stock": {"available": 3, "reserved": 1},
    "tags": ["a"],
    "images": [],
    "specifications": {"k": "v"},
    "updated_at": "2023-10-10T15:30:00Z",
    "store_id": "s",
    "unknown_field": [1],
}


def changed(**fields):
    return json.dumps({**GOOD, **fields})


VERDICTS = [
    (json.dumps(GOOD), None),
    (changed(product_id="  "), "product_id is required"),
    (changed(product_id="", name=""), "product_id is required"),
    (changed(name="\t"), "name is required"),
    (changed(price={"amount": -0.01}), "price.amount must not be negative"),
    (changed(store_id=""), "store_id is required"),
    (changed(price=None), None),
    (json.dumps({"name": "n"}), "product_id is required"),
    (changed(name=5), "type"),
    (changed(tags=["a", 1]), "type"),
    (changed(specifications={"k": 1}), "type"),
    (changed(images=[{"url": {}}]), "type"),
    (changed(stock={"available": 1.5}), "type"),
    (changed(stock={"available": "1"}), "type"),
    (changed(updated_at="yesterday"), "type"),
    (changed(updated_at=1700000000), "type"),
    ("[1]", "type"),
    ("not json", "type"),
    ("{'product_id':'1'}", "type"),
]


def test_product_lines(spark):
    lines = spark.createDataFrame(
        [(i, text) for i, (text, _) in enumerate(VERDICTS)] + [(99, "  \t")], "n int, value string"
    )
    judged = {r["n"]: r["reject_reason"] for r in lake.product_lines(lines, "raw").collect()}
    assert 99 not in judged
    for i, (text, wanted) in enumerate(VERDICTS):
        found = judged[i]
        if wanted == "type":
            assert found is not None and "type" in found, text
        else:
            assert found == wanted, text


def test_missing_fields_are_empty(spark):
    df = spark.createDataFrame([('{"product_id":"7"}',)], "value string")
    row = records.decode(df, schemas.PRODUCT).first()["record"]
    assert row["product_id"] == "7" and row["name"] == "" and row["price"]["amount"] == 0.0
    assert row["stock"]["available"] == 0 and row["tags"] is None and row["updated_at"] is None


def test_policies(spark):
    df = spark.createDataFrame([('{"user_id":"u"}',), ("oops",)], "value string")
    decoded = records.decode(df, schemas.CLIENT_EVENT)
    assert records.apply_policy(decoded, "skip").count() == 1
    assert records.apply_policy(decoded, "raw").count() == 2
    good, bad = records.apply_policy(decoded, "quarantine")
    assert (good.count(), [r["value"] for r in bad.collect()]) == (1, ["oops"])
    with pytest.raises(PySparkException, match="not a JSON record"):
        records.apply_policy(decoded, "fail").collect()
    with pytest.raises(ValueError):
        records.apply_policy(decoded, "explode")


def test_long_lines(spark):
    big = spark.range(1).select(
        F.concat(F.lit('{"product_id":"1","name":"'), F.repeat(F.lit("x"), lake.MAX_LINE_BYTES), F.lit('"}')).alias("value")
    )
    assert lake.product_lines(big, "raw").first()["reject_reason"] == "line is too long"


def test_encode_and_pretty(spark):
    df = spark.createDataFrame([("u", ""), ("v", "q")], "user_id string, query string")
    texts = [r[0] for r in df.select(records.encode("user_id", "query", omit_empty=("query",))).collect()]
    assert texts == ['{"user_id":"u"}', '{"user_id":"v","query":"q"}']
    shown = spark.createDataFrame([('{"a":[1,{"b":null}]}',), ("raw",)], "v string").select(records.pretty("v")).collect()
    assert json.loads(shown[0][0]) == {"a": [1, {"b": None}]} and "\n" in shown[0][0]
    assert shown[1][0] is None


def test_row_checks(spark):
    df = spark.createDataFrame(
        [("a", "b"), (" ", "b"), ("", "b"), ("a", None)], "recipient_id string, sender_id string"
    )
    assert [r[0] for r in df.select(validate.deliverable()).collect()] == [True, True, False, False]
    money = spark.createDataFrame([("RUB", 1.0), ("RUBL", 1.0), ("R", 1e12)], "currency string, price_amount double")
    assert [r[0] for r in money.select(validate.table_row_error()).collect()] == [
        None,
        "currency is too long",
        "amount is out of range",
    ]
    good, bad = validate.split_valid(df, F.when(F.col("sender_id").isNull(), F.lit("no sender")))
    assert (good.count(), bad.first()["reject_reason"]) == (3, "no sender")


def test_indentation_keeps_numbers_order_and_strings(spark):
    texts = ['{"b":1,"a":[1,2,{"x":"y, {z}: \\"q\\" ["}],"e":{},"f":[ ],"g":1e400,"h":1.50}', '[]', '"s"', "12", "null", '{"a":{"b":{"c":[[]]}}}']
    rows = spark.createDataFrame([(t,) for t in texts] + [("raw",), (None,), ("",)], "v string")
    found = [r[0] for r in rows.select(records.pretty("v")).collect()]
    assert found[0].startswith('{\n  "b": 1,\n  "a": [\n    1,\n    2,\n    {\n      "x": "y, {z}: \\"q\\" ["\n    }\n  ],\n  "e": {},')
    assert '"g": 1e400' in found[0] and '"h": 1.50' in found[0] and '"f": []' in found[0]
    for text, shown in zip(texts[1:], found[1:]):
        assert shown == json.dumps(json.loads(text), indent=2)
    assert found[len(texts):] == [None, None, None]
    long = json.dumps([{"k": i, "v": ["x"] * 3} for i in range(3000)])
    (shown,) = [r[0] for r in spark.createDataFrame([(long,)], "v string").select(records.pretty("v")).collect()]
    assert shown == json.dumps(json.loads(long), indent=2)
