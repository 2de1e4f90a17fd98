import json
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from logweave import schemas
from logweave.operators import filters, keyed, recommend, search
from logweave.sources import lake

PRODUCTS = [
    ("k-11", "Copper kettle", 7),
    ("k-12", "Tin kettle, small", 19),
    ("m-3", "Wool mittens", 19),
    ("m-4", "Mitten dryer", 2),
    ("r-1", "Rope ladder", 41),
    ("r-2", "Rope", 0),
    ("z-9", "Recalled ladder", 88),
]


@pytest.fixture
def shop(spark, tmp_path):
    """Products on disk as JSON Lines, one of them denied."""
    lines = [
        {
            "product_id": pid,
            "name": name,
            "price": {"amount": 1.5, "currency": "RUB"},
            "stock": {"available": available, "reserved": 0},
            "updated_at": "2031-04-05T06:07:08Z",
            "store_id": "west",
        }
        for pid, name, available in PRODUCTS
    ]
    (tmp_path / "products.jsonl").write_text("\n".join(json.dumps(x, ensure_ascii=False) for x in lines))
    (tmp_path / "deny.json").write_text('[{"product_id": "z-9", "reason": "recall"}]')
    return tmp_path


def test_products_to_recommendations(spark, shop):
    products = lake.read_products(spark, str(shop / "products.jsonl"), "fail")
    commands = lake.read_deny_file(spark, str(shop / "deny.json")).withColumns(
        {"key": F.col("product_id"), "offset": F.lit(0)}
    )
    kept = filters.deny_filter(products, commands).select("record.*")
    assert kept.count() == 6
    found = search.search_products(keyed.product_rows(kept), " KETTLE ")
    assert [r["product_id"] for r in found.collect()] == ["k-11", "k-12"]
    events = [
        ("ana", "q1", "search", "Rope", "2026-02-01 10:00:00"),
        ("ana", "q2", "search", "mitten", "2026-02-01 10:00:00.25"),
        ("bo", "q3", "recommendations", None, "2026-02-01 11:00:00"),
        ("cy", "q4", "search", "ROPE", "2026-02-02 09:00:00"),
        ("cy", "q5", "recommendations", "kettle", "2026-02-02 09:30:00"),
        ("di", "q6", "search", "violin", "2026-02-03 00:00:00"),
        (None, "q7", "search", "kettle", "2026-02-03 00:00:00"),
    ]
    log = spark.createDataFrame(
        events, "user_id string, request_id string, request_type string, query string, at string"
    ).withColumn("requested_at", F.col("at").cast("timestamp"))
    out = recommend.recommendations(kept, log)
    assert out.columns == schemas.RECOMMENDATION.names
    lists = {}
    for r in out.collect():
        lists.setdefault(r["user_id"], []).append((r["product_id"], r["reason"]))
    match, stock = recommend.MATCH_REASON, recommend.STOCK_REASON
    popular = [("r-1", stock), ("k-12", stock), ("m-3", stock)]
    assert lists == {
        "ana": [("m-3", match), ("m-4", match), ("r-1", stock)],
        "bo": popular,
        "cy": [("r-1", match), ("r-2", match), ("k-12", stock)],
        "di": popular,
    }
    assert len({r["generated_at"] for r in out.collect()}) == 1


def by_pairs(users, products, k):
    """The textbook plan: every user meets every product."""
    match = F.expr("CASE WHEN query IS NOT NULL AND instr(lower(product_name), lower(query)) > 0 THEN 1 ELSE 0 END")
    order = Window.partitionBy("user_id").orderBy(F.desc("query_match"), F.desc("available"), "product_id")
    scored = users.join(products, F.lit(True)).withColumn("query_match", match)
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("user_id", "rank", "product_id", "product_name", "query_match")


@pytest.mark.parametrize("seed", range(6))
def test_same_as_textbook(spark, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abAéЧч ") for _ in range(rng.randint(1, 6)))
    products = [(i, rng.choice([word(), "same name"]), rng.choice([None, 1, 2, 3])) for i in range(rng.randint(1, 25))]
    users = [(i, rng.choice([None, "", "a", "ab", "Ч", "zz", "same", word()])) for i in range(20)]
    p = spark.createDataFrame(products, "product_id int, product_name string, available int")
    u = spark.createDataFrame(users, "user_id int, query string")
    found = sorted(map(tuple, recommend.recommend(u, p, 3).collect()))
    assert found == sorted(map(tuple, by_pairs(u, p, 3).collect()))


def test_latest_product(spark):
    rows = [("a", "old", 1), ("a", "new", 2), ("b", "only", None)]
    df = spark.createDataFrame(rows, "product_id string, name string, t int").select(
        "product_id", "name", F.struct(F.lit(1).alias("available")).alias("stock"), F.timestamp_seconds("t").alias("updated_at")
    )
    assert {(r["product_id"], r["name"]) for r in recommend.latest_products(df).collect()} == {("a", "new"), ("b", "only")}
    users = spark.createDataFrame(
        [("u", 1, "q1"), ("u", 3, "q3"), ("v", 2, None)], "user_id string, n int, query string"
    ).withColumns({"request_type": F.lit("search"), "requested_at": F.timestamp_seconds("n"), "request_id": F.col("n")})
    joined = users.select("user_id").distinct().join(recommend.latest_searches(users), "user_id", "left")
    assert set(map(tuple, joined.collect())) == set(map(tuple, recommend.users_with_query(users).collect()))


def test_user_recommendations(spark):
    df = spark.createDataFrame([("u", "a", 1), ("u", "b", 2), ("v", "c", 3)], "user_id string, product_id string, generated_at int")
    assert [r["product_id"] for r in search.user_recommendations(df, "u").collect()] == ["b", "a"]
    with pytest.raises(ValueError):
        search.search_products(df, "  ")


def _matched_plainly(names, needles, k):
    best = sorted(names, key=lambda r: (-r[2], r[0]))
    return {n: [r[0] for r in best if n in r[1].lower()][:k] for n in needles if any(n in r[1].lower() for r in names)}


def test_the_gram_index_finds_what_a_search_of_all_names_finds(spark):
    random.seed(5)
    letters = "abcÄß"
    names = [(f"p{i:03}", "".join(random.choices(letters, k=random.randint(0, 12))), random.randint(0, 9)) for i in range(300)]
    needles = {"".join(random.choices(letters.lower(), k=random.randint(1, 5))) for _ in range(80)} | {"abcabcabcabca", "zz", "z"}
    products = spark.createDataFrame(names, "product_id string, product_name string, available int")
    queries = spark.createDataFrame([(n.upper() if n == "abc" else n,) for n in needles] + [(None,), ("",)], "query string")
    found = recommend.query_matches(products, queries, 4).collect()
    got = {r["needle"]: [i["product_id"] for i in sorted(r["items"], key=lambda i: (-i["available"], i["product_id"]))] for r in found}
    assert got == _matched_plainly(names, needles, 4)


def test_names_emit_as_many_rows_as_they_have_characters(spark):
    for size in (100, 1000, 4000):
        name = "".join(chr(0x4E00 + i) for i in range(size))
        names = spark.createDataFrame([(name, [1])], "hay string, items array<int>")
        wanted = names.select(F.explode(recommend.grams(F.col("hay"), 3)).alias("gram"))
        assert recommend.gram_index(names, wanted, [1, 2, 3]).count() == size - 2
        assert recommend.gram_index(names, wanted.limit(5), [3]).count() == 5


def test_a_query_is_looked_up_by_its_rarest_gram(spark):
    names = spark.createDataFrame([(f"common {i}", [i]) for i in range(50)] + [("common xyz", [99])], "hay string, items array<int>")
    needles = spark.createDataFrame([("common xyz",), ("ommon",), ("q",), ("comet",)], "needle string")
    by_gram = recommend.needle_grams(needles)
    index = recommend.gram_index(names, by_gram.select("gram").distinct(), [1, 3])
    got = {r["needle"]: r["gram"] for r in recommend.rarest_grams(by_gram, index).collect()}
    assert got["common xyz"] in {" xy", "xyz", "n x"} and got["ommon"] in {"omm", "mmo", "mon"} and len(got) == 2
