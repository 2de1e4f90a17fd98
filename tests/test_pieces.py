"""Ordered work on hot keys against plain Python, with pieces of a few rows."""

import random

import pytest
from pyspark.sql import functions as F

from logweave.operators import keyed, logs, metrics
from logweave.plans import pieces


def series(seed, n=300):
    """Rows (key, pos, seq, v); key 'hot' and the null key hold most rows, positions repeat."""
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        key = rng.choice(["hot", "hot", "hot", None, None, "a", "b"])
        rows.append((key, rng.randint(0, 120), seq, rng.choice([None, rng.randint(0, 9)])))
    return rows


def by_key(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        found.setdefault(r[0], []).append(r)
    return found


@pytest.mark.parametrize("seed,limit", [(1, 10), (2, 3), (3, 1), (4, 10_000)])
def test_last_known_and_totals(spark, seed, limit):
    rows = series(seed)
    df = spark.createDataFrame(rows, "key string, pos bigint, seq bigint, v int").withColumn(
        "w", F.coalesce("v", F.lit(0))
    )
    split = pieces.cut(df, ["key"], "pos", limit)
    assert split.hot == (limit < 300)
    out = (
        split.last_known(["pos", "seq"], "v", "upto")
        .last_known(["pos", "seq"], "v", "before", strictly_before=True)
        .running_total(["pos", "seq"], "w", "total")
        .running_total(["pos", "seq"], "w", "rest", newest_first=True)
        .trailing_sum(7, "w", "recent")
        .rows()
    )
    assert out.columns == ["key", "pos", "seq", "v", "w", "upto", "before", "total", "rest", "recent"]
    found = {r["seq"]: r for r in out.collect()}
    assert len(found) == len(rows) == out.count()
    for group in by_key(rows).values():
        last, total = None, 0
        whole = sum(r[3] or 0 for r in group)
        for _, pos, seq, v in group:
            before = last
            last = v if v is not None else last
            total += v or 0
            recent = sum(r[3] or 0 for r in group if pos - 7 <= r[1] <= pos)
            row = found[seq]
            wanted = (last, before, total, whole - total + (v or 0), recent)
            assert (row["upto"], row["before"], row["total"], row["rest"], row["recent"]) == wanted


def test_one_far_position_does_not_fill_a_piece(spark):
    rows = [("k", i) for i in range(2000)] + [("k", 10**15), (None, 5), ("few", 3)]
    split = pieces.cut(spark.createDataFrame(rows, "key string, pos bigint"), ["key"], "pos", 100)
    sizes = split.df.filter("key = 'k'").groupBy(pieces.PIECE).count().collect()
    assert max(r["count"] for r in sizes) <= 200 and len(sizes) >= 15


def nodes(plan):
    yield plan
    children = plan.children()
    for k in range(children.size()):
        yield from nodes(children.apply(k))


def test_rows_of_cut_keys_are_shuffled_once(spark):
    df = spark.range(1000).selectExpr("id % 2 AS key", "id AS pos", "id AS v", "concat('x', id) AS other")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = pieces.cut(df, ["key"], "pos", 100).last_known(["pos"], "v", "last").running_total(["pos"], "v", "sum")
        found = list(nodes(out.rows()._jdf.queryExecution().executedPlan()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    # Only an exchange that still carries the wide column moves the rows themselves.
    assert sum(n.nodeName() == "Exchange" and "other" in n.output().toString() for n in found) == 1
    assert out.rows().filter("last <> pos OR sum <> (pos DIV 2) * (pos DIV 2 + 1) + (pos % 2) * (pos DIV 2 + 1)").count() == 0


@pytest.mark.parametrize("limit", [2, None])
def test_rates_survive_jumps_and_values_that_are_no_numbers(spark, limit):
    nan, inf = float("nan"), float("inf")
    cases = {
        "jump": ([0.0, 1e17, 1e17, 0.0, 1.0, 2.0, 3.0], [0, 1, 2, 100, 101, 102, 103]),
        "nan": ([1.0, nan, 2.0, inf, 3.0, None], [0, 1, 2, 3, 4, 5]),
        "plain": ([0.1, 0.4, 1.0, 1.0], [0, 1, 2, 200]),
    }
    wanted = {
        "jump": [0.0, 1e17, 1e17, 0.0, 1.0, 2.0, 3.0],
        "nan": [0.0, 0.0, 1.0, 1.0, 2.0, 2.0],
        "plain": [0.0, 0.4 - 0.1, 0.4 - 0.1 + (1.0 - 0.4), 0.0],
    }
    rows = [(k, t, v) for k, (values, times) in cases.items() for v, t in zip(values, times)]
    df = spark.createDataFrame(rows, "s string, t bigint, v double").withColumn("ts", F.timestamp_seconds("t"))
    found = metrics.counter_rate(df, ["s"], "ts", "v", 60, rows_per_piece=limit).collect()
    for key, sums in wanted.items():
        own = [r["rate"] * 60 for r in sorted((r for r in found if r["s"] == key), key=lambda r: r["t"])]
        assert own == pytest.approx(sums) and min(own) >= 0


@pytest.mark.parametrize("seed,limit", [(1, 5), (2, 40), (3, None)])
def test_as_of(spark, seed, limit):
    rng = random.Random(seed)
    data = [(rng.choice("hhhab"), rng.randint(0, 60), i) for i in range(200)]
    control = [(rng.choice("hhhab"), rng.randint(0, 60), i, rng.choice("xyz")) for i in range(120)]
    d = spark.createDataFrame(data, "key string, pos bigint, seq bigint")
    c = spark.createDataFrame(control, "key string, pos bigint, seq bigint, state string")
    found = {r["seq"]: r["state"] for r in pieces.as_of(d, c, ["key"], "pos", "seq", "state", limit).collect()}
    assert len(found) == len(data)
    for key, pos, seq in data:
        earlier = [x for x in control if x[0] == key and x[1] <= pos]
        wanted = max(earlier, key=lambda x: (x[1], x[2]))[3] if earlier else None
        assert found[seq] == wanted


def test_batch_gate_on_a_hot_partition_with_gaps(spark):
    rng = random.Random(7)
    offsets = sorted(rng.sample(range(1000), 137))
    bad = set(rng.sample(offsets, 9))
    log = spark.createDataFrame(
        [("t", 0, o, o in bad) for o in offsets], "topic string, partition int, offset bigint, bad boolean"
    )
    found = logs.batch_gate(log, F.col("bad"), 10, rows_per_piece=8).orderBy("batch").collect()
    assert [r["rows"] for r in found] == [10] * 13 + [7]
    for i, row in enumerate(found):
        chunk = offsets[i * 10 : i * 10 + 10]
        assert row["bad"] == len(bad & set(chunk)) and row["commit"] == (not bad & set(chunk))
        assert (row["first_offset"], row["last_offset"]) == (chunk[0], chunk[-1])
        assert row["full"] == (len(chunk) == 10)


def test_retain_bytes_on_a_hot_partition(spark):
    rng = random.Random(3)
    sizes = [rng.randint(1, 30) for _ in range(200)]
    log = spark.createDataFrame(
        [("t", 0, i, "x" * n) for i, n in enumerate(sizes)],
        "topic string, partition int, offset bigint, value string",
    )
    kept = {r["offset"] for r in keyed.retain_bytes(log, 500, rows_per_piece=9).collect()}
    total, wanted = 0, set()
    for i in reversed(range(200)):
        total += sizes[i]
        if total <= 500:
            wanted.add(i)
    assert kept == wanted


@pytest.mark.parametrize("limit", [4, None])
def test_rate_and_held_on_a_hot_series(spark, limit):
    rng = random.Random(11)
    t, value, rows = 1_700_000_000, 0.0, []
    for i in range(150):
        t += rng.randint(1, 40)
        value = 0.0 if rng.random() < 0.05 else value + rng.randint(0, 9)
        rows.append((i, "s", t, value, rng.random() < 0.7))
    df = spark.createDataFrame(rows, "i int, s string, t bigint, v double, on boolean").withColumn(
        "ts", F.timestamp_seconds("t")
    )
    rates = metrics.counter_rate(df, ["s"], "ts", "v", 60, rows_per_piece=limit)
    found = {r["i"]: r["rate"] for r in rates.collect()}
    gains = [0.0]
    for before, now in zip(rows, rows[1:]):
        gains.append(now[3] if now[3] < before[3] else now[3] - before[3])
    for i, row in enumerate(rows):
        wanted = sum(g for r, g in zip(rows, gains) if row[2] - 60 <= r[2] <= row[2]) / 60
        assert found[i] == pytest.approx(wanted)

    held = metrics.held(df, ["s"], F.col("on"), 60, "ts", rows_per_piece=limit)
    fire = {r["i"]: (r["since_us"], r["firing"]) for r in held.collect()}
    start = None
    for i, _, t, _, on in rows:
        start = (start if start is not None else t) if on else None
        if on:
            assert fire[i] == (start * 1_000_000, t - start >= 60)
        else:
            assert i not in fire


def test_windows_are_not_summed_anew_for_every_row(spark):
    """A window that holds most rows: its frames begin at an end, so a row is added once; huge values do not erase others."""
    rows = [("k", p, float(p % 5)) for p in range(0, 3000)] + [("k", 3000, 1e17), ("k", 9000, 2.0), ("k", None, 4.0), ("n", -7, None)]
    df = spark.createDataFrame(rows, "key string, pos bigint, w double")
    for limit in (None, 100):
        summed = pieces.cut(df, ["key"], "pos", limit).trailing_sum(2000, "w", "recent").rows()
        plan = summed._jdf.queryExecution().optimizedPlan().toString()
        assert "specifiedwindowframe(RangeFrame, -" not in plan and plan.count("unboundedpreceding$(), currentrow$()") >= 2
        found = {(r["key"], r["pos"]): r["recent"] for r in summed.collect()}
        assert len(found) == len(rows)
        assert found["k", 2999] == sum(p % 5 for p in range(999, 3000))
        assert (found["k", 9000], found["k", None], found["n", -7]) == (2.0, 4.0, None)
        assert found["k", 3000] == pytest.approx(1e17)
