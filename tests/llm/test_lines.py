import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from logweave.llm import line_dedup
from logweave.plans.sizing import settled

LONG = "this line is long enough to count "
SPACES = " \t\n\x0b\x0c\r"


def key_of(line):
    lower = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    return line.strip(SPACES).translate(lower)


def deduped_plainly(rows, shortest=20, documents=3):
    holders = defaultdict(set)
    for i, text, _ in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= shortest:
                holders[key_of(line)].add(i)
    order = lambda i: (i is not None, i or 0)
    last = {k: max(ids, key=order) for k, ids in holders.items() if len(ids) >= documents}
    found = []
    for i, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if last.get(key_of(x), i) == i]
        found.append((order(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(found)


def found_rows(df):
    return sorted(((r.id is not None, r.id or 0), r.n_lines, r.n_dropped, r.kept) for r in df.collect())


def random_rows(seed, count=120):
    rng = random.Random(seed)
    pool = [LONG + str(k) for k in range(25)] + ["short", "", "  ", "ÀÉÎ Ünïcode LINE of some length", "x" * 19, "x" * 20]

    def line():
        text = rng.choice(pool)
        text = text.upper() if rng.random() < 0.2 and text.isascii() else text
        return rng.choice(["", " ", "\t", "\x0b"]) + text + rng.choice(["", " ", "\r", "\x0c "])

    rows = []
    for i in range(count):
        size = 300 if i % 40 == 7 else rng.randint(0, 9)
        text = "\n".join(line() if rng.random() < 0.7 else f"a line of document {i} alone {rng.random()}" for _ in range(size))
        rows.append((i, text, "s"))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_lines_equal_plain_ones(make, seed):
    rows = random_rows(seed)
    rows += [(None, rows[3][1], "s"), (None, None, "s"), rows[5], (rows[6][0], rows[9][1], "s"), (500, None, None), (501, "", "")]
    assert found_rows(line_dedup.dedup(make(rows))) == deduped_plainly(rows)


def test_hot_keys_are_dealt_and_added_up(make):
    rows = [(i, f"{LONG}\nrow {i} has a line of its own here\n" + (LONG + "two" if i % 3 else ""), "s") for i in range(400)]
    rows += [(390, f"{LONG}\n{LONG}", "s"), (None, LONG, "s")]
    docs = make(rows)
    for runs in (5, 10_000):
        assert found_rows(line_dedup.dedup(docs, runs=runs)) == deduped_plainly(rows)
    hashes = settled(line_dedup.line_hashes(line_dedup._rows(docs, "doc_id", "text")), "t")
    hot = line_dedup.hot_keys(hashes, runs=5).collect()
    assert len(hot) == 2 and all(r.runs > 1 for r in hot)


def test_awkward_and_empty_tables(awkward, nothing):
    rows = [(r.doc_id, r.text, None) for r in awkward.collect()]
    assert found_rows(line_dedup.dedup(awkward)) == deduped_plainly(rows)
    assert line_dedup.dedup(nothing).collect() == []
    assert line_dedup.keep_bitmaps(nothing).collect() == []


def test_other_thresholds(make):
    rows = random_rows(4, 40)
    found = line_dedup.dedup(make(rows), shortest=5, documents=2)
    assert found_rows(found) == deduped_plainly(rows, 5, 2)


def test_bitmaps_are_short_and_rebuild_the_text(make):
    # Lines 0, 700 and 701 of a long document go; nothing is said of the words between.
    common = [LONG + str(k) for k in range(3)]
    own = [f"a line that only this document has, number {k}" for k in range(1000)]
    own[0], own[700], own[701] = common
    rows = [(1, "\n".join(own), "s")] + [(k, "\n".join(common), "s") for k in (5, 6, 7)]
    found = {r.id: r for r in line_dedup.keep_bitmaps(make(rows)).collect()}
    assert [(w.skip, w.bits) for w in found[1].keep] == [(0, -2), (9, ~(1 << 60 | 1 << 61))]
    assert (found[1].n_lines, found[1].n_dropped) == (1000, 3)
    assert found[7].keep is None and "kept" not in line_dedup.keep_bitmaps(make(rows)).columns
    assert found_rows(line_dedup.dedup(make(rows))) == deduped_plainly(rows)


def test_very_long_texts(make):
    many = "\n".join(LONG + str(k) for k in range(60_000))
    rows = [(k, many, "s") for k in range(3)] + [(9, "z" * 3_000_000, "s")]
    assert found_rows(line_dedup.dedup(make(rows))) == deduped_plainly(rows)


def test_the_scan_reads_its_ranges_as_they_are(make, monkeypatch):
    """One exchange by range feeds the windows, and nothing runs in Python."""
    plans = []
    monkeypatch.setattr(
        line_dedup,
        "settled",
        lambda df, label: (plans.append((label, df._jdf.queryExecution().executedPlan().toString())), settled(df, label))[1],
    )
    line_dedup.dedup(make(random_rows(5))).collect()
    (runs,) = [plan for label, plan in plans if label == "line-runs"]
    assert runs.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in runs
    assert runs.count("Sort [") == 1 and "SinglePartition" not in runs
    assert not any(word in plan for _, plan in plans for word in ("Python", "Arrow", "Pandas"))


def test_keys(one):
    assert one(line_dedup.line_key(F.col("x")), x="\t ÄB c \x0b\x0c\r") == "Äb c"
    assert one(line_dedup.line_key(F.col("x")), x=" \u00a0A ") == "\u00a0a"
