import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from logweave.llm import exact_dedup, near_dedup, suffix_dedup, suffixes
from logweave.llm.components import components
from logweave.llm.rows import in_files, ranked


def by_text(rows):
    groups = {}
    for i, text, _ in rows:
        groups.setdefault(text or "", []).append(i)
    return groups


def test_exact_groups_and_one_row_stays(awkward):
    rows = [(r.doc_id, r.text, None) for r in awkward.collect()]
    groups = by_text(rows)
    found = exact_dedup.dedup(awkward).collect()
    assert len(found) == len(rows)
    for text, ids in groups.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        own = [r for r in found if r.digest == digest]
        assert len(own) == len(ids) and {r.group_size for r in own} == {len(ids)}
        known = [i for i in ids if i is not None]
        assert {r.keep_id for r in own} == {max(known) if known else None}
        assert sum(r.kept for r in own) == 1


def test_exact_stays_right_when_digests_collide(make):
    texts = ["aa", "bb", "aa", "cc", "bb", "d", "", None]
    docs = in_files(make([(i, t, "s") for i, t in enumerate(texts)]), "t")
    found = {r.id: r for r in exact_dedup.groups(docs, digest=lambda t: F.length(t).cast("string")).collect()}
    assert [found[i].keep_id for i in range(8)] == [2, 4, 2, 3, 4, 5, 7, 7]
    assert [found[i].group_size for i in range(8)] == [2, 2, 2, 1, 2, 1, 2, 2]


def test_exact_over_several_micro_batches(make):
    rows = [(i, f"text {i % 7}", "s") for i in range(200)]
    docs = in_files(make(rows).repartition(9), "t")
    found = exact_dedup.groups(docs, files_per_trigger=2).collect()
    assert all(r.keep_id == max(i for i in range(200) if i % 7 == r.id % 7) for r in found)
    assert sum(r.kept for r in found) == 7


def test_exact_kept_rows_keep_all_columns(awkward):
    kept = exact_dedup.kept_rows(awkward)
    assert kept.columns == awkward.columns
    assert sorted((r.text or "") for r in kept.collect()) == sorted({(r.text or "") for r in awkward.collect()})


@pytest.mark.parametrize(
    "operator", [exact_dedup.dedup, exact_dedup.kept_rows, near_dedup.dedup, near_dedup.kept_rows, suffix_dedup.dedup]
)
def test_empty_tables(nothing, operator):
    assert operator(nothing).collect() == []


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def components_of(texts):
    """Least index reachable through links, by comparing every two texts."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if r == old else r for r in root]
    return root


def edited(words, times, rng):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def near_texts(seed=1):
    rng = random.Random(seed)
    texts = []
    for family in range(6):
        base = [f"{family}x{rng.randrange(400)}" for _ in range(120)]
        texts += [edited(base, rng.randrange(0, 6), rng) for _ in range(25)]
    texts += ["one two three", "one two three", "ONE two\tthree", "", None, "  ", "a b c d e"]
    rng.shuffle(texts)
    return texts


def test_near_components_equal_those_of_all_pairs(make):
    texts = near_texts()
    found = {r.id: r for r in near_dedup.dedup(make([(i, t, "s") for i, t in enumerate(texts)])).collect()}
    wanted = components_of(texts)
    assert [found[i].component_id for i in range(len(texts))] == wanted
    assert [found[i].n_shingles for i in range(len(texts))] == [len(shingles(t)) for t in texts]
    assert all(found[i].kept == (wanted[i] == i) for i in range(len(texts)))


def test_near_blocks_of_large_groups_lose_nothing(make, monkeypatch):
    monkeypatch.setattr(near_dedup, "GROUP_ROWS", 10)
    texts = near_texts(2)
    found = {r.id: r.component_id for r in near_dedup.dedup(make([(i, t, "s") for i, t in enumerate(texts)])).collect()}
    assert [found[i] for i in range(len(texts))] == components_of(texts)


def test_near_awkward_rows(awkward):
    found = near_dedup.dedup(awkward).collect()
    prose = [r for r in found if r.component_id == 1]
    assert sorted(r.id for r in prose if r.id) == [1, 2, 2, 3, 8] and sum(r.kept for r in prose) == 1
    blank = [r for r in found if r.n_shingles == 0]
    assert len(blank) == 4 and all(r.kept and r.component_id == r.id for r in blank)
    assert near_dedup.kept_rows(awkward).columns == awkward.columns
    assert near_dedup.kept_rows(awkward).count() == sum(r.kept for r in found)


def test_pipeline_stages_equal_brute_force(spark, make):
    rng = random.Random(11)
    texts = []
    for family in range(12):
        base = [f"{family}x{k}" for k in range(100)]
        texts.append(" ".join(base))
        texts.append(" ".join(w if k not in (30, 60) else f"new{family}" for k, w in enumerate(base)))
        texts.append(" ".join(base[: 90 - family]))
    texts += [texts[0], texts[4], "", None, "short text"]
    rng.shuffle(texts)
    sets = [shingles(t) for t in texts]

    def likeness(a, b):
        return len(a & b) / len(a | b) if a | b else 0.0

    assert sum(0.8 <= likeness(a, b) < 0.85 for k, a in enumerate(sets) for b in sets[:k]) >= 12
    exact = corpus_pipeline.without_copies(spark, make([(i, t, "s") for i, t in enumerate(texts)]), "")
    left = sorted(r.doc_id for r in exact.collect())
    assert left == sorted(max(ids) for ids in by_text([(i, t, None) for i, t in enumerate(texts)]).values())
    root = {i: i for i in left}
    for a in left:
        for b in left:
            if b < a and likeness(sets[a], sets[b]) >= 0.8:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {i: new if r == old else r for i, r in root.items()}
    kept = corpus_pipeline.without_near_copies(spark, exact, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(root.values()))


def test_signatures_within_the_radius_always_share_a_key(spark):
    rng = np.random.default_rng(3)
    radius = 2 * near_dedup.CHUNKS - 1
    rows = []
    for pair in range(40):
        one = rng.integers(0, 1 << 16, near_dedup.CHUNKS * near_dedup.WIDTH).astype(np.uint16)
        two = one.copy()
        two[rng.choice(len(two), radius, replace=False)] ^= 1
        rows += [(pair, one.tobytes()), (pair, two.tobytes())]
    marks = spark.createDataFrame(rows, "pair long, mark binary")
    keys = marks.select("pair", F.explode(near_dedup._keys(F.col("mark"))).alias("key"))
    shared = keys.groupBy("pair", "key").count().filter("count = 2").select("pair").distinct()
    assert shared.count() == 40


def test_components_of_a_long_chain_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (7, 7), (None, 3), (200, 201)]
    found = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {(r.node, r.root) for r in found} == {(i, 0) for i in range(1, 41)} | {(201, 200)}


def test_ranks_follow_the_order(spark):
    df = spark.range(500).withColumn("k", F.col("id") % 3).repartition(7)
    found = ranked(df, [F.col("k").desc(), F.col("id")], "t").orderBy("rank").collect()
    assert [(r.k, r.id) for r in found] == sorted(((i % 3, i) for i in range(500)), key=lambda r: (-r[0], r[1]))
    assert [r["rank"] for r in found] == list(range(500))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=80))
def test_suffix_array_and_prefixes(symbols):
    array = np.array(symbols, np.int16)
    order = suffixes.suffix_array(array, 257, 10**6)
    assert order.tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])
    common = suffixes.permuted_prefixes(array, order, len(symbols))
    for before, here in zip(order.tolist(), order.tolist()[1:], strict=False):
        n = 0
        while max(before, here) + n < len(symbols) and symbols[before + n] == symbols[here + n]:
            n += 1
        assert common[here] == n


def removed(rows):
    """Per row of (id, text) its covered bytes, by remembering every string seen."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        raw = (text or "").encode()
        flags = [False] * len(raw)
        for p in range(len(raw) - 99):
            string = raw[p : p + 100]
            if string in seen:
                flags[p : p + 100] = [True] * 100
            seen.add(string)
        out[i] = bytes(b for b, f in zip(raw, flags, strict=True) if not f)
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 2])
def test_suffix_dedup_equals_brute_force(make, hot):
    rng = random.Random(4)
    words = ["the", "naïve", "engine", "reads", "日本語", "text", "and", "writes", "=====" * 30]
    passage = " ".join(rng.choice(words) for _ in range(60))
    rows = [(0, ""), (1, None), (2, "short"), (3, "ab" * 300), (4, "x" * 99), (5, "x" * 100), (6, "x" * 101)]
    for i in range(7, 40):
        text = " ".join(rng.choice(words) for _ in range(rng.randrange(1, 80)))
        rows.append((i, text + (passage if i % 3 else "") + text[: rng.randrange(0, 300)]))
    rows.append((40, rows[20][1]))
    found = {r.id: r for r in suffix_dedup.dedup(make([(i, t, "s") for i, t in rows]), hot=hot).collect()}
    wanted = removed(rows)
    assert {i: bytes(r.kept) for i, r in found.items()} == wanted
    for i, text in rows:
        assert found[i].n_bytes == len((text or "").encode())
        assert found[i].n_removed == found[i].n_bytes - len(wanted[i])


def test_suffix_dedup_awkward_rows(awkward):
    found = suffix_dedup.dedup(awkward).collect()
    assert len(found) == awkward.count()
    lost = {(r.id, r.n_removed == r.n_bytes) for r in found if r.n_bytes > 150 and r.id != 8}
    assert lost == {(1, False), (2, True), (3, False), (None, True)}


def test_anchor_runs_of_long_texts_do_not_depend_on_pieces(monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.integers(97, 123, 3_000_000, dtype=np.uint8)
    at = np.array([0, len(data)])
    starts, counts, keys = suffix_dedup.anchor_runs(data, at)
    whole = np.repeat(keys, counts)
    monkeypatch.setattr(suffix_dedup, "PIECE", 1 << 20)
    ((_, starts, counts, keys),) = suffix_dedup.runs_of(data, at)
    assert (np.repeat(keys, counts) == whole).all() and counts.sum() == len(data) - 99
