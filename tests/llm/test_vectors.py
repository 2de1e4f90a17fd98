import hashlib
import math
import random

import numpy as np
import pytest

from logweave.llm import centroids, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, id string, x string, rank string, h1 string, block string"


def vectors(spark, rows):
    """Rows of (vec_id, embedding) with further columns, some named like those used inside."""
    return spark.createDataFrame([(i, e, 1, "i", "x", "r", "h", "b") for i, e in rows], SCHEMA)


def made(count, width, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(width, width)) * spread
    return [(k, [float(np.float32(c)) for c in rng.normal(size=width) @ mixed]) for k in range(count)]


def awkward(width):
    nan, inf = float("nan"), float("inf")
    some = [0.25] * width
    return [
        (900, None),
        (901, []),
        (902, some[:-1] + [nan]),
        (903, some[:-1] + [inf]),
        (904, some[:-1] + [-inf]),
        (905, some[:-1] + [None]),
    ]


# --- whitening ------------------------------------------------------------------


def whitened_plainly(rows, most=16):
    usable = [(i, e) for i, e in rows if e and all(c is not None and math.isfinite(c) for c in e)]
    x = np.array([[math.floor(64 * c) + 1000000 for c in e] for _, e in usable], np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centre = fit - sums / n
    covariance = centre.T @ centre / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    told = min(most, int((values > values[0] * 1e-11).sum()))
    white = (x - sums / n) @ axes[:, :told] / np.sqrt(values[:told])
    deviation = ((n * x - sums) ** 2).sum(1)
    return n, [i for i, _ in usable], white, deviation, values[:told] / np.trace(covariance)


def as_table(found):
    return sorted((r.id is not None, r.id or 0, r.component, r.whitened, r.deviation) for r in found)


@pytest.mark.parametrize(("count", "width", "copies"), [(300, 64, 40), (40, 20, 3), (2500, 5, 200)])
def test_whitened_rows_equal_plain_ones(spark, count, width, copies):
    rows = made(count, width, width)
    rows += [(1000 + k, rows[0][1]) for k in range(copies)] + [rows[1], (None, rows[2][1])] + awkward(width)
    found = whitening.whiten(vectors(spark, rows)).collect()
    n, ids, white, deviation, explained = whitened_plainly(rows)
    assert {r.n for r in found} == {n} and {r.component for r in found} == set(range(1, len(explained) + 1))
    assert max(r.identity_error for r in found) < 1e-9
    by_component = {k: [r for r in found if r.component == k] for k in {r.component for r in found}}
    for k, own in by_component.items():
        assert own[0].explained == pytest.approx(explained[k - 1], rel=1e-9)
        wanted = sorted(zip([i is not None for i in ids], [i or 0 for i in ids], white[:, k - 1], strict=True))
        got = sorted((r.id is not None, r.id or 0, r.whitened) for r in own)
        assert [w[:2] for w in wanted] == [g[:2] for g in got]
        a, b = np.array([w[2] for w in wanted]), np.array([g[2] for g in got])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-7
    own = sorted((r.id is not None, r.id or 0, r.deviation) for r in by_component[1])
    assert own == sorted((i is not None, i or 0, int(d)) for i, d in zip(ids, deviation, strict=True))


def test_whitening_needs_several_blocks_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)
    monkeypatch.setattr(whitening, "BLOCKS_PER_TASK", 2)
    rows = made(150, 6, 3)
    found = whitening.whiten(vectors(spark, rows)).collect()
    _, _, white, _, _ = whitened_plainly(rows)
    got = np.zeros_like(white)
    for r in found:
        got[r.id, r.component - 1] = r.whitened
    assert np.abs(np.abs(got) - np.abs(white)).max() < 1e-8


def test_what_cannot_be_whitened(spark):
    alike = vectors(spark, [(k, [0.5, 0.25, -1.0]) for k in range(4)])
    assert whitening.whiten(alike).collect() == []
    assert whitening.whiten(vectors(spark, awkward(4))).collect() == []
    nothing = whitening.whiten(vectors(spark, []))
    assert nothing.collect() == []
    assert nothing.columns == ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    # A component without variance is left out, the others are not touched.
    flat = vectors(spark, [(k, [k / 8.0, 1.0, (k % 3) / 4.0]) for k in range(12)])
    assert {r.component for r in whitening.whiten(flat).collect()} == {1, 2}


def test_vectors_of_two_lengths_are_fitted_apart(spark):
    short, long = made(60, 3, 1), [(100 + i, e) for i, e in made(80, 4, 2)]
    both = whitening.whiten(vectors(spark, short + long)).collect()
    assert {(r.n, r.id >= 100) for r in both} == {(60, False), (80, True)}


def test_deviations_that_are_no_long_are_null(spark):
    rows = [(k, [float(k % 5) * 2.0**40, float(k)]) for k in range(50)]
    found = whitening.whiten(vectors(spark, rows)).collect()
    assert {r.deviation is None for r in found if r.id % 5 == 0} == {True}
    assert len(found) == 50 and all(math.isfinite(r.whitened) for r in found)


# --- clustering -----------------------------------------------------------------


def clustered_plainly(rows, clusters=8, rounds=10):
    usable = [(i, e) for i, e in rows if e and len(e) == 64 and all(c is not None and math.isfinite(c) for c in e)]
    whole = [(i, tuple(math.floor(1024 * c) for c in e)) for i, e in usable]
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    middle = [x for _, x in sorted(whole, key=lambda r: (name(r[0]), r[1]))[:clusters]]

    def assign():
        apart = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c, strict=True))
        return [min((apart(x, c), k) for k, c in enumerate(middle)) for _, x in whole]

    for _ in range(rounds):
        near = assign()
        for k in range(len(middle)):
            own = [x for (_, x), (_, at) in zip(whole, near, strict=True) if at == k]
            if own:
                middle[k] = tuple(sum(column) // len(own) for column in zip(*own, strict=True))
    near = assign()
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in middle]
    total = sum(d for d, _ in near)
    return [
        (i, k, d, sum(e for e, at in near if at == k), total, digest[k]) for (i, _), (d, k) in zip(whole, near, strict=True)
    ]


def in_order(rows):
    return sorted((r[0] is not None, *((r[0] or 0,) + tuple(r)[1:])) for r in rows)


def grouped_vectors(count, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(5, 64)) * scale
    return [
        (k, [float(np.float32(c)) for c in heads[k % 5] + rng.normal(size=64) * 0.3 * scale]) for k in range(count)
    ]


@pytest.mark.parametrize("scale", [0.01, 1.0, 3000.0])
def test_clusters_equal_plain_ones(spark, scale):
    rows = grouped_vectors(160, 4, scale) + awkward(64) + [(907, [0.5] * 63), (908, [0.5] * 65)]
    # One vector for a third of the rows, ids that repeat and are null.
    rows += [(200 + k, rows[3][1]) for k in range(80)] + [rows[7], (None, rows[9][1]), (None, rows[10][1])]
    random.Random(1).shuffle(rows)
    found = centroids.cluster(vectors(spark, rows)).collect()
    assert in_order(found) == in_order(clustered_plainly(rows))


def test_ties_go_to_the_smaller_cluster_and_few_vectors_to_few_clusters(spark):
    same = [(k, [0.125] * 64) for k in range(30)]
    found = centroids.cluster(vectors(spark, same)).collect()
    assert {(r.cluster, r.distance, r.inertia) for r in found} == {(0, 0, 0)}
    few = grouped_vectors(3, 5)
    assert in_order(centroids.cluster(vectors(spark, few)).collect()) == in_order(clustered_plainly(few))


def test_no_vectors_and_vectors_too_far_apart(spark):
    assert centroids.cluster(vectors(spark, awkward(64))).collect() == []
    assert centroids.cluster(vectors(spark, [])).collect() == []
    with pytest.raises(ValueError, match="do not fit a long"):
        centroids.cluster(vectors(spark, [(0, [1e30] * 64), (1, [-1e30] * 64)]))


@pytest.mark.parametrize("limit", [1, 2, 700, 1 << 27])
def test_plane_products_are_dot_products(limit):
    rng = np.random.default_rng(limit)
    values = rng.integers(-limit, limit, (50, 64))
    planes = 1 + max(int(values.max()).bit_length(), int(-values.min() - 1).bit_length())
    words = centroids.pack(values, planes)
    for k in range(5):
        assert (centroids.dots(words, words[k]).astype(np.int64) == values @ values[k]).all()
    assert (centroids.self_dots(words).astype(np.int64) == (values * values).sum(1)).all()


def test_only_counts_of_bits_leave_a_round(spark):
    rows = centroids.settled(centroids.integers(vectors(spark, grouped_vectors(100, 6)), "vec_id", "embedding"), "t")
    planes = centroids.planes_needed(rows)
    packed = rows.mapInArrow(centroids._packed(planes), "id long, planes array<long>").repartition(4)
    words = centroids.pack(np.array([[0] * 64, [512] * 64]), planes)
    told = packed.select("planes").mapInArrow(
        centroids._counted(words), "cluster int, plane int, vectors long, ones array<long>"
    )
    assert told.count() <= 4 * 2 * planes
