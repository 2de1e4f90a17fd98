"""Near-dedup: b-bit MinHash signatures joined by Hamming distance, links confirmed on full sets.

A document's set is its distinct five-word shingles; documents with equal sets are
one class.  A signature is ``CHUNKS * WIDTH`` MinHash values of 16 bits, each by its
own hash function.  It is split into ``CHUNKS`` chunks, and a chunk may have one
wrong value: for each value the chunk is looked up without it.  By the pigeonhole
principle two signatures that differ in at most ``2 * CHUNKS - 1`` values agree on
some chunk up to one value, so all such pairs meet under some key, and so do most
pairs beyond.  At a similarity of 0.85 a chunk fits with probability 0.776, all ten
fail with 3 in 10 million; at 0.8 with probability 0.655, all ten fail with 2 in 100,000.

Keys do not emit pairs.  All that meet under a key are compared with the key's
least class, its leader; a leader's group holds everybody it met.  Inside a group a
set is known by its difference from the leader's set, so two members are compared
through those differences alone, by an inverted index over them.  Whoever is linked
to the leader is connected already, so only the others look for further links, and
a group gives back a spanning forest.  Any two that share a key share its leader's
group, hence no link is lost.  A group beyond ``GROUP_ROWS`` members is cut into
blocks, worked through by different tasks: each block meets the leader, and then each
block of those not linked to it meets each block of the group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.components import components
from logweave.llm.rows import AT, FILE, in_files, located, without
from logweave.llm.words import byte_groups, mix, shingle_sets, small_batches, utf8
from logweave.plans.sizing import settled, small_side

SHINGLE = 5
CHUNKS = 10
WIDTH = 6
PER_CENT = 85
GROUP_ROWS = 384
GROUP_SHINGLES = 1_000_000

_U = np.uint64
_HASHES = CHUNKS * WIDTH
_FACTORS = mix(np.arange(101, 101 + _HASHES, dtype=_U)) | _U(1)
_FLIPS = mix(np.arange(501, 501 + _HASHES, dtype=_U))


def signatures(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """16 low-order bits of the MinHash values of sets that are not empty, a row per set."""
    out = np.empty((len(bounds) - 1, _HASHES), np.uint16)
    for k in range(_HASHES):
        least = np.minimum.reduceat((sets ^ _FLIPS[k]) * _FACTORS[k], bounds[:-1])
        out[:, k] = (mix(least) & _U(0xFFFF)).astype(np.uint16)
    return out


def set_digests(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """16 bytes that name a set: two sums over its members."""
    out = np.empty((len(bounds) - 1, 2), _U)
    for k, flip in enumerate(mix(np.array([11, 12], _U))):
        out[:, k] = np.add.reduceat(mix(sets ^ flip), bounds[:-1])
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = utf8(batch.column("text"))
        for first, last in byte_groups(at):
            sets, bounds = shingle_sets(data[at[first] : at[last]], at[first : last + 1] - at[first], SHINGLE)
            sizes = np.diff(bounds)
            digests: list = [None] * (last - first)
            marks: list = [None] * (last - first)
            full = np.flatnonzero(sizes)
            if len(full):
                dense = np.concatenate([bounds[full], bounds[-1:]])
                for i, digest, mark in zip(full.tolist(), set_digests(sets, dense), signatures(sets, dense), strict=True):
                    digests[i], marks[i] = digest.tobytes(), mark.tobytes()
            rows = batch.slice(first, last - first)
            kept = [rows.column(name) for name in ("id", FILE, AT, "text_key")]
            columns = [*kept, pa.array(sizes), pa.array(digests, pa.binary()), pa.array(marks, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", FILE, AT, "text_key", "n_shingles", "digest", "mark"])


def sketched(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row its set's size, digest and signature; null for a text without words."""
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = located(docs, F.col(id_col).alias("id"), text.alias("text"), F.unhex(F.md5(text)).alias("text_key"))
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(
        _sketch,
        f"id {kind}, {FILE} string, {AT} long, text_key binary, n_shingles long, digest binary, mark binary",
    )


def _keys(mark: Column) -> Column:
    """Each chunk of a signature without each one of its values, as hashed keys."""
    found = []
    for chunk in range(CHUNKS):
        first = 1 + 2 * WIDTH * chunk
        for gap in range(WIDTH):
            left = F.substring(mark, first, 2 * gap)
            right = F.substring(mark, first + 2 * gap + 2, 2 * (WIDTH - 1 - gap))
            found.append(F.xxhash64(F.lit(chunk * WIDTH + gap), left, right))
    return F.array(*found)


def leader_pairs(classes: DataFrame) -> DataFrame:
    """Every class under every leader that it met under some key: ``leader``, ``node``."""
    keys = classes.select("node", F.explode(_keys(F.col("mark"))).alias("key"))
    met = keys.groupBy("key").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return keys.join(met.select("key", "leader"), "key").filter("node <> leader").select("leader", "node").distinct()


def linked(inter: np.ndarray, n: np.ndarray, m: np.ndarray | int, per_cent: int = PER_CENT) -> np.ndarray:
    return 100 * inter >= per_cent * (n + m - inter)


def forest(sets: list[np.ndarray], per_cent: int = PER_CENT) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``sets``, the first of which is the leader."""
    count = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    apart = [np.setxor1d(s, sets[0], assume_unique=True) for s in sets]
    far = np.array([len(d) for d in apart], np.int64)
    near = linked((sizes + sizes[0] - far) // 2, sizes, int(sizes[0]), per_cent)
    root = np.arange(count)
    edges = []
    for i in np.flatnonzero(near[1:]) + 1:
        root[i] = 0
        edges.append((0, int(i)))
    rest = np.flatnonzero(~near)
    if not len(rest) or count == 2:
        return edges
    owners = np.repeat(np.arange(count), far)
    _, codes = np.unique(np.concatenate(apart), return_inverse=True)
    order = np.argsort(codes, kind="stable")
    holders = owners[order]
    starts = np.concatenate([[0], np.cumsum(np.bincount(codes))])
    firsts = np.concatenate([[0], np.cumsum(far)])
    for y in rest.tolist():
        own = codes[firsts[y] : firsts[y + 1]]
        lengths = starts[own + 1] - starts[own]
        where = np.repeat(starts[own] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        common = np.bincount(holders[where], minlength=count)
        differ = far + far[y] - 2 * common
        found = linked((sizes + sizes[y] - differ) // 2, sizes, int(sizes[y]), per_cent)
        found[y] = False
        for x in np.flatnonzero(found & (root != root[y])).tolist():
            if root[x] != root[y]:
                edges.append((y, x))
                root[root == root[x]] = root[y]
    return edges


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, int, np.ndarray]]]:
    """(leader, node, set) of the members of one task after the other, the leader first."""
    now, group = None, []
    for batch in batches:
        data, at = utf8(batch.column("text"))
        tasks = list(zip(*(batch.column(c).to_pylist() for c in ("leader", "i", "j")), strict=True))
        nodes = batch.column("node").to_pylist()
        for first, last in byte_groups(at):
            sets, bounds = shingle_sets(data[at[first] : at[last]], at[first : last + 1] - at[first], SHINGLE)
            for k in range(first, last):
                if tasks[k] != now:
                    if group:
                        yield sorted(group, key=lambda g: g[0] != g[1])
                    now, group = tasks[k], []
                own = sets[bounds[k - first] : bounds[k - first + 1]]
                group.append((tasks[k][0], nodes[k], own.copy()))
    if group:
        yield sorted(group, key=lambda g: g[0] != g[1])


def _links(per_cent: int):
    """Spanning forests of the links in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches):
            found = [(group[a][1], group[b][1]) for a, b in forest([g[2] for g in group], per_cent)]
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _to_leader(per_cent: int):
    """Which members of each task are linked to their leader."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches):
            (leader, _, first), others = group[0], group[1:]
            if not others:
                continue
            common = [len(np.intersect1d(own, first, assume_unique=True)) for _, _, own in others]
            sizes = np.array([len(own) for _, _, own in others], np.int64)
            near = linked(np.array(common, np.int64), sizes, len(first), per_cent)
            nodes = [pa.array([leader] * len(others), pa.int64()), pa.array([g[1] for g in others], pa.int64())]
            yield pa.RecordBatch.from_arrays([*nodes, pa.array(near.astype(bool))], ["leader", "node", "near"])

    return run


def links(
    docs: DataFrame, text_col: str, classes: DataFrame, pairs: DataFrame, per_cent: int = PER_CENT
) -> DataFrame:
    """A spanning forest of the links among classes that met: ``a``, ``b``."""
    involved = pairs.select("node").union(pairs.select("leader")).distinct().join(classes, "node")
    involved = small_side(settled(involved.select("node", "text_key", "n_shingles"), "near-involved"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = (
        docs.select(text.alias("text"), F.unhex(F.md5(text)).alias("text_key"))
        .join(involved, "text_key")
        .groupBy("node")
        .agg(F.any_value("text").alias("text"), F.any_value("n_shingles").alias("n"))
    )
    members = pairs.union(pairs.select("leader", F.col("leader").alias("node")).distinct()).join(texts, "node")
    members = settled(members, "near-members")
    weights = members.groupBy("leader").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("weight"))
    blocks = _blocks("rows", "weight")
    large = small_side(settled(weights.select("leader", blocks.alias("blocks")).filter("blocks > 1"), "near-large"))
    spread = members.join(large, "leader", "left")
    small = spread.filter("blocks IS NULL").select("leader", F.lit(0).alias("i"), F.lit(0).alias("j"), "node", "text")
    found = _in_tasks(small, _links(per_cent), "a long, b long")
    if large.isEmpty():
        return found
    return found.union(_large_links(spread.filter("blocks IS NOT NULL"), per_cent))


def _blocks(rows: str, weight: str) -> Column:
    """How many blocks hold so many members with so many shingles."""
    return F.ceil(F.greatest(F.col(rows) / F.lit(GROUP_ROWS), F.col(weight) / F.lit(GROUP_SHINGLES))).cast("int")


def _in_tasks(dealt: DataFrame, run: Callable, schema: str) -> DataFrame:
    """Members dealt to tasks (leader, i, j), whose rows come one after the other."""
    return dealt.repartition("leader", "i", "j").sortWithinPartitions("leader", "i", "j").mapInArrow(run, schema)


def _large_links(members: DataFrame, per_cent: int) -> DataFrame:
    """Links within groups of more than one block, which no task gets whole.

    Every block meets the leader first, which takes time in proportion to the group.
    Members not linked to it are the rest; each block of the rest then meets every
    block of the group, the only pairs of blocks there are.
    """
    is_leader = F.col("node") == F.col("leader")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    placed = members.withColumn("block", own)
    first = placed.withColumn("j", F.explode(F.when(is_leader, every).otherwise(F.array("block"))))
    first = first.select("leader", F.lit(-1).alias("i"), "j", "node", "text")
    judged = settled(_in_tasks(first, _to_leader(per_cent), "leader long, node long, near boolean"), "near-judged")
    linked_to_leader = judged.filter("near").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    rest = judged.filter("NOT near").select("leader", "node")
    sized = rest.join(members.select("leader", "node", "n"), ["leader", "node"]).groupBy("leader")
    sized = sized.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("weight"))
    sized = small_side(settled(sized.select("leader", _blocks("rows", "weight").alias("rests")), "near-rests"))
    marked = rest.withColumn("apart", F.lit(True))
    both = placed.join(sized, "leader").join(small_side(marked), ["leader", "node"], "left")
    turn = F.pmod(F.xxhash64(F.lit("rest"), "node"), F.col("rests")).cast("int")
    rests = F.sequence(F.lit(0), F.col("rests") - 1)
    # The leader goes to every pair, a member to every block of the rest, one of the rest to all blocks too.
    at_i = F.explode(F.when(F.col("as_rest"), F.array(turn)).otherwise(rests)).alias("i")
    at_j = F.explode(F.when(F.col("as_rest") | is_leader, every).otherwise(F.array("block"))).alias("j")
    as_rest = F.explode(F.when(F.col("apart"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False))))
    dealt = both.withColumn("as_rest", as_rest)
    dealt = dealt.select("*", at_i).select("leader", "i", at_j, "node", "text")
    found = _in_tasks(dealt, _links(per_cent), "a long, b long")
    return linked_to_leader.union(found)


def grouped(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_cent: int = PER_CENT
) -> DataFrame:
    """Every row of ``docs`` (a table from :func:`rows.in_files`) with its component.

    Two rows are linked if their sets are similar by ``per_cent`` or more; the keys
    are made for 80 and above.
    Columns: ``id``, ``n_shingles``, ``component_id`` (least id reachable through
    links, its own included), ``kept`` (one row per component: a bearer of that
    id, the first by locator) and the row's locator.  Null and empty texts and
    texts of white space have no shingles and are components of their own, also
    if they repeat; other equal texts are linked.  Null ids do not count as least;
    a component of null ids only has a null ``component_id``.  Texts of any length are
    taken whole; of rows that tie for the least id the first by locator is kept.  An
    empty table gives no rows, and other columns are not read.
    """
    rows = settled(sketched(docs, id_col, text_col), "near-rows")
    best = F.min(F.struct("text_key", "mark", "n_shingles")).alias("best")
    classes = rows.filter("n_shingles > 0").groupBy("digest").agg(best)
    classes = settled(classes.select("digest", "best.*", F.monotonically_increasing_id().alias("node")), "near-classes")
    pairs = settled(leader_pairs(classes), "near-pairs")
    found = components(settled(links(docs, text_col, classes, pairs, per_cent), "near-links"), "a", "b")
    roots = classes.select("digest", "node").join(small_side(found), "node", "left")
    roots = roots.select("digest", F.coalesce("root", "node").alias("root"))
    narrow = rows.select("id", "n_shingles", "digest", FILE, AT)
    placed = settled(narrow.join(roots, "digest", "left"), "near-placed")
    row = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col(FILE), F.col(AT))
    ends = placed.filter("root IS NOT NULL").groupBy("root")
    ends = small_side(ends.agg(F.min(row).alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    joined = placed.join(ends, "root", "left")
    alone = F.col("least").isNull()
    return joined.select(
        "id",
        "n_shingles",
        F.when(alone, F.col("id")).otherwise(F.col("least.id")).alias("component_id"),
        (alone | row.eqNullSafe(F.col("least"))).alias("kept"),
        FILE,
        AT,
    )


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``n_shingles``, ``component_id``, ``kept``."""
    return grouped(in_files(docs, "near-docs"), id_col, text_col).drop(FILE, AT)


def kept_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_cent: int = PER_CENT
) -> DataFrame:
    """One row of ``docs`` per component, with all its columns."""
    docs = in_files(docs, "near-docs")
    return without(docs, grouped(docs, id_col, text_col, per_cent).filter("NOT kept"), "near-dropped")
