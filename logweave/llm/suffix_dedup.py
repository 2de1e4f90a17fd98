"""Suffix-array dedup: bytes covered by a long string that also starts earlier are removed.

Every ``MATCH``-byte window names an anchor: the least-hashed ``ANCHOR``-byte string
in it, leftmost at ties.  Equal windows name equal anchors at the same place, so
windows are compared per anchor only, and anchors of a single document drop out
before any text moves.  What is left, runs of windows with their bytes, is dealt to
shards of bounded size by anchor.  A shard's strings are joined and their suffixes
sorted by induced sorting; permuted common prefixes cut the order into classes of
equal windows, and every window but its class's earliest is removed.

Copies are collapsed before: of documents with equal texts only the earliest takes
part, runs that repeat within a document are told by that document, and equal
strings of a shard are sorted once, for the earliest of them.  An anchor in more
than ``HOT`` documents is dealt out twice: first by anchor and a salt of the
document, then what is still earliest there window by window, by the window's own
bytes, so that no shard grows with the anchor.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.suffixes import permuted_prefixes, suffix_array
from logweave.llm.words import _power_tables, byte_groups, mix, small_batches, utf8
from logweave.plans.sizing import settled, small_side

MATCH = 100
ANCHOR = 32
HOT = 30_000
SHARD_BYTES = 4_000_000
PIECE = 1 << 22

_U = np.uint64
_PLACE = _U((1 << 24) - 1)
_RAW_VALUES = mix(np.arange(1, 257, dtype=_U))
_RANGE, _STRING = 0, 1
_ROW = "kind int, key long, doc long, mark long, start long, stop long, bytes binary"
_NAMES = ["kind", "key", "doc", "mark", "start", "stop", "bytes"]


def anchor_runs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of window starts with the same anchor: first start, number, hash of the anchor.

    ``data`` holds texts of less than 16 MB together, which start at ``at``; windows
    do not cross texts.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < MATCH:
        return none, none, np.zeros(0, _U)
    up, down = _power_tables(n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum(_RAW_VALUES[data] * up[:n], dtype=_U, out=sums[1:])
    hashes = mix((sums[ANCHOR:] - sums[:-ANCHOR]) * down[: n - ANCHOR + 1])
    least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=_U)
    span, width = MATCH - ANCHOR + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    places = (least & _PLACE).astype(np.int64)  # of n - MATCH + 1 windows
    valid = np.ones(len(places), bool)
    for cut in at[1:-1].tolist():
        valid[max(0, cut - MATCH + 1) : cut] = False
    fresh = np.ones(len(places), bool)
    fresh[1:] = (places[1:] != places[:-1]) | ~valid[:-1]
    fresh[at[:-1][at[:-1] < len(places)]] = True
    firsts = np.flatnonzero(valid & fresh)
    ends = np.flatnonzero(valid & np.append(fresh[1:] | ~valid[1:], True)) + 1
    return firsts, ends - firsts, hashes[places[firsts]]


def runs_of(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per text: its number, and its runs with starts counted from the text's start."""
    for first, last in byte_groups(at):
        low, high = int(at[first]), int(at[last])
        if last - first == 1 and high - low > PIECE:
            # One long text, in pieces that overlap by all but one byte of a window.
            found = []
            for start in range(low, high, PIECE):
                part = data[start : min(high, start + PIECE + MATCH - 1)]
                starts, counts, keys = anchor_runs(part, np.array([0, len(part)]))
                found.append((starts + (start - low), counts, keys))
            yield first, *map(np.concatenate, zip(*found, strict=True))
            continue
        starts, counts, keys = anchor_runs(data[low:high], at[first : last + 1] - low)
        cuts = np.searchsorted(starts, at[first : last + 1] - low)
        for k in range(first, last):
            own = slice(int(cuts[k - first]), int(cuts[k - first + 1]))
            yield k, starts[own] - (int(at[k]) - low), counts[own], keys[own]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct anchors of every document, and whether one comes twice in it."""
    for batch in batches:
        data, at = utf8(batch.column("text"))
        docs = batch.column("doc").to_numpy(zero_copy_only=False)
        keys, owners, twice = [], [], []
        for k, _, _, found in runs_of(data, at):
            own, times = np.unique(found, return_counts=True)
            keys.append(own.view(np.int64))
            owners.append(np.full(len(own), docs[k]))
            twice.append(times > 1)
        if keys:
            columns = [pa.array(np.concatenate(c)) for c in (keys, owners, twice)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "doc", "twice"])


class _Out:
    """Rows of ``_ROW`` as they are found."""

    def __init__(self) -> None:
        self.columns: list[list] = [[] for _ in _NAMES]
        self.size = 0

    def put(self, *row) -> None:
        for column, value in zip(self.columns, row, strict=True):
            column.append(value)
        self.size += len(row[-1] or b"") + 48

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int32(), *[pa.int64()] * 5, pa.binary()]
        made = [pa.array(c, k) for c, k in zip(self.columns, kinds, strict=True)]
        self.__init__()
        return pa.RecordBatch.from_arrays(made, _NAMES)


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs whose anchors are asked for; repeats within a document as ranges."""
    out = _Out()
    for batch in batches:
        data, at = utf8(batch.column("text"))
        docs, marks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "mark"))
        asked = batch.column("keys")
        for k, starts, counts, keys in runs_of(data, at):
            wanted = np.isin(keys.view(np.int64), asked[k].values.to_numpy(zero_copy_only=False))
            raw = data[at[k] : at[k + 1]].tobytes()
            seen: set[bytes] = set()
            again: tuple[list[int], list[int]] = ([], [])
            doc, mark = int(docs[k]), int(marks[k])
            own = keys[wanted].view(np.int64).tolist()
            for key, start, count in zip(own, starts[wanted].tolist(), counts[wanted].tolist(), strict=True):
                string = raw[start : start + count + MATCH - 1]
                if string in seen:
                    again[0].append(start)
                    again[1].append(start + len(string))
                else:
                    seen.add(string)
                    out.put(_STRING, key, doc, mark, start, start + len(string), string)
            for start, stop in merged(*again):
                out.put(_RANGE, 0, doc, mark, start, stop, None)
            if out.size > PIECE:
                yield out.batch()
    if out.columns[0]:
        yield out.batch()


def _batch(kind: int, key: np.ndarray, doc: np.ndarray, mark: np.ndarray, start: np.ndarray, stop: np.ndarray, strings=None):
    kinds = pa.array(np.full(len(key), kind, np.int32))
    numbers = [pa.array(c.astype(np.int64)) for c in (key, doc, mark, start, stop)]
    held = pa.nulls(len(key), pa.binary()) if strings is None else pa.array(strings, pa.binary())
    return pa.RecordBatch.from_arrays([kinds, *numbers, held], _NAMES)


def _flagged(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last of each run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def solve(table: pa.Table, survivors: bool) -> Iterator[pa.RecordBatch]:
    """The ranges that a shard's strings lose; with ``survivors`` also the strings left.

    Windows of one string all differ, as their anchor is at another place in each,
    so a string that alone has its anchor is not sorted.
    """
    key, doc, mark, start, stop = (table.column(c).to_numpy() for c in ("key", "doc", "mark", "start", "stop"))
    coded = table.column("bytes").combine_chunks().dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    codes = coded.indices.to_numpy(zero_copy_only=False)
    by_age = np.lexsort((start, mark, doc, codes))
    heads = np.ones(len(codes), bool)
    heads[1:] = codes[by_age][1:] != codes[by_age][:-1]
    chosen = by_age[heads]  # the earliest bearer of each distinct string, by code
    first = chosen[codes]
    whole = (doc != doc[first]) | (mark != mark[first]) | (start != start[first])
    yield _batch(_RANGE, *(c[whole] for c in (key, doc, mark, start, stop)))

    _, own, held = np.unique(key[chosen], return_inverse=True, return_counts=True)
    several = np.flatnonzero(held[own] > 1)
    if survivors:
        lone = chosen[np.flatnonzero(held[own] == 1)]
        if len(lone):
            strings = [coded.dictionary[int(codes[k])].as_py() for k in lone]
            yield _batch(_STRING, *(c[lone] for c in (key, doc, mark, start, stop)), strings)
    if not len(several):
        return
    strings = coded.dictionary.take(pa.array(several)).to_pylist()
    rows = chosen[several]
    _, ages = np.unique(np.stack([doc[rows], mark[rows]], 1), axis=0, return_inverse=True)
    ages = ages.reshape(-1)
    joined = b"\xff".join(strings) + b"\xff"
    raw = np.frombuffer(joined, np.uint8)
    symbols = np.where(raw == 0xFF, 0, raw.astype(np.int16) + 1).astype(np.int16)
    sizes = np.array([len(string) for string in strings], np.int64)
    firsts = np.concatenate([[0], np.cumsum(sizes[:-1] + 1)])
    order = suffix_array(symbols, 257, MATCH)
    common = permuted_prefixes(symbols, order, int(sizes.max()))
    # Only windows, in the order of their suffixes; a class ends where less than a window is shared.
    owner = np.repeat(np.arange(len(sizes)), sizes + 1)
    inside = np.arange(len(symbols)) - firsts[owner] <= sizes[owner] - MATCH
    classes = np.cumsum(common[order] < MATCH)
    windows = inside[order]
    places, classes = order[windows], classes[windows]
    age, at = ages[owner[places]], start[rows][owner[places]] + places - firsts[owner[places]]
    by_class = np.lexsort((at, age, classes))
    fresh = np.ones(len(by_class), bool)
    fresh[1:] = classes[by_class][1:] != classes[by_class][:-1]
    earliest = by_class[fresh][np.cumsum(fresh) - 1]
    removed = np.zeros(len(symbols), bool)
    removed[places[by_class]] = (age[by_class] != age[earliest]) | (at[by_class] != at[earliest])

    def told(flags: np.ndarray, kind: int) -> pa.RecordBatch:
        a, b = _flagged(flags)
        row = rows[owner[a]]
        shift = start[row] - firsts[owner[a]]
        parts = None
        if kind == _STRING:
            parts = [joined[i : j + MATCH - 1] for i, j in zip(a.tolist(), b.tolist(), strict=True)]
        return _batch(kind, key[row], doc[row], mark[row], a + shift, b + MATCH - 1 + shift, parts)

    yield told(removed, _RANGE)
    if survivors:
        yield told(inside & ~removed, _STRING)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Solve shards whose rows come one after the other; ranges pass."""
    now, parts = None, []

    def close() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts)
        if now < 0:
            for part in parts:
                yield part.select(_NAMES)
        else:
            yield from solve(table, bool(table.column("salted")[0].as_py()))

    for batch in batches:
        shard = batch.column("shard").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a == b:
                continue
            if parts and shard[a] != now:
                yield from close()
                parts = []
            now = shard[a]
            parts.append(batch.slice(a, b - a))
    if parts:
        yield from close()


def _sharded(strings: DataFrame, shards: int) -> DataFrame:
    """The strings solved shard by shard; there are as many tasks as shards, so a task does not grow with them."""
    tasks = max(shards, int(strings.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = strings.select("shard", "salted", *_NAMES).repartition(tasks, "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(_shards, _ROW)


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows with what orders them and whether an earlier document has the same text.

    ``doc`` is the id; for a null id a hash of the text stands in, above all usual ids.
    ``mark``, a hash of the text, tells apart rows that share an id; it is 0
    throughout where none do.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("mark", F.xxhash64("text"))
    stand_in = F.col("mark").bitwiseOR(F.lit(0x7000000000000000)).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))
    rows = rows.withColumn("doc", F.coalesce(F.col("id").cast("long"), stand_in))
    if rows.groupBy("doc").count().filter("count > 1").isEmpty():
        rows = rows.withColumn("mark", F.lit(0).cast("long"))
    rows = rows.withColumn("digest", F.unhex(F.md5("text")))
    bearers = rows.filter(F.octet_length("text") >= MATCH).groupBy("digest")
    firsts = bearers.agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    firsts = small_side(settled(firsts, "suffix-copies"), rows=2_000_000, size=96 << 20)
    copy = F.coalesce(F.col("doc") != F.col("first"), F.lit(False))
    return rows.join(firsts, "digest", "left").withColumn("copy", copy).drop("digest", "first")


def ranges(rows: DataFrame, hot: int = HOT) -> DataFrame:
    """Byte ranges that documents lose: ``doc``, ``mark``, ``start``, ``stop``; they may overlap.

    ``rows`` is of documents that are no copies.
    """
    small_batches(rows.sparkSession, 500)
    anchors = rows.filter(F.octet_length("text") >= MATCH).select("doc", "text")
    anchors = anchors.mapInArrow(_anchors, "key long, doc long, twice boolean")
    held = anchors.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("twice").alias("any_twice"))
    asked = anchors.join(held.filter("n > 1 OR any_twice"), "key").filter("n > 1 OR twice")
    asked = settled(asked.select("key", "doc", "n"), "suffix-asked")
    lists = asked.groupBy("doc").agg(F.collect_list("key").alias("keys"))
    total = asked.agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("most")).first()
    shards = max(1, -(-total.rows * 3 * MATCH // (2 * SHARD_BYTES)))
    involved = small_side(settled(lists.select("doc"), "suffix-involved"), rows=2_000_000)
    texts = rows.select("doc", "mark", "text").join(involved, "doc", "left_semi").join(lists, "doc")
    strings = texts.mapInArrow(_strings, _ROW)
    shard, salted = F.pmod(F.xxhash64("key"), F.lit(shards)), F.lit(False)
    if (total.most or 0) > hot:
        hot_keys = asked.filter(F.col("n") > hot).select("key", "n").distinct()
        strings = strings.join(small_side(settled(hot_keys, "suffix-hot")), "key", "left")
        salts = F.ceil(F.col("n") / F.lit(hot)).cast("int")
        salt = F.xxhash64("key", F.pmod(F.xxhash64("doc"), salts)).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))
        salted = F.col("n").isNotNull() & (F.col("kind") == _STRING)
        shard = F.when(salted, salt).otherwise(shard)
    passing = F.lit(-1) - F.pmod(F.xxhash64("doc"), F.lit(shards))
    shard = F.when(F.col("kind") == _RANGE, passing).otherwise(shard)
    found = settled(_sharded(strings.withColumn("shard", shard).withColumn("salted", salted), shards), "suffix-found")
    done = found.filter(F.col("kind") == _RANGE).select("doc", "mark", "start", "stop")
    if (total.most or 0) <= hot:
        return done
    # What is still earliest within its salt, window by window.
    left = found.filter(F.col("kind") == _STRING)
    left = left.withColumn("step", F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - MATCH)))
    left = left.select(
        "kind",
        "key",
        "doc",
        "mark",
        (F.col("start") + F.col("step")).alias("start"),
        (F.col("start") + F.col("step") + MATCH).alias("stop"),
        F.expr(f"substring(bytes, step + 1, {MATCH})").alias("bytes"),
    )
    windows = max(1, -(-left.count() * MATCH // SHARD_BYTES))
    own = F.pmod(F.xxhash64("bytes"), F.lit(windows))
    last = _sharded(left.withColumn("shard", own).withColumn("salted", F.lit(False)), windows)
    return done.union(last.select("doc", "mark", "start", "stop"))


def merged(starts: list[int], stops: list[int]) -> list[tuple[int, int]]:
    """Overlapping and touching ranges made one."""
    out: list[list[int]] = []
    for start, stop in sorted(zip(starts, stops, strict=True)):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [merged(a, b) for a, b in zip(batch.column("starts").to_pylist(), batch.column("stops").to_pylist(), strict=True)]
        columns = [pa.array([[s[k] for s in spans] for spans in own], pa.list_(pa.int64())) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("mark"), *columns], ["doc", "mark", "starts", "stops"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, sizes, lost, spans = [], [], [], []
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        columns = [batch.column(c).to_pylist() for c in ("copy", "starts", "stops")]
        for text, copy, starts, stops in zip(texts, *columns, strict=True):
            starts, stops = ([0], [len(text)]) if copy else (starts or [], stops or [])
            left = b"".join(text[a:b] for a, b in zip([0, *stops], [*starts, len(text)], strict=True))
            kept.append(left)
            sizes.append(len(text))
            lost.append(len(text) - len(left))
            spans.append(len(starts))
        columns = [*(pa.array(c, pa.int64()) for c in (sizes, lost, spans)), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["id", "n_bytes", "n_removed", "n_spans", "kept"])


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """Every row of ``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` and the ``kept`` bytes.

    Texts are UTF-8 bytes; null and texts under ``MATCH`` bytes lose nothing.  Of equal
    strings the one in the smallest id stays, then the leftmost.  Null ids come after
    all others, in the order of a hash of their text.  Rows that share an id are
    ordered by that hash too, and rows that repeat whole are one document that loses
    nothing to itself.  What is kept need not be valid UTF-8.  Of a long text only
    strings about its anchors are moved, and the whole of it is cut where it lies.  An
    empty table gives no rows, and other columns are not read.
    """
    rows = _identified(docs, id_col, text_col)
    found = ranges(rows.filter("NOT copy"), hot)
    lists = found.groupBy("doc", "mark").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
    schema = "doc long, mark long, starts array<long>, stops array<long>"
    cuts = small_side(settled(lists.mapInArrow(_merge, schema), "suffix-cuts"), rows=2_000_000, size=96 << 20)
    kind = dict(rows.dtypes)["id"]
    joined = rows.join(cuts, ["doc", "mark"], "left").select("id", "text", "copy", "starts", "stops")
    return joined.mapInArrow(_cut, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
