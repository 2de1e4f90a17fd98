"""Quality classifier: regularised quadratic discriminant over document statistics.

Both classes have a mean and a covariance of the transformed statistics, summed over
all labelled training rows; the covariance is shrunk towards the pooled one and
its own mean variance.  A score is the logistic of the difference of the two log
densities, each a Mahalanobis distance through the class's Cholesky factor, which
is worked out once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.words import WHITE_SPACE, byte_groups, small_batches, utf8, word_hashes
from logweave.plans.sizing import settled

FOLDS, HELD_OUT = 4, 2
POOLED, ROUND = 0.3, 0.02
# The difference of the log densities counts by this much: statistics that go
# together more closely than a normal distribution says would make it too sure.
TEMPER = 0.5
# Words of so many bytes are long.
LONG_WORD = 12
THRESHOLD = 0.7

STATISTICS = (
    "log_bytes",
    "log_words",
    "word_bytes",
    "upper",
    "digits",
    "marks",
    "stops",
    "wide",
    "lines",
    "distinct_words",
    "repeats",
    "distinct_pairs",
    "commonest",
    "long_words",
)
D = len(STATISTICS)


def _table(*ranges: range) -> np.ndarray:
    table = np.zeros(256)
    for r in ranges:
        table[list(r)] = 1
    return table


_UPPER, _DIGIT, _WIDE = _table(range(65, 91)), _table(range(48, 58)), _table(range(0xC0, 0x100))
_MARK = _table(range(33, 48), range(58, 65), range(91, 97), range(123, 127))
_STOP = _table(range(44, 45), range(46, 47))
_LINE = _table(range(10, 11))
_SPACE = WHITE_SPACE.astype(float)
_CONTINUED = _table(range(0x80, 0xC0))


def statistics(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of transformed statistics per text; shares enter as logits, so tails stay apart."""
    n = len(at) - 1
    out = np.zeros((n, D))
    words, bounds = word_hashes(data, at)
    sizes, counts = np.diff(at).astype(float), np.diff(bounds).astype(float)

    def per_text(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(table[data])])
        return sums[at[1:]] - sums[at[:-1]]

    chars = np.maximum(sizes - per_text(_CONTINUED), 1)
    marks, stops = per_text(_MARK), per_text(_STOP)

    def logit(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        p = (part + 0.5) / (whole + 1.0)
        p = np.clip(p, 1e-4, 1 - 1e-4)
        return np.log(p / (1 - p))

    distinct, repeats, pairs, common = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        own = words[a:b]
        if b > a:
            _, times = np.unique(own, return_counts=True)
            distinct[k], common[k] = len(times), times.max()
            repeats[k] = np.count_nonzero(own[1:] == own[:-1])
            pairs[k] = len(np.unique(own[:-1] * np.uint64(3) + own[1:])) if b - a > 1 else 1
    out[:, 0] = np.log1p(sizes)
    out[:, 1] = np.log1p(counts)
    out[:, 2] = np.log((chars - per_text(_SPACE) + 1) / (counts + 1))
    out[:, 3] = logit(per_text(_UPPER), chars)
    out[:, 4] = logit(per_text(_DIGIT), chars)
    out[:, 5] = logit(marks - stops, chars)
    out[:, 6] = logit(stops, np.maximum(counts, stops))
    out[:, 7] = logit(per_text(_WIDE), chars)
    out[:, 8] = logit(per_text(_LINE), chars)
    out[:, 9] = logit(distinct, counts)
    out[:, 10] = logit(repeats, counts)
    out[:, 11] = logit(pairs, np.maximum(counts - 1, 1))
    out[:, 12] = logit(common, counts)
    out[:, 13] = logit(long_words(data, at), counts)
    return out


def long_words(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many words of each text have ``LONG_WORD`` bytes or more."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~WHITE_SPACE[data]
    edge = np.ones(len(data) + 1, bool)
    np.not_equal(inside[1:], inside[:-1], out=edge[1:])
    edge[at] = True
    places = np.flatnonzero(edge)
    starts, ends = places[:-1], places[1:]
    starts = starts[inside[starts] & (ends - starts >= LONG_WORD)]
    return np.diff(np.searchsorted(starts, at)).astype(float)


@dataclass
class Model:
    """Means, Cholesky factors of the precisions and log priors of classes 0 and 1."""

    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        logs = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets, strict=True):
            logs.append(offset - 0.5 * np.square((x - mean) @ factor).sum(1))
        return 1 / (1 + np.exp(-np.clip(TEMPER * (logs[1] - logs[0]), -40, 40)))


def fit(counts: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> Model | float:
    """The discriminant from class counts, sums and sums of products; a constant for one class."""
    if counts.min() == 0:
        return float(counts[1] > 0)
    means = sums / counts[:, None]
    scatter = squares - counts[:, None, None] * means[:, :, None] * means[:, None, :]
    pooled = scatter.sum(0) / max(counts.sum() - 2, 1)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    factors, offsets = [], []
    for k in (0, 1):
        own = scatter[k] / max(counts[k] - 1, 1)
        weight = max(POOLED, D / (counts[k] + D))
        shrunk = ((1 - weight) * own + weight * pooled) / np.outer(scale, scale)
        shrunk = (1 - ROUND) * shrunk + ROUND * max(np.trace(shrunk) / D, 1e-3) * np.eye(D)
        low = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.solve(low, np.eye(D)).T / scale[:, None])
        offsets.append(np.log(counts[k] / counts.sum()) / TEMPER - np.log(np.diag(low)).sum())
    return Model(means, np.array(factors), np.array(offsets))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = utf8(batch.column("text"))
        for first, last in byte_groups(at):
            x = statistics(data[at[first] : at[last]], at[first : last + 1] - at[first])
            column = pa.ListArray.from_arrays(np.arange(0, x.size + 1, D, dtype=np.int32), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(first, last - first), column], ["id", "x"])


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and ``x``, the transformed statistics, of every row; a null text counts as empty."""
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    return rows.mapInArrow(_measure, f"id {dict(rows.dtypes)['id']}, x array<double>")


def _rows_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, D)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, sums, squares = np.zeros(2), np.zeros((2, D)), np.zeros((2, D, D))
    for batch in batches:
        x, y = _rows_of(batch.column("x")), batch.column("label").to_numpy(zero_copy_only=False)
        for k in (0, 1):
            own = x[y == k]
            counts[k] += len(own)
            sums[k] += own.sum(0)
            squares[k] += own.T @ own
    flat = np.concatenate([counts, sums.ravel(), squares.ravel()])
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int64()), pa.array(flat)], ["slot", "value"])


def train(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model | float:
    """The model of all labelled rows outside the held-out fold.

    ``rows`` comes from :func:`measured`.  Null labels and ids are left out; an id
    labelled twice has its larger label.  A task adds up its rows' moments, and
    ``2 + 2 D + 2 D**2`` sums come to the driver, whatever the data.  With one class
    only the score is that class, without any label 0.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    fold = F.pmod(F.crc32(F.col("id").cast("string")), F.lit(FOLDS))
    known = known.filter(fold != HELD_OUT).groupBy("id").agg(F.max("label").alias("label"))
    parts = rows.join(known, "id").select("x", "label").mapInArrow(_moments, "slot long, value double")
    totals = {r.slot: r.value for r in parts.groupBy("slot").agg(F.sum("value").alias("value")).collect()}
    flat = np.array([totals.get(k, 0.0) for k in range(2 + 2 * D + 2 * D * D)])
    return fit(flat[:2], flat[2 : 2 + 2 * D].reshape(2, D), flat[2 + 2 * D :].reshape(2, D, D))


def _score(model: Model | float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows_of(batch.column("x"))
            scores = np.full(len(x), model) if isinstance(model, float) else model.scores(x)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores)], ["id", "score"])

    return run


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Train on ``labels`` and score every row: ``id``, ``held_out``, ``score``, ``predicted``.

    Null and empty texts have the statistics of a text of no words; equal texts have
    equal scores; rows that repeat are scored each for itself; a null id is held out.
    Long texts are measured whole.  A score at the threshold is predicted 1.  Other
    columns are not read.
    """
    rows = settled(measured(docs, id_col, text_col), "quality-statistics")
    model = train(rows, labels, id_col)
    found = rows.mapInArrow(_score(model), f"id {dict(rows.dtypes)['id']}, score double")
    fold = F.pmod(F.crc32(F.col("id").cast("string")), F.lit(FOLDS))
    return found.select(
        "id",
        F.coalesce(fold == HELD_OUT, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
