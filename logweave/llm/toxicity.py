"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its distinct words, word pairs and pairs with one word left
out, as 32-bit hashes.  Every coordinate has its own learning rate, and the L1 term
leaves few weights, which go to all tasks as two short arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.rows import AT, FILE, in_files, located, without
from logweave.llm.words import PUNCTUATION, byte_groups, mix, small_batches, utf8, word_hashes
from logweave.plans.sizing import settled, small_side

# Training reads about this many labelled rows, chosen by a hash of their id, and never
# more than a quarter above; a feature must occur in MIN_ROWS of them, so there are fewer
# features than their words and the model is bounded by the sample, not by the corpus.
TRAIN_ROWS = 12_000
# Nor more bytes of text than this; a text of over a fiftieth of it is not learnt from.
TRAIN_BYTES = 96 << 20
MIN_ROWS = 4
EPOCHS = 6
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 1.0
FOLDS, HELD_OUT = 5, 0

_U = np.uint64
_PAIR = mix(np.arange(31, 35, dtype=_U)) | _U(1)
_STEP = 1 << 20
_BIAS = -1


def features(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """32-bit features of a run of words and the index of each one's first word."""
    kinds = [words]
    if len(words) > 1:
        kinds.append(mix(words[:-1] * _PAIR[0] + words[1:] * _PAIR[1]))
    if len(words) > 2:
        kinds.append(mix(words[:-2] * _PAIR[2] + words[2:] * _PAIR[3]))
    return (np.concatenate(kinds) >> _U(32)).astype(np.uint32), np.concatenate([np.arange(len(k)) for k in kinds])


def _reach(words: int) -> np.ndarray:
    return np.concatenate([np.full(max(0, words - k), k) for k in range(3)])


def distinct(words: np.ndarray) -> np.ndarray:
    """The distinct features of one text, in steps that bound memory for long texts."""
    found = [np.zeros(0, np.uint32)]
    for first in range(0, max(1, len(words)), _STEP):
        found.append(np.unique(features(words[first : first + _STEP + 2])[0]))
    return np.unique(np.concatenate(found))


@dataclass
class Model:
    """Sorted features, their weights and the bias; no bias if nothing was learnt."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float | None

    def scores(self, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The probability of the label for each of the texts whose words these are."""
        n = len(bounds) - 1
        if self.bias is None:
            return np.zeros(n)
        sums = np.full(n, self.bias)
        if len(self.keys) and len(words):
            seen = np.zeros(1 << 20, bool)
            seen[self.keys >> np.uint32(12)] = True
            hits = []
            for first in range(0, len(words), _STEP):
                some = words[first : first + _STEP + 2]
                found, at = features(some)
                last = at + _reach(len(some)) + first
                at = at + first
                own = np.searchsorted(bounds, at, "right") - 1
                near = seen[found >> np.uint32(12)] & (last < bounds[own + 1])
                found, own = found[near], own[near]
                place = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
                exact = self.keys[place] == found
                hits.append(own[exact].astype(np.int64) * len(self.keys) + place[exact])
            pairs = np.unique(np.concatenate(hits))
            sums += np.bincount(pairs // len(self.keys), self.weights[pairs % len(self.keys)], minlength=n)
        return 1 / (1 + np.exp(-np.clip(sums, -40, 40)))


def fit(rows: list[tuple[np.ndarray, int]]) -> Model:
    """FTRL-proximal over rows of (distinct features, label), in the order given."""
    if not rows:
        return Model(np.zeros(0, np.uint32), np.zeros(0), None)
    keys, counts = np.unique(np.concatenate([f for f, _ in rows]), return_counts=True)
    keys = keys[counts >= MIN_ROWS]
    coded = []
    for found, label in rows:
        place = np.searchsorted(keys, found)
        place[place == len(keys)] = 0
        known = keys[place] == found if len(keys) else np.zeros(len(found), bool)
        coded.append((np.append(place[known], len(keys)).astype(np.int32), label))
    z, n = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)
    l1 = np.full(len(keys) + 1, L1)
    l1[-1] = 0

    def weights(i: np.ndarray | slice) -> np.ndarray:
        over = np.maximum(np.abs(z[i]) - l1[i], 0)
        return -np.sign(z[i]) * over / ((BETA + np.sqrt(n[i])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for i, label in coded:
            w = weights(i)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum(), -40, 40))) - label
            square = gradient * gradient
            z[i] += gradient - (np.sqrt(n[i] + square) - np.sqrt(n[i])) / ALPHA * w
            n[i] += square
    w = weights(slice(None))
    used = np.flatnonzero(w[:-1])
    return Model(keys[used], w[used], float(w[-1]))


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        data, at = utf8(batch.column("text"))
        order, labels = batch.column("turn").to_pylist(), batch.column("label").to_pylist()
        for first, last in byte_groups(at):
            words, bounds = word_hashes(data[at[first] : at[last]], at[first : last + 1] - at[first], PUNCTUATION)
            for k in range(first, last):
                rows.append((order[k], labels[k], distinct(words[bounds[k - first] : bounds[k - first + 1]])))
    rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
    model = fit([(found, label) for _, label, found in rows])
    keys = [*model.keys.tolist(), *([] if model.bias is None else [_BIAS])]
    weights = [*model.weights.tolist(), *([] if model.bias is None else [model.bias])]
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(weights, pa.float64())], ["key", "weight"])


def remainder(id_col: str, folds: int = FOLDS):
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    rows: int = TRAIN_ROWS,
    size: int = TRAIN_BYTES,
) -> Model:
    """The model learnt from labelled rows outside the held-out fold.

    Null labels and null ids are left out; an id labelled twice has its larger label;
    rows that share an id share its label.  Without any labelled row nothing is
    learnt and every score is 0.

    ``rows`` and ``size`` (bytes) bound what the one task that trains is given,
    whatever ids the rows share and however long texts are; scoring is of all rows
    and whole texts.
    """
    small_batches(docs.sparkSession)
    docs = in_files(docs, "toxic-docs")
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    known = known.filter(remainder("id") != HELD_OUT).groupBy("id").agg(F.max("label").alias("label"))
    known = settled(known, "toxic-labels")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    all_rows = located(docs, F.col(id_col).alias("id"), text.alias("text"))
    turn = F.xxhash64(F.lit("turn"), F.col("id"))
    chosen = small_side(known.filter(_below(turn, rows, known.count())))
    row = F.xxhash64(F.lit("row"), F.col("id"), F.xxhash64("text"), F.col(AT))
    met = all_rows.join(chosen, "id").filter(F.octet_length("text") <= size // 50)
    met = met.select("id", "label", row.alias("row"), F.octet_length("text").cast("long").alias("bytes"), FILE, AT)
    met = settled(met, "toxic-met")
    found = met.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    # Where ids are shared or texts long there are too many: rows are thinned by their own hash, then counted off.
    most = rows + rows // 4
    share = min(1.0, rows / found["n"] if found["n"] > most else 1.0, size / max(1, found["bytes"]))
    kept = met.filter(_below(F.col("row"), share, 1))
    so_far = Window.orderBy("row", FILE, AT).rowsBetween(Window.unboundedPreceding, 0)
    counted = kept.select("label", FILE, AT, F.count(F.lit(1)).over(so_far).alias("n"), F.sum("bytes").over(so_far).alias("b"))
    kept = settled(counted.filter((F.col("n") <= most) & (F.col("b") <= size)).drop("n", "b"), "toxic-sample")
    sample = all_rows.join(small_side(kept), [FILE, AT])
    sample = sample.select(F.xxhash64(F.lit("order"), F.col("id")).alias("turn"), "label", "text")
    found = settled(sample.repartition(1).mapInArrow(_train, "key long, weight double"), "toxic-model").toPandas()
    bias = found[found.key == _BIAS].weight
    found = found[found.key != _BIAS].sort_values("key")
    return Model(
        found.key.to_numpy().astype(np.uint32), found.weight.to_numpy(), float(bias.iloc[0]) if len(bias) else None
    )


def _below(turn: Column, wanted: float, of: float) -> Column:
    """Is a hash in the first ``wanted`` of ``of`` parts?"""
    return F.pmod(turn, F.lit(1_000_000)) < F.lit(int(min(1.0, wanted / max(1, of)) * 1_000_000))


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column("text"))
            for first, last in byte_groups(at):
                words, bounds = word_hashes(data[at[first] : at[last]], at[first : last + 1] - at[first], PUNCTUATION)
                rows = batch.slice(first, last - first)
                kept = [rows.column(name) for name in ("id", FILE, AT)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(model.scores(words, bounds))], ["id", FILE, AT, "score"])

    return run


def scored(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """Every row of ``docs`` (a table from :func:`rows.in_files`) with ``score`` and ``predicted``.

    ``held_out`` tells whether the row's id is in the fold that training never
    sees (a null id is).  Null and empty texts have the score of a text without
    words; equal texts have equal scores.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = located(docs, F.col(id_col).alias("id"), text.alias("text"))
    kind = dict(rows.dtypes)["id"]
    found = rows.mapInArrow(_score(model), f"id {kind}, {FILE} string, {AT} long, score double")
    return found.select(
        "id",
        F.coalesce(remainder("id") == HELD_OUT, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        FILE,
        AT,
    )


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on ``labels`` and score every row: ``id``, ``held_out``, ``score``, ``predicted``.

    Every whole text is scored, however long; null and empty ones as texts without
    words; equal texts alike; rows that repeat each for itself.  A score of exactly the
    threshold is predicted 1.  An empty table gives no rows.  Other columns are not read.
    """
    docs = in_files(docs, "toxic-docs")
    return scored(docs, train(docs, labels, id_col, text_col), id_col, text_col).drop(FILE, AT)


def clean_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with all their columns."""
    docs = in_files(docs, "toxic-docs")
    found = scored(docs, train(docs, labels, id_col, text_col), id_col, text_col)
    return without(docs, found.filter("predicted = 1"), "toxic-rejected")
