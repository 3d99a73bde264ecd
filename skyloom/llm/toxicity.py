"""Operator 5: toxicity by logistic regression, learned with FTRL-proximal.

Features are hashed into ``1 << BITS`` coordinates: words, pairs of neighbours, and pairs with one word between
(A-Z lower-cased); a feature counts once per text. FTRL-proximal keeps a learning rate per coordinate, and its L1 term
leaves most weights at exactly zero, so the model is a short list that every task gets.

The model is fitted in one task on a bounded sample: at most ``TRAIN_ROWS`` labelled ids, the first by a hash of the id,
with one text each, and of them as many as have ``TRAIN_FEATURES`` distinct coordinates between them. Scoring reads every
text whole.

Defined cases: null and empty texts have no features and get the score of the bias alone; rows without an id are not
held out and never learned from; labels of ids that are not there, null labels and repeated labels (the highest
counts) are allowed; of several texts of a labelled id the one whose coordinates hash lowest is learned from; without
any usable label all weights are zero and every score is 0.5; a text of any length is scored whole; every row has its
score, equal texts the same; an empty table gives no rows. Extra columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.text import Words, find_words, list_array, mix64, slices, word_hashes
from skyloom.session import store

BITS = 20
TRAIN_ROWS = 20_000
TRAIN_FEATURES = 1 << 24  # coordinates of the sample that the training task holds
EPOCHS = 4
ALPHA, BETA, L2 = 4.0, 1.0, 0.1
L1 = 0.14  # times the root of the number of training texts, as the noise in sums of gradients grows
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
_SHIFT = np.uint64(64 - BITS)


def features(words: Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(coordinate, text) of every word, neighbour pair and skip pair, repeats included."""
    owner = words.texts_of_words()
    found, texts = [mix64(hashes + np.uint64(1))], [owner]
    for gap in (1, 2):
        if len(hashes) > gap:
            same = np.flatnonzero(owner[:-gap] == owner[gap:])
            found.append(mix64(hashes[same] * np.uint64(3 + 2 * gap) + hashes[same + gap]))
            texts.append(owner[same])
    return (np.concatenate(found) >> _SHIFT).astype(np.int32), np.concatenate(texts)


def fit(rows: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, strength: float = L1) -> tuple[np.ndarray, float]:
    """(weights, bias) from the distinct coordinates of each training text."""
    l1 = strength * math.sqrt(len(rows))
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias_z = bias_n = 0.0

    def weight(z, n, l1):
        size = np.abs(z) - l1
        return np.where(size > 0, -np.sign(z) * size / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    for epoch in range(epochs):
        for i in np.random.Generator(np.random.PCG64(epoch)).permutation(len(rows)).tolist():
            at = rows[i]
            w, bias = weight(z[at], n[at], l1), float(weight(np.float64(bias_z), np.float64(bias_n), 0.0))
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - labels[i]
            g2 = g * g
            z[at] += g - (np.sqrt(n[at] + g2) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g2
            bias_z += g - (np.sqrt(bias_n + g2) - np.sqrt(bias_n)) / ALPHA * bias
            bias_n += g2
    return weight(z, n, l1), float(weight(np.float64(bias_z), np.float64(bias_n), 0.0))


def held_out(doc_id) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """(coordinates, their weights, bias); the weights are at most ``1 << BITS`` numbers, most of them zero."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "toxic", "text")  # at most train_rows ids

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in slices(batch.column(2)):
                words = find_words(data, offsets, lower=True)
                at, owner = features(words, word_hashes(words))
                pairs = np.unique(owner.astype(np.int64) << BITS | at)
                bounds = np.searchsorted(pairs >> BITS, np.arange(end - row + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), batch.column(1).slice(row, end - row),
                     list_array((pairs & ((1 << BITS) - 1)).astype(np.int32), bounds, pa.int32())],
                    names=["doc_id", "toxic", "at"])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels, room = [], [], TRAIN_FEATURES
        for batch in batches:
            lists = batch.column(2)
            values, sizes = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
            fits = int(np.searchsorted(np.cumsum(sizes), room, "right"))
            ends = np.cumsum(sizes[:fits])
            texts += [x.copy() for x in np.split(values[:ends[-1]], ends[:-1])] if fits else []
            labels.append(batch.column(1).to_numpy()[:fits])
            room -= int(sizes[:fits].sum())
            if fits < len(sizes):
                break
        weights, bias = fit(texts, np.concatenate(labels)) if texts else (np.zeros(1), 0.0)
        at = np.flatnonzero(weights)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(weights[at], bias))], names=["at", "weight"])

    # one text per id, chosen before the shuffle: an id may have very many rows
    found = rows.mapInArrow(extract, "doc_id long, toxic int, at array<int>")
    examples = store(found.groupBy("doc_id", "toxic").agg(F.min_by("at", F.xxhash64("at")).alias("at")))
    ordered = examples.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
    model = ordered.mapInArrow(train, "at long, weight double").toPandas().sort_values("at")
    bias = model.loc[model["at"] == -1, "weight"].sum()
    model = model[model["at"] >= 0]
    return model["at"].to_numpy(), model["weight"].to_numpy(), float(bias)


def toxicity(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text)."""
    at, weights, bias = learn(docs, labels, train_rows)
    model = docs.sparkSession.sparkContext.broadcast((at.astype(np.int32), weights))

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        dense = np.zeros(1 << BITS)
        dense[model.value[0]] = model.value[1]
        out = []
        for row, end, data, offsets in slices(texts):
            words = find_words(data, offsets, lower=True)
            at, owner = features(words, word_hashes(words))
            counts = dense[at] != 0
            pairs = np.unique(owner[counts].astype(np.int64) << BITS | at[counts])
            total = np.bincount(pairs >> BITS, weights=dense[pairs & ((1 << BITS) - 1)], minlength=end - row) + bias
            out.append(1 / (1 + np.exp(-np.clip(total, -35, 35))))
        return pa.array(np.concatenate(out) if out else [], pa.float64())

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score(F.col("text").cast("string")).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
