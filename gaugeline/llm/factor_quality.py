"""Text quality by a factorisation machine.

A text becomes a sparse vector: the shares of its words by hash, the shares of its word shapes (length and last byte),
and figures of structure (lengths, lines, shares of capitals, digits, symbols and punctuation, repetition). The machine is
    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2),
all pairwise interactions at a cost linear in the number of features.

It is fitted on at most `SAMPLE` labelled texts, those with the smallest hash of their key, by AdaGrad in mini-batches;
vectors are made in Spark, and the fit sees at most SAMPLE x FEATURES numbers whatever the size of the corpus. Scoring
reads every text whole.

Cases: null and empty texts have no features but the constant and get the score of that; very long texts are read whole;
repeated rows get equal scores; without labelled rows every score is one half; an empty table gives an empty one; labels
other than 0 and 1 (and null) are left out; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.words import bytes_of, chunks, windows, words_of

SAMPLE = 3000
WORDS, SHAPES, FIGURES, FACTORS = 1 << 13, 1 << 12, 16, 8
FEATURES = WORDS + SHAPES + FIGURES
#: What shares are multiplied by, so that words, shapes and figures have about the same weight.
WORD_SCALE, SHAPE_SCALE = 4.0, 4.0

_KINDS = np.zeros((5, 256), bool)
_KINDS[0, 65:91] = _KINDS[1, 48:58] = True
_KINDS[2, [ord(c) for c in "#*$%&|<>"]] = True
_KINDS[3, [ord(c) for c in ".,;:?'\"()-"]] = True
_KINDS[4, ord("!")] = True


def vectors(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text numbers, feature numbers and values of all features that are not zero, sorted by text."""
    words, (data, offsets) = words_of(texts, lower=True), bytes_of(texts)
    n, count = len(texts), np.diff(words.first)
    share = 1 / np.maximum(count, 1)
    word = (words.hash % np.uint64(WORDS)).astype(np.int64)
    shape = WORDS + np.minimum(words.end - words.start, 15) * 256 + data[words.end - 1] if len(word) else word
    both = np.concatenate([words.text * FEATURES + word, words.text * FEATURES + shape])
    key, times = np.unique(both, return_counts=True)
    text, feature = key // FEATURES, key % FEATURES
    value = times * share[text] * np.where(feature < WORDS, WORD_SCALE, SHAPE_SCALE)

    figures = np.zeros((n, FIGURES))
    size = np.maximum(np.diff(offsets), 1)
    letters = np.maximum(np.bincount(words.text, words.end - words.start, n), 1)
    figures[:, 0] = 1
    figures[:, 1] = np.log1p(count) / 10
    figures[:, 2] = np.minimum(letters / np.maximum(count, 1) / 10, 3)
    figures[:, 3] = count < 20
    figures[:, 4] = count < 50
    for k, kind in enumerate(_KINDS):
        sums = np.append(0, np.cumsum(kind[data]))
        figures[:, 5 + k] = (sums[offsets[1:]] - sums[offsets[:-1]]) / letters * 3
    lines = np.append(0, np.cumsum(data == 10))
    lines = lines[offsets[1:]] - lines[offsets[:-1]] + 1
    figures[:, 10] = np.minimum(lines / size * 100, 3)
    figures[:, 11] = np.minimum(np.log1p(size / lines) / 5, 3)
    runs = windows(words.hash, 4)
    for i in range(n):
        a, b = words.first[i], words.first[i + 1]
        figures[i, 12] = 1 - len(np.unique(words.hash[a:b])) * share[i] if b > a else 0
        figures[i, 13] = 2 * (1 - len(np.unique(runs[a: b - 3])) / (b - a - 3)) if b - a > 3 else 0
    figures[:, 14] = figures[:, 13] > 0.4
    figures[:, 15] = figures[:, 7] > 0.15
    figures[count == 0, 1:] = 0
    rows, columns = np.nonzero(figures)
    text, feature = np.append(text, rows), np.append(feature, columns + WORDS + SHAPES)
    value = np.append(value, figures[rows, columns])
    order = np.argsort(text, kind="stable")
    return text[order], feature[order], value[order]


@dataclass
class Machine:
    bias: float
    weight: np.ndarray
    factors: np.ndarray

    def raw(self, text: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The machine's value for each of n texts, and the sums of factors."""
        part = self.factors[feature] * value[:, None]
        edges = np.searchsorted(text, np.arange(n))  # every text has the constant, so no run is empty
        sums = np.add.reduceat(part, edges) if n else np.zeros((0, FACTORS))
        squares = np.add.reduceat(part * part, edges) if n else sums
        linear = np.add.reduceat(self.weight[feature] * value, edges) if n else np.zeros(0)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums

    def score(self, texts: pa.Array) -> np.ndarray:
        value, _ = self.raw(*vectors(texts), len(texts))
        return 1 / (1 + np.exp(-np.clip(value, -50, 50)))


def sample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """h, label and text of the SAMPLE labelled documents with the smallest hash of their key."""
    known = labels.filter(F.col(label).isin(0, 1)).select(F.col(key).alias("id"), F.col(label).cast("int").alias("label"))
    known = known.join(docs.select(F.col(key).alias("id")).distinct(), "id").select("id", "label", F.xxhash64("id").alias("h"))
    chosen = known.orderBy("h", "label").limit(SAMPLE)
    return docs.join(F.broadcast(chosen), docs[key] == chosen["id"]).select("h", "label", F.col(text).alias("text"))


def labelled_vectors(chosen: DataFrame) -> DataFrame:
    """h, label, features and values of the rows of `sample`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                rows, feature, value = vectors(part.column(2))
                edges = np.searchsorted(rows, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.ListArray.from_arrays(edges, pa.array(feature.astype(np.int32))),
                     pa.ListArray.from_arrays(edges, pa.array(value.astype(np.float32)))], names=["h", "label", "features", "values"])

    return chosen.mapInArrow(run, "h bigint, label int, features array<int>, values array<float>")


def fit(chosen: DataFrame, epochs: int = 12, batch: int = 32, rate: float = 0.1, decay: float = 1e-4) -> Machine:
    """The machine that fits the rows of `sample`."""
    rows = sorted(labelled_vectors(chosen).toArrow().to_pylist(), key=lambda r: (r["h"], r["label"], r["features"], r["values"]))
    machine = Machine(0.0, np.zeros(FEATURES), np.random.default_rng(1).normal(0, 0.05, (FEATURES, FACTORS)))
    if not rows:
        return machine
    features = [np.array(r["features"]) for r in rows]
    values = [np.array(r["values"], float) for r in rows]
    labels = np.array([r["label"] for r in rows], float)
    seen_w, seen_v = np.full(FEATURES, 1e-6), np.full((FEATURES, FACTORS), 1e-6)
    seen_b, order = 1e-6, np.random.default_rng(2)
    for _ in range(epochs):
        mixed = order.permutation(len(rows))
        for at in range(0, len(rows), batch):
            chosen = mixed[at: at + batch]
            text_ = np.repeat(np.arange(len(chosen)), [len(features[i]) for i in chosen])
            feature, value = np.concatenate([features[i] for i in chosen]), np.concatenate([values[i] for i in chosen])
            raw, sums = machine.raw(text_, feature, value, len(chosen))
            error = (1 / (1 + np.exp(-np.clip(raw, -50, 50))) - labels[chosen]) / len(chosen)
            known, where = np.unique(feature, return_inverse=True)
            step_w = np.bincount(where, error[text_] * value) + decay * machine.weight[known]
            each = (error[text_] * value)[:, None] * (sums[text_] - machine.factors[feature] * value[:, None])
            step_v = np.stack([np.bincount(where, each[:, f]) for f in range(FACTORS)], axis=1) + decay * machine.factors[known]
            seen_w[known] += step_w ** 2
            seen_v[known] += step_v ** 2
            seen_b += error.sum() ** 2
            machine.weight[known] -= rate * step_w / np.sqrt(seen_w[known])
            machine.factors[known] -= rate / 2 * step_v / np.sqrt(seen_v[known])
            machine.bias -= rate * error.sum() / seen_b ** 0.5
    return machine


def score(docs: DataFrame, machine: Machine, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score (0 to 1) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sent.value.score(part.column(1)))], names=["key", "score"])

    kind = docs.select(key).schema[0].dataType.simpleString()
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return slim.mapInArrow(run, f"key {kind}, score double").withColumnRenamed("key", key)
