"""Language of every word by a linear-chain conditional random field, and of every text by its words.

A word's score for each language is a sum of weights over its features: two- and three-byte n-grams with the word's
borders, three-byte affixes, and whether it is one of the languages' frequent words (the lexicon, taken from the
training texts). Transition weights between the languages of neighbouring words are learned too. Forward-backward gives each
word's probabilities in the context of the whole text; a text's language is the one with the largest mean
probability over words with a letter, weighted by their length, and that mean is the score.

Forward-backward runs over all texts of a batch at once: a step is a small matrix, a text's first word is a matrix that
forgets, and the sequence is cut into blocks. Products of the blocks give what enters each block from either
side; then all blocks walk together. So whole texts of any length are handled exactly, in bounded memory.

The field is fitted on about `SAMPLE` texts with a known language, of each language those with the smallest hash of their key,
and at least `LEAST_OF_EACH`, for at most `MOST_LANGUAGES` languages.

Cases: null and empty texts and texts without a letter get `und` with score 0; words without a letter take part in the chain without
a vote; repeated rows get equal results; without training texts every text gets `und`; an empty table gives an empty one.
Only key, text and, for training, language are read.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.words import Words, chunks, constants, words_of

SAMPLE = 600
LEAST_OF_EACH = 20
#: Languages that are learned, the most frequent ones; so the sample is bounded whatever the column holds.
MOST_LANGUAGES = 200
#: Longest texts that are taken for training, in characters, so that the sample has a size in bytes too.
TRAINING_CHARS = 20_000
BUCKETS = 1 << 16
LEXICON = 100  # frequent words of each language
UNKNOWN = "und"

_KEEP = np.arange(256, dtype=np.uint8)
_KEEP[65:91] += 32
_KEEP[48:58] = 48
_KEEP[[*range(9, 14)]] = 32
_SALT = constants(4, 71)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters by their Unicode class."""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


def letter_starts(data: np.ndarray) -> np.ndarray:
    """The bytes of UTF-8 at which a letter begins."""
    out = (data < 128) & (((data | 32) >= 97) & ((data | 32) <= 122))
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        after = [np.concatenate([data[k:], np.zeros(k, np.uint8)])[lead].astype(np.int64) & 0x3F for k in (1, 2, 3)]
        first = data[lead].astype(np.int64)
        point = np.select([first < 0xE0, first < 0xF0], [(first & 0x1F) << 6 | after[0], (first & 0x0F) << 12 | after[0] << 6 | after[1]],
                          (first & 0x07) << 18 | after[0] << 12 | after[1] << 6 | after[2])
        out[lead] = _letters()[np.minimum(point, 0x10FFFF)]
    return out


def _bucket(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((x.astype(np.uint64) * _SALT[salt]) >> np.uint64(48)).astype(np.int64)


@dataclass
class Features:
    """n-grams of all words in order (`grams`, one array per kind, with `edge` of each word), affixes, lexicon place."""

    grams: list[np.ndarray]
    edge: np.ndarray
    affixes: list[np.ndarray]
    entry: np.ndarray
    letters: np.ndarray


def features_of(words: Words, lexicon: np.ndarray) -> Features:
    small = np.concatenate([[32], _KEEP[words.data], [32, 32, 32]]).astype(np.uint64)
    size = words.end - words.start
    edge = np.cumsum(size) - size
    at = np.repeat(words.start - edge, size) + np.arange(int(size.sum()))  # the bytes of words; small[i] is the byte before data[i]
    here, left, right = small[at + 1], small[at], small[at + 2]
    left[edge], right[edge + size - 1] = 32, 32  # texts lie side by side
    two = _bucket(left << np.uint64(8) | here, 0)
    three = _bucket(left << np.uint64(16) | here << np.uint64(8) | right, 1)
    mask = np.minimum(size, 3)
    front, back = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
    for k in range(3):
        inside = mask > k
        front[inside] = front[inside] << np.uint64(8) | small[words.start[inside] + 1 + k]
        back[inside] = back[inside] << np.uint64(8) | small[words.end[inside] - k]
    entry = np.minimum(np.searchsorted(lexicon, words.hash), max(len(lexicon) - 1, 0))
    known = lexicon[entry] == words.hash if len(lexicon) else np.zeros(len(size), bool)
    letters = np.add.reduceat(letter_starts(words.data)[at].astype(np.int64), edge) if len(size) else edge
    return Features([two, three], edge, [_bucket(front, 2), _bucket(back, 3)], np.where(known, entry + 1, 0), letters)


@dataclass
class Field:
    """Weights. Rows of `grams` and `affixes` are buckets, of `entries` lexicon places (0: not in it)."""

    languages: list[str]
    lexicon: np.ndarray
    grams: np.ndarray
    affixes: np.ndarray
    entries: np.ndarray
    transition: np.ndarray
    start: np.ndarray

    def emissions(self, f: Features) -> np.ndarray:
        if not len(f.edge):
            return np.zeros((0, len(self.languages)))
        out = sum(np.add.reduceat(self.grams[k][g], f.edge) for k, g in enumerate(f.grams))
        out = out + sum(self.affixes[k][a] for k, a in enumerate(f.affixes)) + self.entries[f.entry]
        return np.where((f.letters > 0)[:, None], out, 0.0)

    def marginals(self, words: Words, f: Features) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of each word's languages, and the expected number of transitions."""
        return forward_backward(self.emissions(f), first_words(words), self.transition, self.start)


def first_words(words: Words) -> np.ndarray:
    first = np.ones(len(words.text), bool)
    first[1:] = words.text[1:] != words.text[:-1]
    return first


def forward_backward(emission: np.ndarray, first: np.ndarray, transition: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, k = emission.shape
    if not n or not k:
        return np.zeros((n, k)), np.zeros((k, k))
    width = max(1, int(n ** 0.5))
    blocks = -(-n // width)
    weight = np.ones((blocks * width, k))
    weight[:n] = np.exp(emission - emission.max(axis=1, keepdims=True))
    step = np.exp(transition - transition.max())
    steps = np.broadcast_to(step, (blocks * width, k, k)) * weight[:, None, :]
    begins = np.flatnonzero(first)
    steps[begins] = (np.exp(start - start.max()) * weight[begins])[:, None, :]
    steps[n:] = np.eye(k)
    steps /= steps.sum(axis=(1, 2), keepdims=True)
    steps = steps.reshape(blocks, width, k, k).transpose(1, 0, 2, 3)  # place in the block first
    product = np.broadcast_to(np.eye(k), (blocks, k, k))
    for t in range(width):
        product = product @ steps[t]
        product = product / product.sum(axis=(1, 2), keepdims=True)
    into, out_of = np.empty((blocks, k)), np.empty((blocks, k))
    state = np.full(k, 1 / k)
    for b in range(blocks):
        into[b] = state
        state = state @ product[b]
        state = state / state.sum()
    state = np.full(k, 1 / k)
    for b in range(blocks - 1, -1, -1):
        out_of[b] = state
        state = product[b] @ state
        state = state / state.sum()
    alpha, beta = np.empty((width, blocks, k)), np.empty((width, blocks, k))
    state = into
    for t in range(width):
        state = (state[:, None, :] @ steps[t])[:, 0, :]
        state = state / state.sum(axis=1, keepdims=True)
        alpha[t] = state
    state = out_of
    for t in range(width - 1, -1, -1):
        beta[t] = state
        state = (steps[t] @ state[:, :, None])[:, :, 0]
        state = state / state.sum(axis=1, keepdims=True)
    alpha, beta = (x.transpose(1, 0, 2).reshape(-1, k)[:n] for x in (alpha, beta))
    probability = alpha * beta
    probability /= probability.sum(axis=1, keepdims=True)
    goes = np.flatnonzero(~first)
    pair = alpha[goes - 1][:, :, None] * step * (weight[goes] * beta[goes])[:, None, :]
    return probability, (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


def fit(texts: list[str], languages: list[str], rounds: int = 30, rate: float = 0.3, decay: float = 1e-3) -> Field:
    """Gradient ascent (Adam) on the likelihood of the sample, all words of a text in its language."""
    names = sorted(set(languages))
    words = words_of(pa.array(texts, pa.string()), lower=True)
    target = np.array([names.index(x) for x in languages], np.int64)[words.text]
    frequent: set[int] = set()
    for k in range(len(names)):
        frequent |= {h for h, _ in sorted(Counter(words.hash[target == k].tolist()).items(), key=lambda x: (-x[1], x[0]))[:LEXICON]}
    lexicon = np.array(sorted(frequent), np.uint64)
    f, k = features_of(words, lexicon), len(names)
    shapes = [(2, BUCKETS, k), (2, BUCKETS, k), (len(lexicon) + 1, k), (k, k), (k,)]
    weights = [np.zeros(s) for s in shapes]
    mean, square = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes]
    first, wanted = first_words(words), np.eye(k)[target]
    real = np.zeros((k, k))
    np.add.at(real, (target[:-1][~first[1:]], target[1:][~first[1:]]), 1)
    size = np.diff(np.append(f.edge, len(f.grams[0])))
    for t in range(1, (rounds if len(target) else 0) + 1):
        field = Field(names, lexicon, *weights)
        p, pairs = field.marginals(words, f)
        miss = np.where((f.letters > 0)[:, None], wanted - p, 0.0)
        of_grams = np.repeat(miss, size, axis=0)
        count = lambda i, w, m: np.stack([np.bincount(i, w[:, c], m) for c in range(k)], axis=1)
        steps = [np.stack([count(g, of_grams, BUCKETS) for g in f.grams]), np.stack([count(a, miss, BUCKETS) for a in f.affixes]),
                 count(f.entry, miss, len(lexicon) + 1), real - pairs, (wanted - p)[first].sum(axis=0)]
        for i, g in enumerate(steps):
            g = g / len(target) - decay * weights[i] / len(target)
            mean[i] = 0.9 * mean[i] + 0.1 * g
            square[i] = 0.99 * square[i] + 0.01 * g * g
            weights[i] = weights[i] + rate * (mean[i] / (1 - 0.9 ** t)) / (np.sqrt(square[i] / (1 - 0.99 ** t)) + 1e-8) * (square[i] > 0)
    return Field(names, lexicon, *(w.astype(np.float32) if i < 3 else w for i, w in enumerate(weights)))


def fit_on(docs: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang") -> Field:
    """The field of a bounded sample: of each language the rows with the smallest hash of their key, SAMPLE in all but at least
    LEAST_OF_EACH of each of the MOST_LANGUAGES most frequent ones, among those with a text of at most TRAINING_CHARS. So a rare
    language is learned too."""
    known = docs.filter(F.col(language).isNotNull() & F.col(text).isNotNull() & (F.length(text) <= TRAINING_CHARS))
    counted = known.groupBy(language).count().orderBy(F.desc("count"), language).limit(MOST_LANGUAGES)
    names = [r[0] for r in counted.collect()]
    known = known.filter(F.col(language).isin(names))
    share = max(LEAST_OF_EACH, SAMPLE // max(1, len(names)))
    # First the keys, so that small rows are ranked; each task keeps the first of each language before the shuffle.
    rank = F.row_number().over(Window.partitionBy("language").orderBy("h", "id"))
    chosen = known.select(F.col(key).alias("id"), F.col(language).alias("language"), F.xxhash64(key).alias("h")).withColumn("n", rank)
    chosen = chosen.filter(F.col("n") <= share).select("id", "language").distinct()
    joined = known.join(F.broadcast(chosen), known[key].eqNullSafe(F.col("id")) & (known[language] == chosen["language"]))
    rows = joined.select(F.xxhash64(key).alias("h"), known[language].alias("name"), F.col(text).alias("body")).withColumn(
        "n", F.row_number().over(Window.partitionBy("name").orderBy("h", "body"))).filter(F.col("n") <= share).collect()
    rows = sorted(rows, key=lambda r: (r["h"], r["name"], r["body"]))
    return fit([r["body"] for r in rows], [r["name"] for r in rows])


def _texts(part: pa.Array, field: Field) -> tuple[list[str], np.ndarray]:
    words = words_of(part, lower=True)
    f = features_of(words, field.lexicon)
    p, _ = field.marginals(words, f)
    k, n = len(field.languages), len(part)
    total = np.stack([np.bincount(words.text, p[:, c] * f.letters, n) for c in range(k)], axis=1) if k else np.zeros((n, 0))
    letters = np.bincount(words.text, f.letters, n)
    best = total.argmax(axis=1) if k else np.zeros(n, int)
    known = (letters > 0) & (k > 0)
    score = np.where(known, total[np.arange(n), best] / np.maximum(letters, 1), 0.0) if k else np.zeros(n)
    return [field.languages[b] if ok else UNKNOWN for b, ok in zip(best, known)], np.clip(score, 0, 1)


def predict(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred and score of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                names, score = _texts(part.column(1), sent.value)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(score)], names=["key", "lang_pred", "score"])

    kind = docs.select(key).schema[0].dataType.simpleString()
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return slim.mapInArrow(run, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def label_words(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and words: for each word of the text its language and the probability of it. For code-switched text."""
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                words = words_of(part.column(1), lower=True)
                f = features_of(words, sent.value.lexicon)
                p, _ = sent.value.marginals(words, f)
                best = p.argmax(axis=1) if p.size else np.zeros(len(p), int)
                rows = [[{"word": bytes(words.data[words.start[j]: words.end[j]]).decode(), "lang": sent.value.languages[best[j]] if f.letters[j] else UNKNOWN,
                          "p": float(p[j, best[j]]) if f.letters[j] else 0.0} for j in range(words.first[i], words.first[i + 1])] for i in range(part.num_rows)]
                kind = pa.list_(pa.struct([("word", pa.string()), ("lang", pa.string()), ("p", pa.float64())]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, kind)], names=["key", "words"])

    kind = docs.select(key).schema[0].dataType.simpleString()
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return slim.mapInArrow(run, f"key {kind}, words array<struct<word:string,lang:string,p:double>>").withColumnRenamed("key", key)
