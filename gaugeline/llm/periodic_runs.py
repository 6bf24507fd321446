"""Periodic runs of words: every maximal stretch that repeats itself, and the text with the repeats taken out.

A run is a stretch of consecutive words with smallest period q (words q apart are the same), at least max(MIN_LENGTH, 2q)
words long, that neither neighbouring word extends.

Method, per text. Ukkonen's algorithm builds the suffix trees of the words and of the reversed words. A tour of each tree
gives its leaves in order and the depth of the lowest common ancestor of neighbouring leaves; a table of range minima over
these depths answers any "how far do the words from i and from j agree", forwards and backwards, in constant time. The leaf
order also gives the longest Lyndon word that starts at each place, under the order of the words and under its reverse.
The leftmost root of every run is among these at most 2n Lyndon words; each is extended in both directions by two such
questions, and what is long enough is a run.

Trees are built only where runs can be. The first words of a run, but for its last period and five words, all start a
group of GRAM words that comes again at most a period later. So streaks of such places are looked for by sorting hashes of
these groups; a streak of m places bounds the period by m + GRAM - 1 and the end of the run by m + 2 GRAM words after it.
Equal words have equal hashes, so no run is missed; the trees compare the words themselves.

Texts do not meet: no shuffle, and a task holds one text and the trees of one region of it at a time. A region takes some
hundred bytes a word while its tree is built; very long texts are looked at whole.

Cases: null and empty texts, and texts without words, have no runs and an empty collapsed text; rows with a null key and
repeated rows are handled like any other row; an empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 12
GRAM = MIN_LENGTH // 2
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 16


# --- suffix tree

def suffix_tree(symbols: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ukkonen's tree of symbols, whose last one stands nowhere else: per edge parent * width + first symbol, and the
    node it leads to (width is the largest symbol + 1); per node its depth in symbols. Leaves are as deep as suffixes are long."""
    n, width = len(symbols), max(symbols) + 1
    start, stop, link, depth, to = [0], [0], [0], [0], {}
    node = edge = length = left = 0
    for i, c in enumerate(symbols):
        left += 1
        last = 0
        while left:
            if not length:
                edge = i
            key = node * width + symbols[edge]
            child = to.get(key)
            if child is None:
                to[key] = len(start)
                if last:
                    link[last] = node
                    last = 0
            else:
                at = start[child]
                span = stop[child] - at
                if length >= span:
                    node, edge, length = child, edge + span, length - span
                    continue
                if symbols[at + length] == c:
                    if last:
                        link[last] = node
                    length += 1
                    break
                middle = len(start)
                start.append(at)
                stop.append(at + length)
                link.append(0)
                depth.append(left - 1)
                to[key] = middle
                start[child] = at + length
                to[middle * width + symbols[at + length]] = child
                to[middle * width + c] = middle + 1
                if last:
                    link[last] = middle
                last = middle
            start.append(i)
            stop.append(n)
            link.append(0)
            depth.append(n - i + left - 1)
            left -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - left + 1
    return np.fromiter(to.keys(), np.int64, len(to)), np.fromiter(to.values(), np.int64, len(to)), np.array(depth, np.int64)


def tour(edges: np.ndarray, nodes: np.ndarray, n_nodes: int, width: int, reverse: bool = False) -> np.ndarray:
    """Nodes in the order of a depth-first tour, children by symbol; reversed, the end symbol 0 still comes first."""
    parent, symbol = np.divmod(edges, width)
    if reverse:
        symbol = (width - symbol) % width
    order = np.lexsort((-symbol, parent))
    kids = nodes[order].tolist()
    first = np.searchsorted(parent[order], np.arange(n_nodes + 1)).tolist()
    out, stack = [], [0]
    while stack:
        u = stack.pop()
        out.append(u)
        a, b = first[u], first[u + 1]
        if a < b:
            stack += kids[a:b]
    return np.array(out, np.int64)


class RangeMinimum:
    """Minima of ranges in constant time and linear space: within blocks by prefixes and suffixes, over blocks by powers of two."""

    def __init__(self, values: np.ndarray):
        rows = -(-max(1, len(values)) // _BLOCK)
        blocks = np.full(rows * _BLOCK, np.iinfo(np.int64).max)
        blocks[: len(values)] = values
        self.values = blocks
        blocks = blocks.reshape(rows, _BLOCK)
        self.prefix = np.minimum.accumulate(blocks, axis=1).ravel()
        self.suffix = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        self.powers = [blocks.min(axis=1)]
        while 2 ** len(self.powers) <= rows:
            below, step = self.powers[-1], 2 ** (len(self.powers) - 1)
            self.powers.append(np.minimum(below[: len(below) - step], below[step:]))

    def between(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The smallest of values[a : b + 1], a <= b."""
        first, last = a // _BLOCK, b // _BLOCK
        out = np.minimum(self.suffix[a], self.prefix[b])
        gap = last - first - 1
        for k, table in enumerate(self.powers):
            here = np.flatnonzero((gap >= 2 ** k) & (gap < 2 ** (k + 1)))
            if len(here):
                out[here] = np.minimum(out[here], np.minimum(table[first[here] + 1], table[last[here] - 2 ** k]))
        here = np.flatnonzero(gap < 0)
        if len(here):
            at = a[here, None] + np.arange(_BLOCK)
            inside = at <= b[here, None]
            out[here] = np.where(inside, self.values[np.where(inside, at, a[here, None])], np.iinfo(np.int64).max).min(axis=1)
        return out


class Extension:
    """How far the symbols from two places agree, by common ancestors in the suffix tree. `ranks` are the suffixes' places in
    the leaf order, and with `both` also in that of the reversed alphabet."""

    def __init__(self, symbols: list[int], both: bool = False):
        ended = symbols + [0]
        edges, nodes, depth = suffix_tree(ended)
        width, n = max(ended) + 1, len(ended)
        leaf = np.ones(len(depth), bool)
        leaf[edges // width] = False
        up = np.zeros(len(depth), np.int64)
        up[nodes] = edges // width
        self.ranks = []
        for reverse in (False, True) if both else (False,):
            order = tour(edges, nodes, len(depth), width, reverse)
            is_leaf = leaf[order]
            rank = np.empty(n, np.int64)
            rank[n - depth[order[is_leaf]]] = np.arange(n)
            self.ranks.append(rank)
            if not reverse:
                after = np.flatnonzero(is_leaf[:-1]) + 1
                self.depths = RangeMinimum(depth[up[order[after]]])

    def agree(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common length from i != j; the place after the last symbol is allowed and agrees with nothing."""
        a, b = self.ranks[0][i], self.ranks[0][j]
        return self.depths.between(np.minimum(a, b), np.maximum(a, b) - 1)


def next_smaller(ranks: np.ndarray) -> np.ndarray:
    """The next place with a smaller rank, for all places but the last, which has the smallest."""
    out, stack = [0] * len(ranks), []
    for i, r in enumerate(ranks.tolist()):
        while stack and stack[-1][1] > r:
            out[stack.pop()[0]] = i
        stack.append((i, r))
    return np.array(out[:-1], np.int64)


def region_runs(symbols: list[int], min_length: int = MIN_LENGTH) -> np.ndarray:
    """All runs of a sequence of positive symbols as rows (start, length, period), by start and period."""
    n = len(symbols)
    forward, backward = Extension(symbols, both=True), Extension(symbols[::-1])
    place = np.tile(np.arange(n), 2)
    period = np.concatenate([next_smaller(r) for r in forward.ranks]) - place
    inside = place + period <= n - 1
    place, period = place[inside], period[inside]
    right = forward.agree(place, place + period)
    left = backward.agree(n - place, n - place - period)
    length = left + period + right
    found = length >= np.maximum(min_length, 2 * period)
    rows = np.stack([(place - left)[found], length[found], period[found]], axis=1)
    rows = np.unique(rows, axis=0)
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


# --- texts

def regions(hashes: np.ndarray, gram: int = GRAM) -> list[tuple[int, int]]:
    """Ranges of words outside which no run of 2 * gram words or more can be, from hashes of the words."""
    n = len(hashes)
    if n < 2 * gram:
        return []
    with np.errstate(over="ignore"):
        grams = hashes[: n - gram + 1].copy()
        for k in range(1, gram):
            grams = (grams ^ (grams >> np.uint64(29))) * _MULTIPLIER + hashes[k: n - gram + 1 + k]
    order = np.argsort(grams, kind="stable")
    again = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
    if not len(again):
        return []
    source, distance = order[again], order[again + 1] - order[again]
    by_place = np.argsort(source)
    source, distance = source[by_place], distance[by_place]
    while len(source):
        streak = np.cumsum(np.append(0, np.diff(source) != 1))
        size = np.bincount(streak)[streak]
        near = distance <= size + gram - 1
        if near.all():
            break
        source, distance = source[near], distance[near]
    if not len(source):
        return []
    first = np.flatnonzero(np.append(True, np.diff(source) != 1))
    size = np.diff(np.append(first, len(source)))
    start, end = source[first], np.minimum(n, source[first] + 2 * size + 2 * gram)
    open_until = np.maximum.accumulate(end)
    cut = np.append(True, start[1:] > open_until[:-1])
    return list(zip(start[cut].tolist(), open_until[np.append(np.flatnonzero(cut)[1:] - 1, len(end) - 1)].tolist()))


def text_runs(words: list, min_length: int = MIN_LENGTH) -> np.ndarray:
    """All runs of a list of words as rows (start, length, period), by start and period."""
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    found = [np.zeros((0, 3), np.int64)]
    for a, b in regions(hashes, max(1, min_length // 2)):
        known: dict = {}
        rows = region_runs([known.setdefault(w, len(known) + 1) for w in words[a:b]], min_length)
        rows[:, 0] += a
        found.append(rows)
    return np.concatenate(found)


def collapsed(words: list, runs: np.ndarray) -> list:
    """The words that no run holds after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return [words[i] for i in kept.tolist()]


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """Per row: key, n_words, runs (start, length, period; by start, then period), and text: the words kept, one space apart."""
    kind = docs.select(key).schema[0].dataType.simpleString()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            while at < batch.num_rows:  # a few megabytes of output at a time
                sizes, counts, rows, texts, held = [], [0], [], [], 0
                begin = at
                while at < batch.num_rows and held < 4 << 20:
                    words = (batch.column(1)[at].as_py() or "").encode().split()
                    runs = text_runs(words, min_length)
                    sizes.append(len(words))
                    rows.append(runs)
                    counts.append(counts[-1] + len(runs))
                    texts.append(b" ".join(collapsed(words, runs)))
                    held += len(texts[-1]) + 100
                    at += 1
                table = np.concatenate(rows)
                structs = pa.StructArray.from_arrays([pa.array(table[:, k]) for k in range(3)], fields=list(run_type))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, at - begin), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(counts, pa.int32()), structs), pa.array(texts, pa.binary()).cast(pa.string())],
                    names=["key", "n_words", "runs", "text"])

    found = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        run, f"key {kind}, n_words bigint, runs array<struct<start bigint, length bigint, period bigint>>, text string")
    return found.withColumnRenamed("key", key) if key != "key" else found
