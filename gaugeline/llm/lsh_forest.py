"""Near duplicates by an LSH forest over MinHash signatures.

A document's set holds the 64-bit hashes of its distinct runs of five words. Documents of equal sets form a class, known
by two sums over the set; only its smallest document goes on. Of 128 minima over the set, each of 24 trees takes four in
an own permutation; documents that share the four form a region.

Every pair that shares a region is compared or ruled out. Up to eight members are compared with each other. The members of
a larger region are first compared with its hub, the member that stands in the largest regions over all trees (in a group
of edited copies that is the text they come from). Confirmed links give first groups. Then the region is dealt into blocks
and every two blocks meet in a task, which asks each pair that is not settled: by a common group, by its sizes, by too
unlike signatures, or by an earlier tree whose region both share. Documents of pairs that stay open bring their full sets,
and a task gives the links that join groups. So the compared pairs grow with the square of a crowded region, in arrays
within tasks of bounded size; rows grow with that square divided by the size of a block. Two sets with 0.85 of their union in
common share a region of some tree with a probability of 1 - (1 - 0.85^4)^24 > 0.9999999.

Too unlike signatures are five standard deviations below the threshold. All links are confirmed by the intersection of
full sets. Components of links are the groups.

Cases: null and empty texts and texts without words have an empty set and no links; fewer than five words count as one
run; long texts are read whole; rows that repeat a document id count as one document with the links of all its texts;
rows without an id come back with a null component and are kept; an empty table gives an empty one. Other columns of the
input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.components import components
from gaugeline.llm.tables import sent_if_small, stored
from gaugeline.llm.words import chunks, constants, gather, mix, windows, words_of

RUN = 5
MINIMA, TREES, DEPTH = 128, 24, 4
CROWD = 8
#: Members, and shingles in their sets, of a block of a crowded region.
BLOCK, BLOCK_SHINGLES = 256, 1_000_000
PERCENT = 85

_A, _B = constants(MINIMA, 11), constants(MINIMA, 13)
#: For each tree the numbers of its minima, in its order.
ORDERS = np.stack([np.argsort(constants(MINIMA, 100 + t))[:DEPTH] for t in range(TREES)])


def sets_of(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's runs of five words."""
    words = words_of(texts, lower=True)
    runs = windows(words.hash, RUN)
    out = []
    for i in range(len(texts)):
        a, b = int(words.first[i]), int(words.first[i + 1])
        if b - a >= RUN:
            out.append(np.unique(runs[a: b - RUN + 1]))
        else:
            out.append(windows(words.hash[a:b], b - a) + np.uint64(b - a) if b > a else runs[:0])
    return out


def signature(hashes: np.ndarray) -> np.ndarray:
    """The 128 minima of a set, 32 bits each."""
    low = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(hashes), 2048):
            np.minimum(low, (hashes[at: at + 2048, None] * _A + _B).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype(np.uint32)


def _keys(minima: np.ndarray) -> np.ndarray:
    """For each row and tree the hash of the tree and its minima."""
    with np.errstate(over="ignore"):
        out = np.arange(1, TREES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.zeros((len(minima), 1), np.uint64)
        for k in range(DEPTH):
            out = mix(out ^ (minima[:, ORDERS[:, k]].astype(np.uint64) + np.uint64(k + 1)))
    return out.view(np.int64)


def _lists(values: np.ndarray, width: int) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, len(values) + 1, width, dtype=np.int32), pa.array(values))


def sketch(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, n (size of the set), two sums that know the set, a byte of each minimum, the trees' keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                sets = sets_of(part.column(1))
                minima = np.stack([signature(s) for s in sets])
                with np.errstate(over="ignore"):
                    one = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                    two = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                low = np.ascontiguousarray(minima.astype(np.uint8))
                edges = np.arange(0, low.size + 1, MINIMA, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(one), pa.array(two),
                     pa.Array.from_buffers(pa.binary(), len(sets), [None, pa.py_buffer(edges), pa.py_buffer(low)]),
                     _lists(_keys(minima).ravel(), TREES)], names=["doc", "n", "one", "two", "low", "roots"])

    kind = docs.select(key).schema[0].dataType.simpleString()
    slim = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    return slim.mapInArrow(run, f"doc {kind}, n bigint, one bigint, two bigint, low binary, roots array<bigint>")


def shingle_sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc and its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                sets = sets_of(part.column(1))
                edges = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(edges, pa.array(values))], names=["doc", "hashes"])

    kind = docs.select(key).schema[0].dataType.simpleString()
    slim = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    return slim.mapInArrow(run, f"doc {kind}, hashes array<bigint>")


def _near_in_size(n: Column, m: Column, percent: int) -> Column:
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def _pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b) of documents whose sizes allow a link; rows have doc, n, hub, hub_n."""
    found = rows.filter((F.col("doc") != F.col("hub")) & _near_in_size(F.col("n"), F.col("hub_n"), percent))
    return found.select(F.least("doc", "hub").alias("a"), F.greatest("doc", "hub").alias("b"))


def _among(rows: DataFrame, key: str, percent: int) -> DataFrame:
    """Pairs within regions of at most CROWD members."""
    members = rows.groupBy(key).agg(F.array_sort(F.collect_set(F.struct("doc", "n"))).alias("m"))
    each = members.select(F.col("m"), F.posexplode("m").alias("i", "x"))
    pairs = each.select("x", F.explode(F.slice("m", F.col("i") + 2, CROWD)).alias("y"))
    pairs = pairs.filter(_near_in_size(F.col("x.n"), F.col("y.n"), percent) & (F.col("x.doc") != F.col("y.doc")))
    return pairs.select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b"))


def candidates(sketches: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a, b) to confirm, and the crowded regions' members: doc, n, k0, members."""
    roots = sketches.select("doc", "n", F.explode("roots").alias("k0"))
    shared = roots.groupBy("k0").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    roots = stored(roots.join(shared, "k0"), "roots")
    found = _among(roots.filter(F.col("members") <= CROWD), "k0", percent)
    crowded = roots.filter(F.col("members") > CROWD)
    weight = crowded.groupBy("doc").agg(F.sum("members").alias("weight"))
    tops = crowded.join(weight, "doc").groupBy("k0").agg(F.max(F.struct("weight", "doc", "n")).alias("top"))
    hubs = crowded.join(tops.select("k0", F.col("top.doc").alias("hub"), F.col("top.n").alias("hub_n")), "k0")
    return found.union(_pairs(hubs, percent)).distinct(), crowded


def _least_alike(percent: int) -> int:
    """Equal minima, of all, that a pair at the threshold has but for five standard deviations."""
    j = percent / 100
    return int(MINIMA * (j - 5 * (j * (1 - j) / MINIMA) ** 0.5))


def _open_pairs(sides: list[pa.Table], k0: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of either side that stand in a pair which no link, no size, no signature and no earlier tree settles."""
    n, group = ([t[c].to_numpy() for t in sides] for c in ("n", "group"))
    low = [np.frombuffer(b"".join(t["low"].to_pylist()), np.uint8).reshape(-1, MINIMA) for t in sides]
    roots = [t["roots"].combine_chunks().flatten().to_numpy().reshape(-1, TREES) for t in sides]
    tree = int(np.flatnonzero(roots[0][0] == k0)[0])
    least = _least_alike(percent)
    keep = [np.zeros(t.num_rows, bool) for t in sides]
    for at in range(0, len(n[0]), 64):
        rows = slice(at, at + 64)
        x, y = n[0][rows, None], n[1][None]
        ask = (group[0][rows, None] != group[1][None]) & (100 * np.minimum(x, y) >= percent * np.maximum(x, y))
        for t in range(tree):
            ask &= roots[0][rows, t, None] != roots[1][None, :, t]
        i, j = np.nonzero(ask)
        for cut in range(0, len(i), 50_000):
            a, b = i[cut: cut + 50_000], j[cut: cut + 50_000]
            alike = (low[0][rows][a] == low[1][b]).sum(axis=1) >= least
            keep[0][at + a[alike]] = True
            keep[1][b[alike]] = True
    return keep[0], keep[1]


def _common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many members each set of x has in common with each set of y."""
    shared = np.intersect1d(np.concatenate(x), np.concatenate(y))
    out = np.zeros((len(x), len(y)), np.int64)
    places = []
    for sets in (x, y):
        row, value = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets)
        spot = np.minimum(np.searchsorted(shared, value), max(len(shared) - 1, 0))
        met = shared[spot] == value if len(shared) else np.zeros(len(value), bool)
        order = np.argsort(spot[met], kind="stable")
        places.append((row[met][order], spot[met][order]))
    for at in range(0, len(shared), 4096):
        parts = []
        for (row, spot), sets in zip(places, (x, y)):
            a, b = np.searchsorted(spot, [at, at + 4096])
            part = np.zeros((len(sets), min(4096, len(shared) - at)), np.float32)
            part[row[a:b], spot[a:b] - at] = 1
            parts.append(part)
        out += (parts[0] @ parts[1].T).astype(np.int64)
    return out


def crowd_links(docs: DataFrame, sketches: DataFrame, crowded: DataFrame, groups: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """Links (a, b) within crowded regions that join different groups: a spanning forest of all that there are.

    A region is dealt into blocks, and every two blocks meet in a task of their own.
    """
    kind = sketches.select("doc").schema[0].dataType.simpleString()
    rows = crowded.join(groups.select(F.col("node").alias("doc"), "component"), "doc", "left")
    rows = stored(rows.withColumn("group", F.xxhash64(F.coalesce("component", "doc"))).drop("component"), "crowded")
    split = rows.groupBy("k0").agg(F.min("group").alias("one"), F.max("group").alias("other"), F.sum("n").alias("total"))
    rows = rows.join(split.filter("one < other"), "k0")
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("total") / BLOCK_SHINGLES))
    rows = rows.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")))
    rows = rows.join(sketches.select("doc", "low", "roots"), "doc").filter(F.array_contains("roots", F.col("k0")))
    met = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("k0", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc", "n", "group", "low", "roots")

    def sides_of(table: pa.Table) -> list[pa.Table]:
        block, i, j = (table[c].to_numpy() for c in ("block", "i", "j"))
        return [table.filter(pa.array(block == i)), table.filter(pa.array(block == j))]

    def ask(table: pa.Table) -> pa.Table:
        sides = sides_of(table)
        keep = _open_pairs(sides, table["k0"][0].as_py(), percent) if all(t.num_rows for t in sides) else [np.zeros(t.num_rows, bool) for t in sides]
        parts = [t.filter(pa.array(k)) for t, k in zip(sides, keep)]
        if table["i"][0] == table["j"][0]:
            parts = [sides[0].filter(pa.array(keep[0] | keep[1]))]
        return pa.concat_tables(parts).select(["k0", "i", "j", "block", "doc", "n", "group"])

    where = f"k0 bigint, i bigint, j bigint, block bigint, doc {kind}, n bigint, group bigint"
    unsettled = stored(met.groupBy("k0", "i", "j").applyInArrow(ask, where), "open")
    ids = sent_if_small(unsettled.select(F.col("doc").alias(key)).distinct(), "open-ids")
    sets = stored(shingle_sets(docs.select(key, text).join(ids, key, "left_semi"), key, text), "open-sets")

    def join(table: pa.Table) -> pa.Table:
        sides = sides_of(table)
        doc = [t["doc"].to_pylist() for t in sides]
        a, b = [], []
        if doc[0] and doc[1]:
            x, y = ([np.asarray(s) for s in t["hashes"].to_numpy()] for t in sides)
            common = _common(x, y)
            n, m = (np.array([len(s) for s in z]) for z in (x, y))
            group = [t["group"].to_numpy() for t in sides]
            linked = (100 * common >= percent * (n[:, None] + m[None] - common)) & (common > 0) & (group[0][:, None] != group[1][None])
            parent: dict[int, int] = {}

            def root(g: int) -> int:
                while parent.setdefault(g, g) != g:
                    parent[g] = g = parent[parent[g]]
                return g

            for i, j in np.argwhere(linked):
                g, h = root(int(group[0][i])), root(int(group[1][j]))
                if g != h:
                    parent[g] = h
                    a.append(min(doc[0][i], doc[1][j]))
                    b.append(max(doc[0][i], doc[1][j]))
        return pa.table({"a": pa.array(a, table.schema.field("doc").type), "b": pa.array(b, table.schema.field("doc").type)})

    return unsettled.join(sets, "doc").groupBy("k0", "i", "j").applyInArrow(join, f"a {kind}, b {kind}").distinct()


def confirmed(docs: DataFrame, sketches: DataFrame, pairs: DataFrame, key: str, text: str, percent: int = PERCENT) -> DataFrame:
    """Links (a, b): pairs whose full sets have `percent` of their union in common."""
    least = _least_alike(percent)
    ids = pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct()
    low = stored(sketches.select("doc", "low").join(ids, "doc", "left_semi"), "signatures")
    met = pairs.join(low.select(F.col("doc").alias("a"), F.col("low").alias("x")), "a")
    met = met.join(low.select(F.col("doc").alias("b"), F.col("low").alias("y")), "b").select("a", "b", "x", "y")

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, MINIMA) for k in (2, 3))
            keep = pa.array((x == y).sum(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    kind = sketches.select("doc").schema[0].dataType.simpleString()
    likely = stored(met.mapInArrow(alike, f"a {kind}, b {kind}").distinct(), "likely")
    ids = sent_if_small(likely.select(F.col("a").alias(key)).union(likely.select("b")).distinct(), "to-confirm")
    sets = stored(shingle_sets(docs.select(key, text).join(ids, key, "left_semi"), key, text), "sets")
    both = likely.join(sets.select(F.col("doc").alias("a"), F.col("hashes").alias("x")), "a")
    both = both.join(sets.select(F.col("doc").alias("b"), F.col("hashes").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    both = both.select("a", "b", common.alias("common"), (F.size("x") + F.size("y") - common).alias("all"))
    return both.filter(100 * F.col("common") >= percent * F.col("all")).select("a", "b")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """key, n_shingles, component_id and kept for every row."""
    sketches = stored(sketch(docs, key, text), "sketch")
    known = sketches.filter(F.col("doc").isNotNull() & (F.col("n") > 0))
    classes = stored(known.groupBy("one", "two", "n").agg(F.min("doc").alias("first")), "classes")
    firsts = known.join(classes.select(F.col("first").alias("doc")), "doc", "left_semi")
    firsts = stored(firsts.dropDuplicates(["doc", "one", "two"]), "firsts")
    pairs, crowded = candidates(firsts, percent)
    links = stored(confirmed(docs, firsts, pairs, key, text, percent), "links")
    links = links.union(stored(crowd_links(docs, firsts, crowded, components(links), key, text, percent), "crowd-links"))
    groups = components(links).select(F.col("node").alias("first"), "component")
    rows = sketches.select("doc", "one", "two", "n").join(classes, ["one", "two", "n"], "left").join(groups, "first", "left")
    component = F.coalesce("component", "first", "doc")
    return rows.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                       F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"))


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The documents without those that have a near duplicate of a smaller id in their group, with all their columns."""
    others = near_duplicates(docs, key, text, percent).filter(~F.col("kept")).select(key).distinct()
    others = sent_if_small(others, "others")
    return docs.join(others, key, "left_anti").select(*docs.columns)
