"""The trie of all prefixes of many sequences: who shares which beginning, and what sharing it saves.

A node is a distinct sequence of first d elements; its members are the sequences that start with it. The root (d = 0) has
all of them.

Method. Sequences are sorted over the cluster (by elements, then key, so that copies of one sequence spread over tasks).
Each task holds one sorted partition and computes the common prefix length of neighbours. These edges are merged by
union-find in descending depth, from left to right: raising a component to the depth of an edge makes the nodes of its
chain, and every merge makes a branching node or adds a child to it. What comes out is the forest of the partition.

Only prefixes of a partition's first and last sequence can stand in other partitions too. The forest is contracted to these
two spines, with what hangs from them summed up; all other nodes are final. Spines of up to `BLOCK` neighbouring
partitions are merged at shared nodes; all but the spines of the block become final, and so on until one block is
left. So a task holds a partition, or the spines of a block, never all nodes; spines are as many as partitions.

A final node below an open one does not know its parent's smallest member yet. It keeps the parent's digest and its own
partition, and learns it by a join on both, so the children of a very common node do not meet in one task.

The keys of sequences that end at an open node may be spread over partitions too. They travel as pieces of text in order,
and one digest per node is taken over the pieces as they stream by.

Elements are known by 128-bit digests (cut from SHA-256), nodes by digests of those. A sequence's digests, 24 bytes an
element, are one row.

Cases: rows with a null key are left out, a null array counts as empty; empty sequences end at the root; equal sequences
share all nodes; repeated keys count as often as they come; an empty table has no nodes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.tables import stored

BLOCK = 32
PIECE_KEYS = 4096
DIGEST = 16

FINAL, OPEN, PIECE = 0, 1, 2

#: Rows that tasks give out. FINAL nodes: those that were open before have a digest, those below an open parent its digest in place of
#: its key. OPEN nodes: n_children, n_leaves and saved are sums over final children. PIECE: keys that end at an open node, `depth`
#: counts the pieces of a partition.
_NODE = pa.schema([
    ("kind", pa.int32()), ("part", pa.int64()), ("left", pa.bool_()), ("right", pa.bool_()), ("digest", pa.binary()),
    ("parent_digest", pa.binary()), ("key", pa.int64()), ("parent_key", pa.int64()), ("depth", pa.int64()), ("weight", pa.int64()),
    ("n_members", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string())])
_NODE_DDL = ("kind int, part bigint, left boolean, right boolean, digest binary, parent_digest binary, key bigint, parent_key bigint, "
             "depth bigint, weight bigint, n_members bigint, n_children bigint, n_leaves bigint, saved bigint, ends string")
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def element_digest(*parts: Column) -> Column:
    """A digest of some strings, none null, that tells where one ends and the next begins."""
    marked = [x for p in parts for x in (F.octet_length(p).cast("string"), F.lit(":"), p)]
    return F.substring(F.unhex(F.sha2(F.concat(*marked), 256)), 1, DIGEST)


class Nodes:
    """Nodes as parallel lists, so that a partition's forest is made without an object per node."""

    def __init__(self):
        self.key, self.parent, self.depth, self.weight = [], [], [], []
        self.members, self.children, self.leaves, self.saved = [], [], [], []

    def add(self, key: int, depth: int, weight: int, members: int) -> int:
        for values, v in ((self.key, key), (self.parent, -1), (self.depth, depth), (self.weight, weight),
                          (self.members, members), (self.children, 0), (self.leaves, 0), (self.saved, 0)):
            values.append(v)
        return len(self.key) - 1

    def hang(self, child: int, parent: int) -> None:
        """Give a finished child to its parent."""
        self.parent[child] = parent
        self.children[parent] += 1
        self.leaves[parent] += self.leaves[child] or 1
        self.saved[parent] += self.saved[child] + (self.members[child] - 1) * self.weight[child]


def common_prefixes(paths: list[np.ndarray]) -> list[int]:
    """Common prefix lengths of neighbours; elements are rows of two 64-bit numbers."""
    out = []
    for a, b in zip(paths, paths[1:]):
        n = min(len(a), len(b))
        differ = (a[:n] != b[:n]).any(axis=1)
        out.append(int(differ.argmax()) if differ.any() else n)
    return out


def forest(keys: list[list[int]], paths: list[np.ndarray], weights: list[np.ndarray]) -> tuple[Nodes, list[int]]:
    """Nodes of distinct sorted sequences with the keys of each, and the node at which each sequence ends. The root is the last
    node. Sums of a node are over its children; its own share and its being a leaf are added when it is hung on its parent."""
    nodes, edges = Nodes(), common_prefixes(paths)
    union = list(range(len(paths)))
    tips = [nodes.add(min(k), len(p), int(w[-1]) if len(w) else 0, len(k)) for k, p, w in zip(keys, paths, weights)]
    top = list(tips)

    def find(i: int) -> int:
        while union[i] != i:
            union[i] = union[union[i]]
            i = union[i]
        return i

    def raised(i: int, to: int, path: int) -> int:
        """The top of component i after nodes were added down to depth `to`; all of it starts with `path`."""
        node = top[i]
        key, members, weight = nodes.key[node], nodes.members[node], weights[path]
        for depth in range(nodes.depth[node] - 1, to - 1, -1):
            above = nodes.add(key, depth, int(weight[depth - 1]) if depth else 0, members)
            nodes.hang(node, above)
            node = above
        return node

    for edge in sorted(range(len(edges)), key=lambda e: -edges[e]):
        depth = edges[edge]
        left, right = find(edge), find(edge + 1)
        node = raised(left, depth, edge)
        child = raised(right, depth + 1, edge + 1)
        nodes.hang(child, node)
        nodes.members[node] += nodes.members[child]
        nodes.key[node] = min(nodes.key[node], nodes.key[child])
        union[right] = left
        top[left] = node
    top[find(0)] = raised(find(0), 0, 0)
    return nodes, tips


def _pieces(keys: list[int], size: int) -> list[str]:
    """Decimal keys, comma-joined, in pieces of `size` keys that commas join again."""
    return [",".join(map(str, keys[i: i + size])) for i in range(0, len(keys), size)]


def _spine(path: np.ndarray) -> list[bytes]:
    """Digests of all prefixes of a sequence, the root's first."""
    out = [bytes(DIGEST)]
    for element in path:
        out.append(hashlib.sha256(out[-1] + element.tobytes()).digest()[:DIGEST])
    return out


def _batches(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(rows), 10_000):
        columns = zip(*rows[a: a + 10_000])
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _NODE)], schema=_NODE)


def _partition_nodes(batches: Iterator[pa.RecordBatch], piece_keys: int) -> Iterator[pa.RecordBatch]:
    """All nodes of a sorted partition, those of its first and last sequence left open."""
    keys: list[list[int]] = []
    paths: list[np.ndarray] = []
    weights: list[np.ndarray] = []
    for batch in batches:
        at = batch.column(1).offsets.to_pylist()
        elements = np.frombuffer(b"".join(batch.column(1).values.to_pylist()), np.uint64).reshape(-1, 2)
        sizes = batch.column(2).values.to_numpy(zero_copy_only=False)
        for i, key in enumerate(batch.column(0).to_pylist()):
            path = elements[at[i]: at[i + 1]]
            if paths and len(path) == len(paths[-1]) and (path == paths[-1]).all():
                keys[-1].append(key)
            else:
                keys.append([key])
                paths.append(path)
                weights.append(sizes[at[i]: at[i + 1]])
    if not paths:
        return
    nodes, tips = forest(keys, paths, weights)
    ended, part = dict(zip(tips, keys)), TaskContext.get().partitionId()
    digests: dict[int, bytes] = {}
    sides: list[set[int]] = []
    for tip, path in ((tips[0], paths[0]), (tips[-1], paths[-1])):
        sides.append(set())
        node = tip
        for digest in reversed(_spine(path)):
            digests[node] = digest
            sides[-1].add(node)
            node = nodes.parent[node]
    sums = {i: [0, 0, 0] for i in digests}
    rows = []
    for i, up in enumerate(nodes.parent):
        if i in digests:
            rows += [(PIECE, part, None, None, digests[i], None, None, None, seq, *[None] * 5, piece) for seq, piece in enumerate(_pieces(ended.get(i, []), piece_keys))]
            continue
        leaves, saved = nodes.leaves[i] or 1, nodes.saved[i] + (nodes.members[i] - 1) * nodes.weight[i]
        if up in digests:
            for k, more in enumerate((1, leaves, saved)):
                sums[up][k] += more
        sha = hashlib.sha256(",".join(map(str, ended[i])).encode()).hexdigest() if i in ended else _NO_ENDS
        rows.append((FINAL, part, None, None, None, digests.get(up), nodes.key[i], None if up in digests else nodes.key[up],
                     nodes.depth[i], nodes.weight[i], nodes.members[i], nodes.children[i], leaves, saved, sha))
    for i, digest in digests.items():
        rows.append((OPEN, part, i in sides[0], i in sides[1], digest, digests.get(nodes.parent[i]), nodes.key[i], None,
                     nodes.depth[i], nodes.weight[i], nodes.members[i], *sums[i], None))
    yield from _batches(rows)


def merged(rows: list[dict], size: int, last: bool) -> list[dict]:
    """Open nodes of neighbouring blocks of `size` partitions, merged; all but the outer spines are final, with `last` all."""
    order = sorted(rows, key=lambda r: r["part"])
    first, end = order[0]["part"] // size, order[-1]["part"] // size
    nodes: dict[bytes, dict] = {}
    for r in order:
        left, right = r["left"] and r["part"] // size == first, r["right"] and r["part"] // size == end
        known = nodes.setdefault(r["digest"], r | {"left": False, "right": False})
        known["left"], known["right"] = known["left"] or left, known["right"] or right
        if known["part"] != r["part"]:
            known["key"] = min(known["key"], r["key"])
            for c in ("n_members", "n_children", "n_leaves", "saved"):
                known[c] += r[c]
    for node in sorted(nodes.values(), key=lambda r: -r["depth"]):
        if not last and (node["left"] or node["right"]):
            continue
        node["kind"] = FINAL
        node["n_leaves"] = node["n_leaves"] or 1
        node["saved"] += (node["n_members"] - 1) * node["weight"]
        parent = nodes.get(node["parent_digest"])
        if parent:
            parent["n_children"] += 1
            parent["n_leaves"] += node["n_leaves"]
            parent["saved"] += node["saved"]
    return list(nodes.values())


def _merge_blocks(opened: DataFrame, size: int, last: bool) -> DataFrame:
    def merge(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(merged(table.select(_NODE.names).to_pylist(), size, last), _NODE)

    block = F.expr(f"part div {size * BLOCK}").alias("block")
    return stored(opened.groupBy(block).applyInArrow(merge, _NODE_DDL), "open-nodes")


def _ends(pieces: DataFrame) -> DataFrame:
    """digest and ends_sha256 of each open node at which keys end, from its pieces in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, sha = None, None
        for batch in batches:
            done = []
            for digest, piece in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                if digest != here:
                    done += [(here, sha.hexdigest())] if sha else []
                    here, sha = digest, hashlib.sha256(piece.encode())
                else:
                    sha.update(b"," + piece.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in done], pa.binary()), pa.array([s for _, s in done], pa.string())],
                                             names=["digest", "ends_sha256"])
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([here], pa.binary()), pa.array([sha.hexdigest()])], names=["digest", "ends_sha256"])

    ordered = pieces.select("digest", "part", "depth", "ends").repartition("digest").sortWithinPartitions("digest", "part", "depth")
    return ordered.mapInArrow(run, "digest binary, ends_sha256 string")


def prefix_trie(sequences: DataFrame, key: str = "key", elements: str = "elements", piece_keys: int = PIECE_KEYS) -> DataFrame:
    """All nodes: key (smallest member), depth, parent_key (of the parent; null for the root), weight (of the last element), n_members,
    n_children, n_leaves (childless nodes in the subtree), saved (summed over the subtree: (n_members - 1) * weight), ends_sha256
    (of the decimal keys of the sequences that end here, ascending, comma-joined).

    elements is an array of structs (digest: 16 bytes, see `element_digest`; weight: long); keys are whole numbers.
    """
    given = stored(sequences.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("key"), F.coalesce(F.col(f"{elements}.digest"), F.array().cast("array<binary>")).alias("path"),
        F.coalesce(F.col(f"{elements}.weight"), F.array().cast("array<bigint>")).alias("weights")), "sequences")
    dealt = given.repartitionByRange("path", "key").sortWithinPartitions("path", "key").select("key", "path", "weights")
    forests = stored(dealt.mapInArrow(lambda batches: _partition_nodes(batches, piece_keys), _NODE_DDL), "forests")
    opened, final = forests.filter(F.col("kind") == OPEN), forests.filter(F.col("kind") == FINAL)
    parts = (opened.agg(F.max("part")).first()[0] or 0) + 1
    size = 1
    while True:
        last = size * BLOCK >= parts
        blocks = _merge_blocks(opened, size, last)
        opened = blocks.filter(F.col("kind") == OPEN)
        # A node that was open is found by its digest; only these miss the digest of their ends.
        final = final.unionByName(blocks.filter(F.col("kind") == FINAL))
        if last:
            break
        size *= BLOCK
    columns = ["key", "depth", "parent_key", "weight", "n_members", "n_children", "n_leaves", "saved"]
    was_open = final.filter(F.col("digest").isNotNull())
    ends = _ends(forests.filter(F.col("kind") == PIECE))
    found = was_open.drop("ends").join(ends, "digest", "left").withColumn("ends", F.coalesce("ends_sha256", F.lit(_NO_ENDS)))
    rows = final.filter(F.col("digest").isNull()).unionByName(found.select(*final.columns))
    parents = forests.filter(F.col("kind") == OPEN).select("part", "digest").join(
        was_open.select("digest", F.col("key").alias("up")), "digest").select("part", F.col("digest").alias("parent_digest"), "up")
    known = rows.filter(F.col("parent_digest").isNull()).select(*columns, "ends")
    learnt = rows.filter(F.col("parent_digest").isNotNull()).join(parents, ["part", "parent_digest"])
    learnt = learnt.withColumn("parent_key", F.col("up")).select(*columns, "ends")
    return known.unionByName(learnt).withColumnRenamed("ends", "ends_sha256")


#: The registered query in DuckDB's SQL, whose crc32 is spelt out bit by bit.
SQL = """
WITH ids AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(4294967295, list_reduce(
    list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
    lambda c, b: list_reduce(range(8), lambda d, i: xor(d >> 1, (d & 1) * 3988292384), xor(c, b)), 4294967295)) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT i.conv_id, o.n, o.role, o.text FROM ids i JOIN own o ON o.conv_id = i.base AND o.n <= i.h
  UNION ALL SELECT i.conv_id, o.n, o.role, o.text FROM ids i JOIN own o ON o.conv_id = i.conv_id AND o.n > i.h),
told AS (
  SELECT conv_id, row_number() OVER by_n AS depth, strlen(text) AS weight,
         md5(string_agg(strlen(role) || ':' || strlen(text) || ':' || role || text, '|') OVER by_n) AS node
  FROM turns WINDOW by_n AS (PARTITION BY conv_id ORDER BY n)),
members AS (
  SELECT conv_id, depth, weight, node, lag(node, 1, '') OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM told
  UNION ALL SELECT conv_id, 0, 0, '', NULL FROM ids),
nodes AS (SELECT node, depth, parent, any_value(weight) AS weight, min(conv_id) AS conv_id, count(*) AS n_convs FROM members GROUP BY ALL),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (
  SELECT m.node, sum((u.n_convs - 1) * u.weight) AS saved_tokens, count(*) FILTER (k.node IS NULL) AS n_leaves
  FROM nodes u JOIN members m ON m.conv_id = u.conv_id AND m.depth <= u.depth LEFT JOIN kids k ON k.node = u.node GROUP BY m.node),
last AS (SELECT conv_id, arg_max(node, depth) AS node FROM members GROUP BY conv_id),
ends AS (SELECT node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM last GROUP BY node)
SELECT u.conv_id, u.depth, p.conv_id AS parent_conv_id, u.n_convs, coalesce(k.n_children, 0) AS n_children, b.n_leaves,
       b.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM nodes u LEFT JOIN nodes p ON p.node = u.parent LEFT JOIN kids k ON k.node = u.node JOIN below b ON b.node = u.node
LEFT JOIN ends e ON e.node = u.node
"""
