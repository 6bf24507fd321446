"""The trie against a plain count over all prefixes, however the sequences are spread over tasks."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gaugeline.llm import prefix_trie, queries


def plain_trie(sequences):
    """(key, list of (name, weight)) pairs to node rows."""
    members, ends, weight, kids = defaultdict(list), defaultdict(list), {(): 0}, defaultdict(set)
    for key, seq in sequences:
        for d in range(len(seq) + 1):
            prefix = tuple(seq[:d])
            members[prefix].append(key)
            if d:
                weight[prefix] = seq[d - 1][1]
                kids[prefix[:-1]].add(prefix)
        ends[tuple(seq)].append(key)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = leaves[p] or 1
        saved[p] += (len(members[p]) - 1) * weight[p]
        if p:
            leaves[p[:-1]] += leaves[p]
            saved[p[:-1]] += saved[p]
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids[p]), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def found(df):
    rows = df.select("key", "depth", "parent_key", "n_members", "n_children", "n_leaves", "saved", "ends_sha256").collect()
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in rows)


def table(spark, sequences):
    rows = [(k, [(bytes(f"{n:>16}", "ascii"), w) for n, w in s]) for k, s in sequences]
    return spark.createDataFrame(rows, "key long, elements array<struct<digest: binary, weight: long>>")


def some_sequences(seed, n):
    r = random.Random(seed)
    out = []
    for k in range(n):
        seq = [(f"{'abc'[r.randrange(3)]}{d}", d + 1) for d in range(r.choice([0, 1, 2, 3, 3, 5, 9]))]
        out.append((r.randint(-50, 10**9) if k % 7 else k, seq))
    return out + [(10**6 + i, [("a0", 1), ("b1", 2)]) for i in range(n // 3)]


@pytest.mark.parametrize("partitions", [1, 2, 7, 70])
def test_trie_equals_plain_count(spark, partitions):
    sequences = some_sequences(partitions, 400)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert found(prefix_trie.prefix_trie(table(spark, sequences))) == plain_trie(sequences)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("sequences", [
    [], [(5, [])], [(5, []), (3, [])], [(1, [("x", 2)])], [(9, [("x", 2)] * 400), (8, [("x", 2)] * 300), (7, [])]])
def test_small_and_long_tries(spark, sequences):
    assert found(prefix_trie.prefix_trie(table(spark, sequences))) == plain_trie(sequences)


def test_keys_of_a_common_sequence_are_digested_in_order(spark):
    sequences = [(k * 37 % 1009, [("a", 1)]) for k in range(300)]
    assert found(prefix_trie.prefix_trie(table(spark, sequences).repartition(5), piece_keys=3)) == plain_trie(sequences)


def test_left_out_keys_and_null_arrays(spark):
    df = table(spark, [(1, [("a", 1)]), (None, [("a", 1)])]).unionByName(
        spark.createDataFrame([(2, None)], "key long, elements array<struct<digest: binary, weight: long>>")).withColumn("depth", F.lit("x"))
    assert found(prefix_trie.prefix_trie(df)) == plain_trie([(1, [("a", 1)]), (2, [])])


def plain_rebuilt(rows):
    """(conv_id, turn, role, text) rows to (conv_id, sequence) pairs."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = (role or "").encode(), (text or "").encode()
            digest = hashlib.sha256(b"%d:%b%d:%b" % (len(role), role, len(text), text)).digest()[:16]
            own[c].append((turn is not None, turn or 0, digest, len(text)))
    own = {c: [(d, w) for _, _, d, w in sorted(t)] for c, t in own.items()}
    return [(c, own.get(c - c % 5, [])[: (h := zlib.crc32(str(c).encode()) % 9)] + t[h:]) for c, t in own.items()]


def test_query_on_awkward_rows(spark, tmp_path):
    r = random.Random(8)
    rows = [(c, r.choice([None, 0, 1, 2, 3, 7]), r.choice([None, "user", "tool"]), r.choice([None, "", "é", "a" * 70_000, "hi", "😀 x"]))
            for c in range(60) for _ in range(r.choice([1, 2, 3, 12])) if c % 11]
    rows += rows[:20] + [(None, 1, "user", "lost")] * 3 + [(61, 1, "u:1", "x"), (62, 1, "u", "1:x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("key", F.lit(1)).withColumn("own", F.lit(2))
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op12_prefix_trie(spark, str(tmp_path)).collect()
    assert sorted((x[0], x[1], -1 if x[2] is None else x[2], *x[3:]) for x in got) == plain_trie(plain_rebuilt(rows))


def test_query_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op12_prefix_trie(spark, str(tmp_path)).count() == 0
