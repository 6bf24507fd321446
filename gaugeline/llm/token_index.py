"""Token ids in raw payload files, and a minimal perfect hash from document keys to places in them.

Files. Documents are sorted by key over the cluster and encoded; each gets an end id. A shard holds consecutive documents: their ids
one after the other, little-endian, two bytes each where the vocabulary allows it, else four; beside them the lengths,
the keys with two 64-bit hashes of each, and the number of ids before the shard in its part (a part is what one task wrote). A
shard closes at `SHARD_BYTES`, small enough that neither the JVM nor the Parquet writer holds large arrays; a longer document
has its own. Shards are rows of a Parquet table, so any store that Spark writes to can hold them.

Index. Keys are dealt into buckets of about `BUCKET_KEYS` by hash. Per bucket a minimal perfect hash gives each key its own
number below the number of keys: at each level a key hashes to a bit; bits that one key alone asks for are set, the
other keys go to the next level; a key's number is the count of set bits before its own. At that number stand a 32-bit
fingerprint of the key, which tells strangers, and part, shard, offset and length. A look-up costs a few hashes.

Cases: null and empty texts are the end id alone; very long texts are encoded whole; null keys are written first and
are not in the index; of rows that repeat a key all are written and read back, and the first is in the index; an empty table
gives empty files. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.byte_bpe import file_encoder
from gaugeline.llm.tables import stored
from gaugeline.llm.words import chunks, constants, mix

SHARD_BYTES = 1 << 18
BUCKET_KEYS = 4096
END = 2

_LEVEL = constants(128, 57)


# --- minimal perfect hash of one bucket

def _bit(one: np.ndarray, two: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(one * _LEVEL[2 * level] + mix(two * _LEVEL[2 * level + 1])) % np.uint64(size)).astype(np.int64)


def build_hash(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits of all levels and the levels' sizes, for distinct pairs (one, two)."""
    bits, sizes = [], []
    while len(one):
        size = max(64, 2 * len(one))
        at = _bit(one, two, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        bits.append(alone)
        sizes.append(size)
        one, two = one[~alone[at]], two[~alone[at]]
    return np.concatenate(bits) if bits else np.zeros(0, bool), np.array(sizes, np.int64)


def number_of(one: np.ndarray, two: np.ndarray, bits: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each key's number; -1 for keys that no level knows."""
    rank = np.cumsum(bits) - 1
    out, left, base = np.full(len(one), -1), np.arange(len(one)), 0
    for level, size in enumerate(sizes):
        at = base + _bit(one[left], two[left], level, int(size))
        out[left[bits[at]]] = rank[at[bits[at]]]
        left, base = left[~bits[at]], base + int(size)
    return out


def _fingerprint(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return (mix(one ^ mix(two)) >> np.uint64(32)).astype(np.uint32)


# --- files

def write_shards(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """The stored shards: part, seq, before, first, lengths, ones, twos, width, payload, keys."""
    kind = docs.select(key).schema[0].dataType.simpleString()
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    dealt = slim.repartitionByRange("key").sortWithinPartitions("key")
    dealt = dealt.select("key", "text", F.xxhash64("key").alias("one"), F.xxhash64("key", F.lit(1)).alias("two"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = file_encoder(tokenizer_path), TaskContext.get().partitionId()
        last = np.array([end], encoder.kind).tobytes()
        seq = before = 0
        held: list[tuple] = []

        def shard() -> pa.RecordBatch:
            nonlocal seq, before, held
            payload = b"".join(x for r in held for x in (r[3], last))
            lengths = [len(r[3]) // len(last) + 1 for r in held]
            row = {"part": [part], "seq": [seq], "before": [before], "first": pa.array([held[0][0]], kind_), "lengths": [lengths],
                   "ones": [[r[1] for r in held]], "twos": [[r[2] for r in held]], "width": [len(last)], "payload": [payload],
                   "keys": pa.array([[r[0] for r in held]], pa.list_(kind_))}
            seq, before, held = seq + 1, before + sum(lengths), []
            return pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(row.values(), types)], names=list(row))

        size = 0
        kind_ = pa.int64()
        for batch in batches:
            kind_ = batch.schema.field(0).type
            types = [pa.int32(), pa.int64(), pa.int64(), kind_, pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.binary(), None]
            for piece in chunks(batch, "text"):
                ids, at = encoder.encode(piece.column(1))
                for i, (k, one, two) in enumerate(zip(*(piece.column(c).to_pylist() for c in (0, 2, 3)))):
                    raw = ids[at[i]: at[i + 1]].tobytes()
                    if held and size + len(raw) > SHARD_BYTES:
                        yield shard()
                        size = 0
                    held.append((k, one, two, raw))
                    size += len(raw) + len(last)
        if held:
            yield shard()

    return stored(dealt.mapInArrow(run, f"part int, seq bigint, before bigint, first {kind}, lengths array<bigint>, ones array<bigint>, "
                                        f"twos array<bigint>, width int, payload binary, keys array<{kind}>"), "shards")


def part_starts(shards: DataFrame) -> DataFrame:
    """part and the number of ids in all parts before it. There are as many rows as tasks wrote, so the driver may add them up."""
    parts = shards.groupBy("part").agg(F.min("first").alias("first"), F.min("seq").alias("s"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    rows, start = [], 0
    for r in sorted(parts.collect(), key=lambda r: (r["first"] is not None, r["first"], r["part"]) if r["first"] is not None else (False, 0, r["part"])):
        rows.append((r["part"], start))
        start += r["n"]
    return shards.sparkSession.createDataFrame(rows, "part int, start long")


def read_shards(shards: DataFrame) -> DataFrame:
    """key, part, seq, place, n_tokens, ids_crc32 of every document in the payloads; the checksum is of 32-bit little-endian ids."""
    kind = shards.schema["keys"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, seq, width = (batch.column(c)[i].as_py() for c in (0, 1, 3))
                lengths = batch.column(2)[i].values.to_numpy()
                ids = np.frombuffer(batch.column(4)[i].as_buffer(), f"<u{width}")
                ends = np.cumsum(lengths)
                sums = [zlib.crc32(ids[b - n: b].astype("<u4").tobytes()) for b, n in zip(ends, lengths)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(5)[i].values, pa.array(np.full(len(ends), part, np.int32)), pa.array(np.full(len(ends), seq, np.int64)),
                     pa.array(ends - lengths), pa.array(lengths), pa.array(sums, pa.int64())],
                    names=["key", "part", "seq", "place", "n_tokens", "ids_crc32"])

    return shards.select("part", "seq", "lengths", "width", "payload", "keys").mapInArrow(
        run, f"key {kind}, part int, seq bigint, place bigint, n_tokens bigint, ids_crc32 bigint")


# --- index

_INDEX = "bucket bigint, bits binary, sizes binary, fingerprints binary, parts binary, seqs binary, places binary, counts binary"
_ROWS = {"fingerprints": "<u4", "parts": "<i4", "seqs": "<i8", "places": "<i8", "counts": "<i8"}


def build_index(shards: DataFrame) -> tuple[DataFrame, int]:
    """The stored index, a row per bucket, and the number of buckets."""
    n_docs = shards.agg(F.sum(F.size("lengths"))).first()[0] or 0
    buckets = max(1, -(-n_docs // BUCKET_KEYS))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, seq = (batch.column(c)[i].as_py() for c in (0, 1))
                one, two, n = (batch.column(c)[i].values.to_numpy() for c in (2, 3, 4))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int32)), pa.array(np.full(len(n), seq, np.int64)), pa.array(one), pa.array(two),
                     pa.array(np.cumsum(n) - n), pa.array(n)], names=["part", "seq", "one", "two", "place", "n"])

    def build(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        table = table.sort_by([(c, "ascending") for c in ("one", "two", "part", "seq", "place")])
        one, two = (table[c].to_numpy().view(np.uint64) for c in ("one", "two"))
        bits, sizes = build_hash(one, two)
        order = np.argsort(number_of(one, two, bits, sizes))
        columns = dict(zip(_ROWS, (_fingerprint(one, two), *(table[c].to_numpy() for c in ("part", "seq", "place", "n")))))
        row = {"bucket": [bucket], "bits": [np.packbits(bits).tobytes()], "sizes": [sizes.astype("<i8").tobytes()],
               **{k: [np.ascontiguousarray(v[order]).astype(_ROWS[k]).tobytes()] for k, v in columns.items()}}
        return pa.table({k: pa.array(v, pa.int64() if k == "bucket" else pa.binary()) for k, v in row.items()})

    null = F.xxhash64(F.lit(None).cast("long")), F.xxhash64(F.lit(None).cast("long"), F.lit(1))
    rows = shards.select("part", "seq", "ones", "twos", "lengths").mapInArrow(places, "part int, seq bigint, one bigint, two bigint, place bigint, n bigint")
    rows = rows.filter(~((F.col("one") == null[0]) & (F.col("two") == null[1])))
    # A repeated key is one row before it meets its bucket, however often it comes.
    rows = rows.groupBy("one", "two").agg(F.min(F.struct("part", "seq", "place", "n")).alias("at")).select(
        "one", "two", "at.*", F.pmod("one", F.lit(buckets)).alias("bucket"))
    return stored(rows.groupBy("bucket").applyInArrow(build, _INDEX), "key-index"), buckets


def look_up(keys: DataFrame, index: DataFrame, buckets: int, key: str = "doc_id") -> DataFrame:
    """key, part, seq, place, n_tokens of each distinct key that the index knows.

    Keys and index rows meet by bucket and stream through a task in that order, the index row first.
    """
    kind = keys.select(key).schema[0].dataType.simpleString()
    names = [c.split()[0] for c in _INDEX.split(", ")]
    asked = keys.select(F.col(key).alias("key")).filter("key is not null").distinct()
    asked = asked.select("key", F.xxhash64("key").alias("one"), F.xxhash64("key", F.lit(1)).alias("two"))
    asked = asked.withColumn("bucket", F.pmod("one", F.lit(buckets))).withColumn("asks", F.lit(1))
    both = index.withColumn("asks", F.lit(0)).unionByName(asked, allowMissingColumns=True)
    both = both.repartition("bucket").sortWithinPartitions("bucket", "asks").select(*names, "asks", "key", "one", "two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, known = None, None
        for batch in batches:
            bucket, asks = batch.column(0).to_numpy(), batch.column(len(names)).to_numpy()
            edges = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (asks[1:] != asks[:-1])))
            for a, b in zip(edges, np.append(edges[1:], len(bucket))):
                if not asks[a]:
                    raw = {c: batch.column(names.index(c))[int(a)].as_py() for c in names[1:]}
                    here, known = bucket[a], {c: np.frombuffer(raw[c], t) for c, t in _ROWS.items()}
                    known["sizes"] = np.frombuffer(raw["sizes"], "<i8")
                    known["bits"] = np.unpackbits(np.frombuffer(raw["bits"], np.uint8), count=int(known["sizes"].sum())).astype(bool)
                elif here == bucket[a]:
                    part = batch.slice(a, b - a)
                    one, two = (part.column(len(names) + k).to_numpy().view(np.uint64) for k in (2, 3))
                    number = number_of(one, two, known["bits"], known["sizes"])
                    found = np.flatnonzero((number >= 0) & (known["fingerprints"][number] == _fingerprint(one, two)))
                    at = number[found]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(len(names) + 1).take(pa.array(found)), *(pa.array(known[c][at]) for c in ("parts", "seqs", "places", "counts"))],
                        names=["key", "part", "seq", "place", "n_tokens"])

    found = both.mapInArrow(run, f"key {kind}, part int, seq bigint, place bigint, n_tokens bigint")
    return found.withColumnRenamed("key", key)


def write_and_read(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """Per document, from the files: its key, start (ids of all documents before it), n_tokens, ids_crc32, and indexed: whether the index
    finds this very place by the key. Null keys and all but the first row of a repeated key are not in the index."""
    shards = write_shards(docs, tokenizer_path, key, text, end)
    index, buckets = build_index(shards)
    places = look_up(docs.select(key), index, buckets, key).select(F.col(key).alias("found"), "part", "seq", "place")
    before = shards.select("part", "seq", "before").join(part_starts(shards), "part").select("part", "seq", (F.col("start") + F.col("before")).alias("base"))
    rows = read_shards(shards).join(places, ["part", "seq", "place"], "left").join(before, ["part", "seq"])
    return rows.select(F.coalesce("found", "key").alias(key), (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32",
                       F.coalesce(F.col("found") == F.col("key"), F.lit(False)).alias("indexed"))
