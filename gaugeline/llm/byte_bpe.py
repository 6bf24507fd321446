"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The library works on characters, so each byte stands for one printable character (`byte_characters`). A rank file
becomes a tokenizer whose merges are all splits of a token into two known tokens, ordered by the token's rank: that
is what "merge the pair of lowest rank" means. Decoding turns ids to their bytes; a character may lie in several
tokens, so bytes become text only where a character is complete.

`Encoder` cuts a text before every white space that follows other text, and between an ASCII letter and a full stop
or comma. No match of a byte-level pattern crosses such a place and none looks back over it, so the pieces can be encoded
each by itself, and a piece that was seen before costs a look-up. Pieces of up to eight bytes are known by these bytes themselves;
longer ones by a hash, and the bytes are compared on each hit (a piece that meets another one's hash is encoded
straight by the library). The memory of pieces is bounded; when it is full it starts anew.

Cases: null and empty texts have no ids; very long texts are encoded whole; repeated rows give repeated rows; an empty
table gives an empty one; other columns of the input are not read. Ids depend on the text alone.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

from gaugeline.llm.words import bytes_of, chunks, gather, mix, range_hashes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark gives each core a task already

#: Pieces that a worker remembers before it starts anew, and the bytes that all it keeps of them may take.
REMEMBERED = 500_000
REMEMBERED_BYTES = 64 << 20
SHORT = 8
#: Characters that Unicode calls white space, as bytes of UTF-8.
_WHITE = [chr(c).encode() for c in (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def byte_characters() -> dict[int, str]:
    """Byte to the character that stands for it: itself where printable, else the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def tokenizer_from_ranks(ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    shown = byte_characters()
    name = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.__getitem__):
        splits = [(token[:k], token[k:]) for k in range(1, len(token))]
        known = sorted((ranks[a], ranks[b], a, b) for a, b in splits if a in ranks and b in ranks)
        merges += [(name[a], name[b]) for _, _, a, b in known]
    made = Tokenizer(BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=merges))
    made.pre_tokenizer = Sequence([Split(Regex(pattern), "isolated"), ByteLevel(add_prefix_space=False, use_regex=False)])
    return made


def white_space(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to a white-space character."""
    out = np.zeros(len(data), bool)
    one = np.zeros(256, bool)
    one[[w[0] for w in _WHITE if len(w) == 1]] = True
    out |= one[data]
    for size in (2, 3):
        for w in (w for w in _WHITE if len(w) == size):
            at = np.flatnonzero(data[: len(data) - size + 1] == w[0])
            for k in range(1, size):
                at = at[data[at + k] == w[k]]
            for k in range(size):
                out[at + k] = True
    return out


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces start: at texts, at white space after other text, at a full stop or comma after an ASCII letter."""
    white = white_space(data)
    starts = np.zeros(len(data), bool)
    starts[1:] = white[1:] & ~white[:-1]
    stop = np.flatnonzero((data == 46) | (data == 44))
    stop = stop[stop > 0]
    starts[stop[((data[stop - 1] | 32) >= 97) & ((data[stop - 1] | 32) <= 122)]] = True
    starts[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(starts)


class Pieces:
    """Key and length of a piece to its run in `store` and, if it is long, its bytes: an open-addressing table in arrays."""

    def __init__(self, kind: str):
        self.store, self.used, self.size = np.zeros(1 << 12, kind), 0, 0
        self.texts, self.texts_used = np.zeros(1 << 12, np.uint8), 0
        self._resize(1 << 12)

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.key, self.at, self.text_at, self.count, self.length, self.store, self.texts))

    def _resize(self, n: int) -> None:
        self.key, self.at, self.text_at = np.zeros(n, np.uint64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.count, self.length = np.zeros(n, np.int32), np.zeros(n, np.int32)  # length 0: a free slot

    def find(self, key: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The slots of the pieces, -1 where unknown."""
        mask = np.uint64(len(self.key) - 1)
        slot = (key & mask).astype(np.int64)
        open_, found = np.arange(len(key)), np.full(len(key), -1)
        while len(open_):
            at = slot[open_]
            hit = (self.key[at] == key[open_]) & (self.length[at] == length[open_])
            found[open_[hit]] = at[hit]
            open_ = open_[~hit & (self.length[at] != 0)]
            slot[open_] = (slot[open_] + 1) & int(mask)
        return found

    def add(self, key: np.ndarray, length: np.ndarray, at: np.ndarray, count: np.ndarray, text_at: np.ndarray) -> None:
        """Distinct unknown pieces."""
        self.size += len(key)
        if self.size * 2 > len(self.key):
            old = np.flatnonzero(self.length)
            kept = self.key[old], self.length[old], self.at[old], self.count[old], self.text_at[old]
            self._resize(1 << int(self.size * 2).bit_length())
            self._put(*kept)
        self._put(key, length, at, count, text_at)

    def _put(self, key, length, at, count, text_at) -> None:
        mask = len(self.key) - 1
        slot = (key & np.uint64(mask)).astype(np.int64)
        open_ = np.arange(len(key))
        while len(open_):
            free = open_[self.length[slot[open_]] == 0]
            _, first = np.unique(slot[free], return_index=True)  # one piece for each free slot
            owner = free[first]
            self.key[slot[owner]], self.length[slot[owner]] = key[owner], length[owner]
            self.at[slot[owner]], self.count[slot[owner]], self.text_at[slot[owner]] = at[owner], count[owner], text_at[owner]
            done = np.zeros(len(key), bool)
            done[owner] = True
            open_ = open_[~done[open_]]
            slot[open_] = (slot[open_] + 1) & mask

    def keep_texts(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Append the bytes of long pieces; where each begins (0 for short ones)."""
        kept = np.where(length > SHORT, length, 0)
        raw, at = gather(data, start, kept), self.texts_used + np.cumsum(kept) - kept
        end = self.texts_used + len(raw)
        if end > len(self.texts):
            self.texts = np.concatenate([self.texts[: self.texts_used], np.zeros(max(len(self.texts), 2 * len(raw)), np.uint8)])
        self.texts[self.texts_used: end] = raw
        self.texts_used = end
        return at

    def others(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """The numbers of the pieces whose slot holds another text."""
        long = np.flatnonzero(length > SHORT)
        if not len(long):
            return long
        differ = gather(data, start[long], length[long]) != gather(self.texts, self.text_at[slot[long]], length[long])
        if not differ.any():
            return long[:0]
        return long[np.add.reduceat(differ, np.cumsum(length[long]) - length[long]) > 0]

    def keep(self, ids: np.ndarray) -> int:
        """Append ids to the store; where they begin."""
        at, self.used = self.used, self.used + len(ids)
        if self.used > len(self.store):
            self.store = np.concatenate([self.store[:at], np.zeros(max(len(self.store), 2 * len(ids)), self.store.dtype)])
        self.store[at: self.used] = ids
        return at


class Encoder:
    """Ids of whole texts; equal to encoding each text at once."""

    def __init__(self, tokenizer: Tokenizer, kind: str = "<u4"):
        tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.tokenizer, self.kind, self.pieces = tokenizer, kind, Pieces(kind)
        vocabulary = tokenizer.get_vocab()
        self.size = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)  # bytes of each id: a character of a token stands for one
        self.size[list(vocabulary.values())] = list(map(len, vocabulary))

    def _learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, key: np.ndarray) -> None:
        white, pieces = white_space(data), self.pieces
        joined = white[start] & ~white[end - 1]  # such pieces, put one after the other, stay pieces
        together = np.flatnonzero(joined)
        for at in range(0, len(together), 50_000):
            which = together[at: at + 50_000]
            length = (end - start)[which]
            ids = np.array(self.tokenizer.encode_batch_fast([gather(data, start[which], length).tobytes().decode()], add_special_tokens=False)[0].ids, np.int64)
            ends, edges = np.cumsum(self.size[ids]), np.cumsum(length)
            last = np.searchsorted(ends, edges)  # the id that a piece ends with
            if len(ids) == 0 or ends[-1] != edges[-1] or (ends[last] != edges).any():
                joined[which] = False  # a vocabulary that is not of bytes alone
                continue
            count = np.diff(last, prepend=-1)
            pieces.add(key[which], length, pieces.keep(ids) + last + 1 - count, count, pieces.keep_texts(data, start[which], length))
        which = np.flatnonzero(~joined)
        if len(which):
            at, count = self._straight(data, start[which], end[which])
            length = (end - start)[which]
            pieces.add(key[which], length, at, count, pieces.keep_texts(data, start[which], length))

    def _straight(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces by the library, one by one: where their ids are in the store, and how many."""
        found = self.tokenizer.encode_batch([bytes(data[a:b]).decode() for a, b in zip(start, end)], add_special_tokens=False)
        count = np.array([len(e.ids) for e in found])
        return self.pieces.keep(np.array([i for e in found for i in e.ids])) + np.cumsum(count) - count, count

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's ids begin in them (one more entry than texts)."""
        if self.pieces.size > REMEMBERED or self.pieces.nbytes > REMEMBERED_BYTES:
            self.pieces = Pieces(self.kind)
        pieces = self.pieces
        data, offsets = bytes_of(texts)
        start = piece_starts(data, offsets)
        end = np.append(start[1:], len(data)) if len(start) else start
        length = end - start
        key = piece_keys(data, start, length)
        slot = pieces.find(key, length)
        unknown = np.flatnonzero(slot < 0)
        if len(unknown):
            new = unknown[_distinct(key[unknown], length[unknown])]
            self._learn(data, start[new], end[new], key[new])
            slot = pieces.find(key, length)
        at, count = pieces.at[slot], pieces.count[slot].astype(np.int64)
        other = pieces.others(data, start, length, slot)
        if len(other):
            at[other], count[other] = self._straight(data, start[other], end[other])
        ids = gather(pieces.store, at, count)
        return ids, np.append(0, np.cumsum(count))[np.searchsorted(start, offsets)]


def piece_keys(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """One number per piece: for up to SHORT bytes these bytes, mixed without loss; for longer ones a hash."""
    key = range_hashes(data, start, start + length)
    short = np.flatnonzero(length <= SHORT)
    ahead = np.concatenate([data, np.zeros(SHORT, np.uint8)])
    raw = np.lib.stride_tricks.sliding_window_view(ahead, SHORT)[start[short]].view("<u8").ravel()
    with np.errstate(over="ignore"):
        key[short] = mix(raw & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (8 * (SHORT - length[short])).astype(np.uint64)))
    return key


def _distinct(key: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places of the first of each distinct (key, length)."""
    order = np.lexsort((length, key))
    new = np.ones(len(key), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (length[order][1:] != length[order][:-1])
    return order[new]


@lru_cache(maxsize=2)
def rank_encoder(path: str, pattern: str) -> Encoder:
    return Encoder(tokenizer_from_ranks(read_ranks(path), pattern))


@lru_cache(maxsize=2)
def file_encoder(path: str) -> Encoder:
    """Two bytes an id where the vocabulary allows it, else four."""
    tokenizer = Tokenizer.from_file(path)
    return Encoder(tokenizer, "<u2" if tokenizer.get_vocab_size() <= 1 << 16 else "<u4")


@lru_cache(maxsize=2)
def byte_table(path: str) -> list[bytes]:
    """Bytes of each id."""
    ranks = read_ranks(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def token_texts(ids: list[int], table: list[bytes]) -> list[str]:
    """Text that becomes complete with each id: a character split over ids counts to the last of them."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    out = [decoder.decode(table[i]) for i in ids]
    if out:
        out[-1] += decoder.decode(b"", final=True)
    return out


def binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column over one run of values; offsets count values."""
    raw = np.ascontiguousarray(values)
    edges = (offsets * raw.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(raw)])


def _map(df: DataFrame, key: str, text: str, columns: str, rows: Callable[[pa.Array], dict]) -> DataFrame:
    """One output row per input row: the key, and the columns that `rows` gives for an array of texts."""
    kind = df.select(key).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                made = rows(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), *made.values()], names=["key", *made])

    slim = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return slim.mapInArrow(run, f"key {kind}, {columns}").withColumnRenamed("key", key)


def encode(df: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids (array of int) and spans: the character range [start, end) of each id.

    Ids that share a character have ranges that both hold it. The ranges need the library's own walk over the whole
    text, which is several times slower than `encode_ids`.
    """

    def rows(texts: pa.Array) -> dict:
        found = rank_encoder(ranks_path, pattern).tokenizer.encode_batch(texts.fill_null("").to_pylist(), add_special_tokens=False)
        spans = [[{"start": a, "end": b} for a, b in e.offsets] for e in found]
        return {"n_tokens": pa.array([len(e.ids) for e in found], pa.int64()),
                "ids": pa.array([e.ids for e in found], pa.list_(pa.int32())),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))}

    return _map(df, key, text, "n_tokens bigint, ids array<int>, spans array<struct<start:int,end:int>>", rows)


def encode_ids(df: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens and ids as little-endian unsigned 32-bit numbers."""

    def rows(texts: pa.Array) -> dict:
        ids, at = rank_encoder(ranks_path, pattern).encode(texts)
        return {"n_tokens": pa.array(np.diff(at)), "ids": binary(ids, at)}

    return _map(df, key, text, "n_tokens bigint, ids binary", rows)


def decode(df: DataFrame, ranks_path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key and text of ids as `encode_ids` gives them; null ids count as none, bytes that form no character become U+FFFD."""
    kind = df.select(key).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = byte_table(ranks_path)
        for batch in batches:
            texts = ["".join(token_texts(np.frombuffer(x or b"", "<u4").tolist(), table)) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["key", "text"])

    slim = df.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    return slim.mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)


def _flat(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    count = np.array(list(map(len, strings)))
    return np.frombuffer(b"".join(strings), np.uint8), np.cumsum(count) - count, count


@lru_cache(maxsize=2)
def _decoding(path: str) -> tuple:
    """For each id its bytes, and its decimal with a space after it, as runs of one array."""
    table = byte_table(path)
    return _flat(table), _flat([b"%d " % i for i in range(len(table))])


def _sha256(strings: tuple, ids: np.ndarray, at: np.ndarray, cut: int) -> pa.Array:
    """Of each text's strings put together, without the last `cut` bytes."""
    flat, start, count = strings
    edges = np.append(0, np.cumsum(count[ids]))[at]
    data = gather(flat, start[ids], count[ids])
    return pa.array([hashlib.sha256(data[a: max(a, b - cut)]).hexdigest() for a, b in zip(edges[:-1], edges[1:])], pa.string())


def digests(df: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, sha256 of the decimal ids joined by a space, and of the bytes that the ids decode to."""

    def rows(texts: pa.Array) -> dict:
        ids, at = rank_encoder(ranks_path, pattern).encode(texts)
        decoded, decimal = _decoding(ranks_path)
        return {"n_tokens": pa.array(np.diff(at)), "ids_sha256": _sha256(decimal, ids, at, 1),
                "decoded_sha256": _sha256(decoded, ids, at, 0)}

    return _map(df, key, text, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", rows)
