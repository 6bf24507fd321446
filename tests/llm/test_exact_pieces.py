"""Texts whose pieces share a polynomial hash, and rows that share a key."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gaugeline.llm import byte_bpe, lsh_forest, token_index
from gaugeline.llm.queries import RANKS, TOKENIZER
from gaugeline.llm.words import range_hashes, words_of
from tests.llm import brute


def thue_morse(n):
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


TEXTS = [*thue_morse(2048), *thue_morse(1024), "x " + thue_morse(2048)[1], thue_morse(2048)[0] + " y", "12345678", "123456789", " 1234567", "é" * 4, "é" * 5, ""]


def ids_of(text):
    library = Tokenizer.from_file(TOKENIZER)
    library.encode_special_tokens = True
    return library.encode(text, add_special_tokens=False).ids


def test_the_pair_shares_its_hash():
    one, other = (np.frombuffer(t.encode(), np.uint8) for t in thue_morse(2048))
    ends = np.array([0]), np.array([2048])
    assert range_hashes(one, *ends) == range_hashes(other, *ends)


def test_encoder_tells_colliding_pieces_apart_in_any_order():
    for order in (TEXTS, TEXTS[::-1], [TEXTS[0]], [TEXTS[1], TEXTS[0], TEXTS[1]]):
        encoder = byte_bpe.Encoder(Tokenizer.from_file(TOKENIZER))
        for _ in range(2):  # once unknown, once remembered
            ids, at = encoder.encode(pa.array(order))
            assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [ids_of(t) for t in order]


def test_memory_of_pieces_starts_anew(monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 50)
    encoder = byte_bpe.Encoder(Tokenizer.from_file(TOKENIZER))
    for k in range(5):
        text = " ".join(f"word{k}x{i} longerword{i}" for i in range(60))
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == ids_of(text) and encoder.pieces.size <= 50 + 240


def test_digests_of_colliding_texts(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in byte_bpe.digests(df, RANKS, public_tokenizers.PATTERN).collect():
        assert r.decoded_sha256 == hashlib.sha256(TEXTS[r.doc_id].encode()).hexdigest()


def test_index_returns_every_row(spark):
    rows = [(1, "one"), (1, "one more"), (None, "no key"), (2, TEXTS[0]), (3, TEXTS[1]), (None, None), (1, "one"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash"))
    found = token_index.write_and_read(df, TOKENIZER).collect()

    def told(key, text):
        ids = [*ids_of(text or ""), token_index.END]
        return key, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())

    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in found) == sorted((str(k), *told(k, t)[1:]) for k, t in rows)
    assert sorted(r.start for r in found) == sorted(np.cumsum([0, *(r.n_tokens for r in sorted(found, key=lambda r: r.start))])[:-1].tolist())
    assert sorted(r.doc_id for r in found if r.indexed) == [1, 2, 3, 4]


def test_words_that_share_a_polynomial_are_told_apart():
    for n in (64, 128, 1024, 2048, 4096):
        one, other = thue_morse(n)
        hashes = words_of(pa.array([one, other, one, "x" + one, one.upper()])).hash
        assert len(set(hashes.tolist())) == 4 and hashes[0] == hashes[2], n
        lower = words_of(pa.array([one, other, one.upper()]), lower=True).hash
        assert lower[0] == lower[2] != lower[1], n


def test_near_duplicates_of_colliding_words(spark):
    one, other = thue_morse(2048)
    rows = {1: one, 2: other, 3: one.upper(), 4: f"{one} {other} a b c d", 5: f"{other} {one} a b c d", 6: f"{one} {other} a b c d"}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in lsh_forest.near_duplicates(df).collect()}
    assert got == brute.near_groups(rows) and got[2][1] == 2 and got[3][1] == 1
