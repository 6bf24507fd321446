import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from gaugeline.llm import (
    byte_bpe, disclosure, factor_quality, lang_crf, line_blocks, line_spread, lsh_forest, quality_rules, template_leaks, token_index)
from gaugeline.llm.queries import RANKS, TOKENIZER
from tests.llm import brute

SF = "/root/testdata/sf0.001"
rnd = random.Random(3)
VOCABULARY = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def edited(text, places):
    w = text.split()
    for p in places:
        w[p] = f"new{p}"
    return " ".join(w)


LONG = prose(30_000, 1)
CASES = [None, "", " ", "\n\n", "one", "Two words", "a b c d e", "a b c d e", "é ü ñ 日本 😀😀", "x" * 50_000, LONG, prose(40, 2), prose(40, 2)]


@pytest.fixture(scope="module")
def cases(spark):
    """Awkward texts with repeated rows, a null id, and columns with clashing names."""
    rows = [(i, t, "en", f"s{i % 3}", "x", 1) for i, t in enumerate(CASES)] + [(11, CASES[11], "en", None, "x", 1), (None, prose(30, 9), None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string, n_tokens int")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def tik():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_reference_tokenizer(spark, cases):
    own, pieces = tik(), ["don't", " 's", "12 ab\tc", "\x1c", "　", "a b", "  ", "\n", ".", ",", "é.", "<|endoftext|>", "日本", "😀", "Wörter", " x"]
    r = random.Random(1)
    texts = CASES + ["".join(r.choice(pieces) for _ in range(r.randint(1, 30))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = by_id(byte_bpe.digests(df, RANKS, public_tokenizers.PATTERN))
    for i, t in enumerate(texts):
        ids = own.encode_ordinary(t or "")
        assert found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert byte_bpe.digests(cases, RANKS, public_tokenizers.PATTERN).count() == cases.count()


def test_bpe_round_trip_offsets_and_split_characters(spark):
    texts = ["Hello wörld 😀!", "", None, "日本語"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ids = byte_bpe.encode_ids(df, RANKS, public_tokenizers.PATTERN)
    assert {r.doc_id: r.text for r in byte_bpe.decode(ids, RANKS).collect()} == {i: t or "" for i, t in enumerate(texts)}
    for r in byte_bpe.encode(df, RANKS, public_tokenizers.PATTERN).collect():
        text = texts[r.doc_id] or ""
        assert len(r.ids) == len(r.spans) == r.n_tokens and all(0 <= s.start <= s.end <= len(text) for s in r.spans)
        assert "".join(byte_bpe.token_texts(r.ids, byte_bpe.byte_table(RANKS))) == text


def test_piece_memory_starts_anew_when_full(monkeypatch):
    import pyarrow as pa
    own, encoder = tik(), byte_bpe.Encoder(Tokenizer.from_file(TOKENIZER))
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 10)
    for k in range(5):
        texts = [prose(50, k), prose(5, k)]
        ids, at = encoder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [own.encode_ordinary(t) for t in texts]


def test_near_duplicates_equal_brute_force(spark, cases):
    base, other = prose(150, 5), prose(60, 6)
    r = random.Random(4)
    texts = [base, base.upper(), other, edited(other, [3])] + [edited(base, r.sample(range(150), r.randint(1, 5))) for _ in range(120)]
    texts += [t for t in CASES if t != LONG] + [prose(r.randint(3, 40), 100 + k) for k in range(40)]
    docs = dict(enumerate(texts))
    found = by_id(lsh_forest.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string")))
    for i, (n, component) in brute.near_groups(docs).items():
        assert (found[i].n_shingles, found[i].component_id, found[i].kept) == (n, component, i == component)
    rows = lsh_forest.near_duplicates(cases).collect()
    assert len(rows) == cases.count() and [r.kept for r in rows if r.doc_id is None] == [True]
    assert lsh_forest.near_duplicates(cases.filter("doc_id < 0")).count() == 0


def test_links_within_a_crowd_of_form_texts(spark, monkeypatch):
    """Texts that are four fifths one form: all share regions, the form's text is no one's link, pairs of copies are."""
    form, r = prose(200, 50).split(), random.Random(8)
    texts = []
    for k in range(60):
        own = [f"own{k}x{j}" for j in range(30)]
        texts += [" ".join(form + own), " ".join(form + own[:-2] + ["other", f"end{k}"])]
    r.shuffle(texts)
    docs = dict(enumerate(texts))
    want = brute.near_groups(docs)
    assert 40 < len({c for _, c in want.values()}) < 100
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    for block in (256, 16):
        monkeypatch.setattr(lsh_forest, "BLOCK", block)
        found = by_id(lsh_forest.near_duplicates(df))
        assert all((found[i].component_id, found[i].kept) == (c, i == c) for i, (_, c) in want.items())


def test_near_dedup_stage_takes_pairs_from_four_fifths(spark):
    base = [prose(100, 200 + k) for k in range(30)]
    texts = base + [edited(t, range(2, 2 + 5 * (k % 4), 5)) if k % 4 else edited(t, [40, 45, 50]) for k, t in enumerate(base)]
    texts += [" ".join(t.split()[:88]) + f" tail{k} " + prose(6, 900 + k) for k, t in enumerate(base)]
    docs = dict(enumerate(texts))
    want = {i for i, (_, c) in brute.near_groups(docs, 80).items() if i == c}
    assert want < {i for i, (_, c) in brute.near_groups(docs).items() if i == c}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.one_of_each(spark, df, SF).collect()} == want


def test_quality_figures_and_verdict(spark, cases):
    junk = " ".join(w + "***" for w in prose(200, 8).split())
    texts = CASES + [prose(30, 3) + " " + " ".join([prose(10, 4)] * 9), "\n".join(["same line here"] * 9), junk] + [prose(80, k) + ". " + prose(20, k + 1000) + "." for k in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = by_id(quality_rules.judge(df, keep=["doc_id"]))
    for i, t in enumerate(texts):
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(t)
        assert not (r.base_failed and r.kept)
    assert all(found[i].kept for i in range(len(CASES) + 3, len(texts)))
    kept = quality_rules.keep_good(cases)
    assert kept.columns == cases.columns and quality_rules.keep_good(cases.filter("doc_id < 0")).count() == 0


def test_em_learns_which_rules_to_trust(spark):
    good = dict.fromkeys(quality_rules.RULES, 1)
    rows = [good] * 900 + [{**good, "symbols": 0, "plain_words": 0}] * 100
    df = spark.createDataFrame([tuple(r[c] for c in quality_rules.RULES) for r in rows], ", ".join(f"{c} int" for c in quality_rules.RULES))
    model = quality_rules.fit(df)
    p = df.select(model.posterior({c: F.col(c) for c in quality_rules.RULES}).alias("p"), "symbols")
    assert {r.symbols: r.p > 0.5 for r in p.collect()} == {1: True, 0: False}


def test_line_spread(spark, cases):
    rows = [(i, f"own text of {i}\nshared line on many sites\ntwo words\nnear {i % 2} the threshold line", f"s{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = by_id(line_spread.remove_boilerplate(df, min_sites=10))
    assert all(got[i].text == f"own text of {i}\ntwo words" and got[i]._n_removed == 2 for i in range(20))
    got = by_id(line_spread.remove_boilerplate(df, min_sites=11))
    assert all(got[i]._n_removed == 1 for i in range(20))
    out = line_spread.remove_boilerplate(cases)
    assert out.columns[:-2] == cases.columns and out.count() == cases.count()
    assert {r.doc_id: r.text for r in out.collect()}[0] is None
    assert line_spread.remove_boilerplate(cases.filter("doc_id < 0")).count() == 0


def test_template_leaks(spark, cases):
    items = spark.createDataFrame([(1, "Tom has 5 apples and gives 2 kg of them to Mary before lunch. How many apples does Tom have left now?"),
                                   (2, "the cat sat"), (3, "one plain five word item"), (4, None)], "item_id int, text string")
    rows = [(1, "Well, Sam has 7 apples and gives 3 g of them to Lucy before lunch. How many apples does Sam have left now? Ok"),
            (2, None), (3, ""), (4, "one plain five word item"), (5, "one plain five words item"), (8, "A TEXT IN CAPITALS. ONE PLAIN FIVE WORD ITEM IN IT"),
            (6, "tom has 5 apples and gives 2 kg of them to Mary before lunch. How many apples does Tom have left now?"),
            (7, "x has 7 apples and gives 3 g of them to Lucy before lunch. now Ann has 8 apples and gives 9 g of them to Eve before lunch")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = {(r.doc_id, r.item_id): r.kind for r in template_leaks.leaks(docs, items).collect()}
    assert got == {(1, 1): "template", (6, 1): "exact", (4, 3): "exact", (8, 3): "exact"}
    assert sorted(r.doc_id for r in template_leaks.remove_leaks(docs, items).collect()) == [2, 3, 5, 7]
    assert template_leaks.leaks(cases, items.filter("item_id < 0")).count() == 0
    assert template_leaks.remove_leaks(cases, items).count() == cases.count()


def test_leaks_of_an_item_that_a_document_holds_more_than_once(spark):
    text = "Once Tom has 5 apples and gives 2 kg of them to Mary before lunch. How many apples does Tom have left now?"
    other = text.replace("Tom", "Sam").replace("5", "7").replace("2", "3").replace("Mary", "Lucy")
    third = text.replace("Tom", "Eve").replace("5", "8").replace("2", "9").replace("Mary", "Ann")
    longer = text.replace("many apples", "many red apples")
    items = spark.createDataFrame([(1, text)], "item_id int, text string")
    rows = [(1, f"{text} {other}"), (2, f"{other} and also {third}"), (3, " ".join([text, other, third] * 20)), (4, f"{other} {longer}"),
            (5, text), (6, other), (7, longer), (8, text), (8, other)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r.doc_id: r.kind for r in template_leaks.leaks(docs, items).collect()}
    assert got == {1: "exact", 2: "template", 3: "exact", 4: "template", 5: "exact", 6: "template", 7: "exact", 8: "exact"}


def test_large_benchmarks_are_joined_by_shuffle(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    want = sorted(map(tuple, template_leaks.leaks(docs, items).collect()))
    monkeypatch.setattr(template_leaks, "SENT_KEYS", 1)
    assert want and sorted(map(tuple, template_leaks.leaks(docs, items).collect())) == want


PAGE = """<html><head><title>x</title></head><body><header>Site <a href=x>Home</a></header><nav><a href=y>Menu</a></nav>
<div class="cookie-notice">We use cookies. Accept all of these terms now please, they are long.</div>{0}
<div class="sidebar"><p>Related stories that are long enough to be text, but in the sidebar, really.</p></div>
<section id="comments"><p>First! I love this article and want to tell you about my day at the beach.</p></section>
<form><label>Name</label></form><script>var t = "</p>";</script><footer>&copy; 2020 some long words about rights that are reserved</footer>"""
BODY = """<h1>Title here</h1><p>This is a fairly long paragraph of text that goes on &amp; on for a while so as to be seen.</p><p>Another   one
that is long enough, with <a href="x">a link</a> inside.<br>More.</p><p>Short.</p>"""
BLOCKS = ["Title here", "This is a fairly long paragraph of text that goes on & on for a while so as to be seen.",
          "Another one that is long enough, with a link inside. More.", "Short."]


def test_main_text(spark):
    assert line_blocks.main_blocks(PAGE.format(f"<article>{BODY}</article>")) == BLOCKS
    assert line_blocks.main_blocks(PAGE.format(f"<div id=content>{BODY}</div>")) == BLOCKS
    assert line_blocks.main_blocks("a < b and <b") == ["a < b and <b"]
    pages = [(0, "u", None), (1, None, ""), (2, "u", "<p>"), (3, "u", "<" * 20_000), (4, "u", PAGE.format(BODY)), (4, "u", PAGE.format(BODY))]
    rows = line_blocks.main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert [(r.page_id, r.n_chars) for r in rows if r.page_id < 3] == [(0, 0), (1, 0), (2, 0)] and len(rows) == 6
    assert all(r.text == "\n\n".join(BLOCKS) and r.n_chars == len(r.text) for r in rows if r.page_id == 4)


def test_forward_backward_equals_the_sum_over_paths():
    from itertools import product
    r = np.random.default_rng(0)
    emission, transition, start = r.normal(size=(7, 3)), r.normal(size=(3, 3)), r.normal(size=3)
    first = np.array([True, False, False, True, True, False, False])
    p, pairs = lang_crf.forward_backward(emission, first, transition, start)
    want, total = np.zeros((7, 3)), 0.0
    moves = np.zeros((3, 3))
    for path in product(range(3), repeat=7):
        s = sum(emission[t, path[t]] + (start[path[t]] if first[t] else transition[path[t - 1], path[t]]) for t in range(7))
        total += np.exp(s)
        for t in range(7):
            want[t, path[t]] += np.exp(s)
            if not first[t]:
                moves[path[t - 1], path[t]] += np.exp(s)
    assert np.allclose(p, want / total) and np.allclose(pairs, moves / total)


def test_language_field(spark, cases):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    field = lang_crf.fit_on(docs.filter("doc_id % 3 > 0"))
    found = lang_crf.predict(docs.filter("doc_id % 3 = 0").select("doc_id", "text"), field).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.95 * len(found) and all(0 <= r.score <= 1 for r in found)
    got = by_id(lang_crf.predict(cases, field))
    assert got[0].lang_pred == got[1].lang_pred == got[3].lang_pred == "und" and got[0].score == 0
    german, english = (docs.filter(f"lang = '{x}' and length(text) > 400").orderBy("doc_id").first().text[:300] for x in ("de", "en"))
    row = lang_crf.label_words(spark.createDataFrame([(1, english + " " + german)], "doc_id long, text string"), field).first()
    names = [w.lang for w in row.words]
    assert names[:20].count("en") >= 18 and names[-20:].count("de") >= 18
    assert {r.lang_pred for r in lang_crf.predict(cases, lang_crf.fit([], [])).collect()} == {"und"}


def test_factorisation_machine(spark, cases):
    import pyarrow as pa
    machine = factor_quality.Machine(0.3, *(np.random.default_rng(5).normal(size=s) for s in (factor_quality.FEATURES, (factor_quality.FEATURES, factor_quality.FACTORS))))
    texts = pa.array([prose(20, 1), ""])
    text, feature, value = factor_quality.vectors(texts)
    for i in range(2):
        f, v = feature[text == i], value[text == i]
        slow = machine.bias + (machine.weight[f] * v).sum() + sum(machine.factors[f[a]] @ machine.factors[f[b]] * v[a] * v[b] for a in range(len(f)) for b in range(a))
        assert np.isclose(machine.raw(text, feature, value, 2)[0][i], slow)
    r = random.Random(2)
    rows = [(k, (" ".join(w + "***" for w in prose(60, k).split()) if k % 3 == 0 else prose(60, k)), int(k % 3 > 0)) for k in range(300)]
    df = spark.createDataFrame(r.sample(rows, 300), "doc_id long, text string, quality int")
    machine = factor_quality.fit(factor_quality.sample(df.select("doc_id", "text"), df.filter("doc_id < 200").select("doc_id", "quality")))
    found = by_id(factor_quality.score(df, machine))
    assert all((found[k].score >= 0.5) == (q == 1) for k, _, q in rows if k >= 200)
    assert factor_quality.score(cases, machine).filter("score between 0 and 1").count() == cases.count()
    none = factor_quality.fit(factor_quality.sample(cases, df.limit(0)))
    assert none.bias == 0


def test_personal_data_equals_the_patterns(spark):
    r = random.Random(5)
    texts = ["".join(r.choice("ab1.@-+ 9().,_%\n￿5é") for _ in range(r.randint(1, 60))) for _ in range(500)]
    texts += ["".join(r.choice("4 -0123456789.+") for _ in range(r.randint(10, 60))) for _ in range(500)]
    texts += [None, "", "1" * 20_000, "a." * 9000 + "a@b.c" + ".d" * 9000, "1 " * 9000, "a@b.c_d@e.f", "4111 1111 1111 1111", "aé😀 a@b.co", "0255.1.1.1 1.2.3.4.5.6.7.8"]
    found = by_id(disclosure.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    for i, t in enumerate(texts):
        spans = brute.personal(t)
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert found[i].base_sha256 == hashlib.sha256(written.encode()).hexdigest() and found[i].spans.startswith(written)
        assert [found[i][f"n_{k}"] for k in disclosure.KINDS] == [sum(x == k for x, _, _ in spans) for k in disclosure.KINDS]


def test_revealing_terms(spark, cases):
    rows = [(i, f"meeting {w} notes zorblax engineer wrote to bob@x.org about {v} today") for i, (w, v) in enumerate(zip("one two three four five".split(), "cats dogs birds fish cows".split()))]
    rows += [(100 + i, "filler meeting notes today about of to wrote engineer " * 20 + str(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.term for r in disclosure.revealing_terms(df, disclosure.find(df)).collect()} == {"zorblax"}
    at = rows[0][1].index("zorblax")
    got = by_id(disclosure.personal_data(df))
    assert got[0].spans.endswith(f",term:{at}:{at + 7}") and got[100].spans == ""
    clean = by_id(disclosure.sanitise(df))
    assert "zorblax" not in clean[0].text and "<EMAIL>" in clean[0].text and clean[100].text == rows[5][1]
    assert disclosure.sanitise(cases).columns == cases.columns and disclosure.personal_data(cases).count() == cases.count()
    assert disclosure.personal_data(cases.filter("doc_id < 0")).count() == 0


def test_token_files_and_index(spark, cases, monkeypatch):
    monkeypatch.setattr(token_index, "SHARD_BYTES", 2000)
    texts = [t for t in CASES] + [prose(30, k) for k in range(300)]
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    found = by_id(token_index.write_and_read(spark.createDataFrame(rows, "doc_id long, text string"), TOKENIZER))
    tokenizer, start = Tokenizer.from_file(TOKENIZER), 0
    for i, t in enumerate(texts):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (found[i].start, found[i].n_tokens, found[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    shards = token_index.write_shards(cases, TOKENIZER)
    index, buckets = token_index.build_index(shards)
    asked = spark.createDataFrame([(1,), (5,), (5,), (777_777,), (None,)], "doc_id long")
    assert sorted(r.doc_id for r in token_index.look_up(asked, index, buckets).collect()) == [1, 5]
    assert token_index.write_and_read(cases.filter("doc_id < 0"), TOKENIZER).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    bits, sizes = token_index.build_hash(keys, ~keys)
    assert sorted(token_index.number_of(keys, ~keys, bits, sizes)) == list(range(5000))


def test_pipeline(spark, cases):
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert 0 < len(rows) < len(docs) and len({r.doc_id for r in rows}) == len(rows)
    assert not {r.doc_id for r in rows} & {i for i, t in docs.items() if brute.quality(t)[-1]}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for df in (cases, cases.filter("doc_id < 0")):
            assert stage(spark, df, SF).columns == cases.columns, name
            stage(spark, df, SF).collect()
    assert "pipeline" in __spark_entry__.queries()
