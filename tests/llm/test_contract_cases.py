"""Cases of the contracts that earlier forms missed."""

import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeline.llm import disclosure, lang_crf, line_blocks

PROSE = "It was a long and quiet evening in the old town, and the people who lived there had gone home early. " * 3


def test_letters_are_those_of_unicode():
    text = "aZ@[`{ªµº—…€😀→、。日本éßЖא٣5\U0001d400\U0010ffff"
    data = np.frombuffer(text.encode(), np.uint8)
    at = np.cumsum([0, *(len(c.encode()) for c in text)])[:-1]
    assert lang_crf.letter_starts(data)[at].tolist() == [unicodedata.category(c)[0] == "L" for c in text]
    assert lang_crf.letter_starts(data).sum() == sum(unicodedata.category(c)[0] == "L" for c in text)


def test_only_texts_without_letters_are_undetermined(spark):
    english = [f"the house and the garden of number {i} were there" for i in range(30)]
    german = [f"das Haus und der Garten von Nummer {i} waren dort" for i in range(30)]
    field = lang_crf.fit(english + german, ["en"] * 30 + ["de"] * 30)
    texts = ["—", "… 12 €", "😀", "→ 5", "、。", "", None, "12", "ª µ º", "der Garten", "日本"]
    got = {r.doc_id: r for r in lang_crf.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), field).collect()}
    for i, text in enumerate(texts):
        letters = any(unicodedata.category(c)[0] == "L" for c in text or "")
        assert (got[i].lang_pred != "und") == letters, text
        assert letters or got[i].score == 0
    assert got[9].lang_pred == "de"


def test_a_rare_language_is_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(lang_crf, "SAMPLE", 60)
    rows = [(i, f"the house and garden number {i}", "en") for i in range(900)] + [(1000 + i, f"talo ja puutarha numero {i}", "fi") for i in range(5)]
    rows += [(2000, None, "en"), (2001, "text without language", None), (None, "a row without a key", "en"), (5, "the house and garden number 5", "en")]
    field = lang_crf.fit_on(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert field.languages == ["en", "fi"]
    found = lang_crf.predict(spark.createDataFrame([(1, "talo ja puutarha"), (2, "the garden")], "doc_id long, text string"), field)
    assert {r.doc_id: r.lang_pred for r in found.collect()} == {1: "fi", 2: "en"}
    assert lang_crf.fit_on(spark.createDataFrame([], "doc_id long, text string, lang string")).languages == []
    monkeypatch.setattr(lang_crf, "MOST_LANGUAGES", 1)
    assert lang_crf.fit_on(spark.createDataFrame(rows, "doc_id long, text string, lang string")).languages == ["en"]


@pytest.mark.parametrize("page, want", [
    (f"<body><article><h3>Teaser</h3><p>Short.</p></article><div id=content><p>{PROSE}</p><p>{PROSE}</p></div></body>", [PROSE.strip()] * 2),
    (f"<body><article><p>{PROSE}</p></article><section class=comments><article class=comment><p>{PROSE} I agree.</p></article></section></body>", [PROSE.strip()]),
    (f"<body><main><p>{PROSE}</p><article class='user-comment'><p>{PROSE} No.</p></article></main></body>", [PROSE.strip()]),
    (f"<body><article><p class=search-results>{PROSE}</p><p class=meta>{PROSE}</p><p class=share-prices>{PROSE}</p></article></body>", [PROSE.strip()] * 3),
    (f"<body><article><p class='advert'>{PROSE}</p><p>{PROSE}</p></article></body>", [PROSE.strip()]),
    (f"<body><div class=ad>never closed<article><p>{PROSE}</p></article></body>", [PROSE.strip()]),
])
def test_pages(page, want):
    assert line_blocks.main_blocks(page) == want


def test_window_sums_decide_without_marks():
    """The plain form: a line is text from where three lines hold more than the threshold until three lines hold nothing."""
    lines = [30, 0, 0, 0, 50, 60, 0, 10, 0, 0, 0, 5, 0, 0, 0, 87, 0, 0, 0]
    want, inside = set(), False
    for i, w in enumerate(lines):
        total = sum(lines[i: i + 3])
        inside = total > 0 if inside else w > 0 and total > line_blocks.THRESHOLD
        if inside:
            want.add(i)
    assert line_blocks._surges([("x" * w, w, False, False) for w in lines], lines) == want


def test_clashing_columns_and_empty_pages(spark):
    df = spark.createDataFrame([(1, "u", f"<p>{PROSE}</p>", "t", 3)], "page_id long, url string, html string, text string, n_chars int")
    row = line_blocks.main_text(df).first()
    assert (row.page_id, row.url, row.text, row.n_chars) == (1, "u", PROSE.strip(), len(PROSE.strip()))
    assert line_blocks.main_text(df.filter(F.lit(False))).count() == 0


def test_context_is_eight_whole_words_however_long(spark):
    long = ["a" * 100 + "bcdefghijklmn"[k] for k in range(10)]
    text = " ".join(long) + " ann@mail.example.com " + " ".join(long)
    numbers = "word " * 8 + "12 " * 2000 + "bob@mail.example.com 1 2 3"
    df = spark.createDataFrame([(1, text), (2, numbers), (3, "x"), (4, None)], "doc_id long, text string")
    near = {r.id: [s.near for s in r.spans] for r in disclosure.find(df).collect()}
    assert near == {1: [[*long[::-1][:8], *long[:8]]], 2: [["word"] * 8], 3: [], 4: []}
