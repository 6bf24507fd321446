"""Items that only their literal words tell, brute force for templates, and rules for short and long lines."""

from pyspark.sql import functions as F

import check_oracle
from gaugeline.llm import line_spread, template_leaks
from tests.llm import brute

SF = "/root/testdata/sf0.001"
ITEMS = [(1, "Ann has 3 kg, Bob has 5 kg, Eve has 7 kg and Dan has 9 kg."), (2, "12 + 7 = 19 and 20 - 5 = 15"), (3, "What is love?"),
         (4, "日本で一番高い山は何ですか。"), (5, "Yes."), (6, "Who was Ada?"), (7, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16")]


def held(spark, rows, items=ITEMS):
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id int, text string")
    found = template_leaks.leaks(docs, spark.createDataFrame(items, "item_id int, text string"))
    return {(r.doc_id, r.item_id): r.kind for r in found.collect()}


def test_items_without_template_windows_are_found_word_by_word(spark):
    copies = [text for _, text in ITEMS]
    inside = [f"Some words before it. {text} Some words after it." for text in copies]
    clean = ["He asked what is love in these times, and who was Ada to him.", "Ann has 4 kg, Bob has 5 kg, Eve has 8 kg and Dan has 6 kg.",
             "12 + 8 = 20 and 20 - 5 = 15", "日本で一番高い塔は何ですか。山は美しい。", "Yes. No.", "5 6 7 8 1 2 3 4", None, "", "。", "山"]
    got = held(spark, copies + inside + clean)
    wanted = {1, 2, 3, 4, 6, 7}
    assert {(d, i) for d, i in got} == {(k * len(copies) + i - 1, i) for k in (0, 1) for i in wanted}
    assert set(got.values()) == {"exact"}


def test_text_without_spaces_is_read_by_characters(spark):
    rows = ["前文です。日本で一番高い山は何ですか。後文です。", "x日本で一番高い山は何ですか", "日本 で一番 高い山は何 ですか", "日本で一番", "ไทยภาษา"]
    assert held(spark, rows) == {(0, 4): "exact", (1, 4): "exact", (2, 4): "exact"}


def test_item_sides_of_every_size(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    items = [(n, " ".join(words[:n]) + ".") for n in range(1, 11)]
    got = held(spark, [text for _, text in items], items)
    assert {(n - 1, n) for n in range(2, 11)} <= set(got) and not any(i == 1 for _, i in got)
    assert not any(i > d + 1 for d, i in got)


def test_templates_equal_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = {r.item_id: r.text for r in items.collect()}
    own = {r.doc_id: r.text for r in docs.collect()}
    # the same items with other numbers and names, cut, or repeated, inside clean words
    for i, text in list(texts.items())[:40]:
        own[10_000 + i] = "Before it all. " + text + " After it."
        own[20_000 + i] = " ".join(text.split()[:12])
        own[30_000 + i] = text.replace("a", "e") + "\n" + text
    own[40_000] = " ".join(t for t in texts.values() if t)
    more = "Tom has 5 apples and gives 2 kg of them to Mary before lunch. How many apples does Tom have left now?"
    texts[999] = more
    own[40_001], own[40_002] = more.replace("Tom", "Sam").replace("5", "7"), more.replace("5", "6").replace("Tom have", "Eve have")
    table = spark.createDataFrame(list(own.items()), "doc_id long, text string")
    known = spark.createDataFrame(list(texts.items()), "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.n_windows, r.n_found) for r in template_leaks.leaks(table, known).collect()}
    want = brute.template_leaks(own, texts, set(template_leaks.UNITS))
    enough = {i for i, t in texts.items() if len(list(brute.template_windows(brute.template_words(t, set(template_leaks.UNITS))))) >= 3}
    assert len(want) > 100 and (40_001, 999) in want
    assert {k: v for k, v in got.items() if k[1] in enough} == {k: v for k, v in want.items() if k[1] in enough}


def test_short_and_long_lines_have_their_own_rules(spark):
    long = "a line of more than twelve words that nobody writes twice by any chance"
    rows = [(i, f"own text number {i}\nAll rights reserved.\n\n" + (f"{long}\nfour words of it\n" if i < 7 else "") + ("few\n" if i < 9 else ""), f"s{i}")
            for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in line_spread.remove_boilerplate(df, rules=line_spread.PRODUCTION).collect()}
    assert got[0] == "own text number 0\n\nfour words of it\nfew\n" and got[19] == "own text number 19\n\n"
    plain = {r.doc_id: r.text for r in line_spread.remove_boilerplate(df).collect()}
    assert plain == {i: text for i, text, _ in rows}


def test_names_of_other_columns_do_not_matter(spark):
    df = spark.createDataFrame([(1, "a line", "x"), (2, None, None)], "doc_id long, text string, source string")
    names = ("_of", "_gone", "_left", "_n_lines", "_n_removed", "of", "line", "key", "n_words", "need")
    df = df.withColumns({c: F.lit(1) for c in names})
    out = line_spread.remove_boilerplate(df, rules=line_spread.PRODUCTION)
    assert out.columns == [*df.columns, "__n_lines", "__n_removed"] and out.count() == 2


def test_line_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    ok, note = check_oracle.compare(spark, check_oracle.connect(sf), "op4_line_spread", sf)
    assert ok, note
