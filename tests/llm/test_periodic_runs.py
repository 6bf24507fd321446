"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import zlib

import pytest

from gaugeline.llm import periodic_runs as pr
from gaugeline.llm import queries
from tests.llm.brute import words

SF = "/root/testdata/sf0.001"


def plain_runs(w, min_length=12):
    found, n = [], len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            s, e = i, j + q
            if j > i and e - s >= max(min_length, 2 * q):
                if not any(w[s: e - r] == w[s + r: e] for r in range(1, q)):
                    found.append((s, e - s, q))
            i = max(i + 1, j)
    return sorted(found, key=lambda t: (t[0], t[2]))


def planted(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def plain_row(doc_id, text):
    w = words(text)
    w = planted(doc_id, w) if doc_id is not None else w
    runs = plain_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda t: (-t[1], t[0], t[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256("".join("%d,%d,%d\n" % t for t in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def sequence(r):
    n, k = r.randint(0, 90), r.choice([1, 2, 2, 3, 5, 30])
    w = [b"%d" % r.randint(1, k) for _ in range(n)]
    if n and r.random() < 0.5:
        a, p = r.randrange(n), r.randint(1, 10)
        w = w[:a] + [w[min(n - 1, a + (i - a) % p)] for i in range(a, n)]
    return w


@pytest.mark.parametrize("min_length", [2, 3, 6, 12])
def test_runs_equal_a_plain_search(min_length):
    r = random.Random(min_length)
    for _ in range(300):
        w = sequence(r)
        assert [tuple(x) for x in pr.text_runs(w, min_length).tolist()] == plain_runs(w, min_length)


def test_regions_lose_no_run_and_leave_distant_copies_out():
    r = random.Random(1)
    line = [b"l%d" % i for i in range(20)]
    apart = line + [b"x%d" % i for i in range(300)] + line
    assert all(b - a < 80 for a, b in pr.regions(pr.np.fromiter(map(hash, apart), "int64", len(apart)).view("uint64")))
    block = [b"%d" % r.randint(1, 9) for _ in range(50)]
    far = [b"y%d" % i for i in range(500)] + block * 3 + [b"z%d" % i for i in range(500)] + [b"w"] * 40
    assert [tuple(x) for x in pr.text_runs(far).tolist()] == plain_runs(far)


def test_words_whose_polynomial_hashes_collide_stay_apart():
    """A Thue-Morse word of 2048 letters and its complement."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))
    b = a.translate(str.maketrans("ab", "ba"))
    w = [x.encode() for x in [a, b] * 3 + [b, a] * 5]
    assert [tuple(x) for x in pr.text_runs(w).tolist()] == plain_runs(w)


def test_agreement_is_common_prefix():
    r = random.Random(2)
    w = [r.randint(1, 2) for _ in range(200)]
    e = pr.Extension(w)
    i, j = pr.np.array([(x, y) for x in range(201) for y in range(201) if x != y]).T
    for x, y, k in zip(i, j, e.agree(i, j)):
        assert w[x: x + k] == w[y: y + k] and (max(x, y) + k == 200 or w[x + k] != w[y + k])


def test_query_equals_plain_form_on_awkward_rows(spark, tmp_path):
    r = random.Random(4)
    texts = [None, "", " \n\t", "one", "a " * 11, "a " * 12, "a\x0bb\x0c" * 9, " a b c" * 40, "é ü " * 20, "x" * 40_000, "😀 日本 " * 7, "a b " * 30_000]
    texts += [" ".join(str(r.randint(0, 3)) for _ in range(r.randint(1, 120))) for _ in range(150)]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(3, texts[3], None, None), (7, texts[7], None, None), (None, "a b " * 9, None, None), (None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int").write.parquet(f"{tmp_path}/documents.parquet")
    found = [tuple(x) for x in queries.op13_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(found, key=str) == sorted((plain_row(i, t) if len(t or "") < 99_999 else quick_row(i, t) for i, t, _, _ in rows), key=str)


def quick_row(doc_id, text):
    """The same for a text that repeats two words all the way, too long for the plain search."""
    w = planted(doc_id, words(text))
    runs = [(0, len(w), 2)]
    assert w == ["a", "b"] * (len(w) // 2)
    return (doc_id, 1, 0, len(w), 2, 500 * len(w), hashlib.sha256(b"0,%d,2\n" % len(w)).hexdigest(), hashlib.sha256(b"a b").hexdigest())


def test_query_equals_plain_form_on_given_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = {r.doc_id: tuple(r) for r in queries.op13_periodic_runs(spark, SF).collect()}
    short = [d for d in docs if len(d.text or "") < 6_000]
    assert len(short) > 100 and len(found) == len(docs)
    assert all(found[d.doc_id] == plain_row(d.doc_id, d.text) for d in short)


def test_operator_on_empty_table_and_other_keys(spark):
    df = spark.createDataFrame([], "id string, body string, text int")
    out = pr.periodic_runs(df, "id", "body")
    assert out.count() == 0 and out.columns == ["id", "n_words", "runs", "text"]
    one = pr.periodic_runs(spark.createDataFrame([("k", "a b " * 8 + "c")], "id string, body string"), "id", "body").first()
    assert one["n_words"] == 17 and [tuple(x) for x in one["runs"]] == [(0, 16, 2)] and one["text"] == "a b c"
