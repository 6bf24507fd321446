"""Personal data by form, and the words that give it away by information.

Base. E-mail addresses, IP addresses, card numbers and phone numbers are found by their patterns, leftmost and without
overlap for each kind. A match is found twice with one and the same pattern, once as the match and once as the cut between
the parts around it; the lengths of both give its place. To keep Java's matcher from recursing over long texts, a dot
between two domain characters, or a separator between two digits, is first exchanged for one character that no text
keeps (U+FFFF), so that every repetition is one of a single character class.

Information. An entity is one personal datum. The eight words on either side of it are its context, equal contexts count
once. A word reveals an entity as far as their pointwise mutual information,
    log2(n(word, entity) * words / (n(word) * n(entity) * 16)),
comes near the information of the entity, log2(words / n(entity)). Counts of words are over the whole corpus. From
`GENERALISED` of that information a word is generalised, from `REMOVED` it goes, in all documents that hold the entity,
if they met in at least `MET` different contexts. These words are spans of the kind `term`.

All of it is built-in SQL expressions and joins. A context has sixteen words, so pairs grow with the number of matches.

Cases: null and empty texts have no spans; very long texts are searched whole; rows that repeat a key share the terms of
that key, each at its own places; an empty table gives an empty one; other columns are not read. Documents without an
id are searched as any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.tables import stored

KINDS = ["email", "ip", "card", "phone"]
MET, GENERALISED, REMOVED = 3, 0.6, 0.9
SIDE = 8
#: The terms beside a datum are looked for within so many characters first, then in the whole text.
CONTEXT_CHARS = (160, 2000)

_MARK = "\uffff"
_LABEL, _LOCAL = "A-Za-z0-9-", "A-Za-z0-9._%+-"
# A run of local characters is tried from its start, or from the end of the last match: from later places it ends alike.
_EMAIL = rf"(?:\G|(?<![{_MARK}{_LOCAL}]))[{_MARK}{_LOCAL}]++@[{_LABEL}]+{_MARK}[{_LABEL}][{_MARK}{_LABEL}]*"
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = rf"[0-9{_MARK}]{{2,}}"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_WORD = "[^ \t-\r]"


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    values = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substr(digits, n - i, F.lit(1)).cast("int") * (1 + i % 2))
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.when(v > 9, v - 9).otherwise(v)) % 10 == 0


def _found(text: Column, pattern: str, kind: int, right: callable) -> Column:
    """Spans (kind, start, end, value) of the matches that are right."""
    values, parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<kind:int,start:int,end:int,value:string>>").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.length(x["part"])
        end = begin + F.length(x["value"])
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.when(right(x["value"]), F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    both = F.zip_with(values, F.slice(parts, 1, F.size(values)), lambda v, p: F.struct(p.alias("part"), v.alias("value")))
    return F.aggregate(both, start, step, lambda state: state["spans"])


def base_spans(text: Column) -> Column:
    """All base spans of a text that is not null, by kind and start; kind is the place in KINDS."""
    none = F.array().cast("array<struct<kind:int,start:int,end:int,value:string>>")
    plain = F.replace(text, F.lit(_MARK), F.lit("?"))
    dotted = F.regexp_replace(plain, rf"(?<=[{_LABEL}])\.(?=[{_LABEL}])", _MARK)
    joined = F.regexp_replace(plain, r"(?<=[0-9])[\x20-](?=[0-9])", _MARK)

    def clean(x: Column) -> Column:
        return F.regexp_replace(x, "[^0-9]", "")

    email = F.when(text.contains("@"), _found(dotted, _EMAIL, 0, lambda v: F.lit(True)))
    ip = F.when(text.rlike(r"[0-9]\.[0-9]"), _found(plain, _IP, 1, lambda v: v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")))
    card = F.when(text.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]"),
                  _found(joined, _CARD, 2, lambda v: F.length(clean(v)).between(16, 19) & F.when(F.length(clean(v)).between(16, 19), _luhn(clean(v)))))
    phone = F.when(text.contains("+"), _found(plain, _PHONE, 3, lambda v: F.length(clean(v)).between(8, 15)))
    return F.concat(*(F.coalesce(x, none) for x in (email, ip, card, phone)))


def _terms(text: Column) -> Column:
    """Words as terms: small letters, without outer punctuation, with a letter."""
    words = F.transform(F.split(F.lower(text), "[ \t-\r]+"), lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    return F.filter(words, lambda w: w.rlike(r"^[\p{L}'’-]{3,}$"))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, spans (kind, start, end, entity) and n_words of every row, in the order of no one; stored."""
    t = F.col("_text")
    rows = docs.select(F.col(key).alias("id"), F.coalesce(text, F.lit("")).alias("_text"))
    rows = rows.withColumn("spans", base_spans(t))

    def nearest(s: Column, chars: int | None) -> tuple[Column, Column]:
        """Terms before a span, nearest first, and after it, within so many characters; a word cut there is left out."""
        if chars is None:
            return F.reverse(_terms(F.substr(t, F.lit(1), s["start"]))), _terms(F.substr(t, s["end"] + 1))
        before = F.greatest(s["start"] - chars, F.lit(0))
        left, right = F.substr(t, before + 1, s["start"] - before), F.substr(t, s["end"] + 1, F.lit(chars))
        left = F.when(before > 0, F.regexp_replace(left, "^[^ \t-\r]+", "")).otherwise(left)
        right = F.when(s["end"] + chars < F.length(t), F.regexp_replace(right, "(?<![^ \t-\r])[^ \t-\r]+$", "")).otherwise(right)
        return F.reverse(_terms(left)), _terms(right)

    def around(s: Column) -> Column:
        # a wider look only where eight terms are not met in a narrower one
        near = nearest(s, None)
        for chars in reversed(CONTEXT_CHARS):
            closer = nearest(s, chars)
            near = tuple(F.when(F.size(c) >= SIDE, c).otherwise(n) for c, n in zip(closer, near))
        near = F.concat(*(F.slice(n, 1, SIDE) for n in near))
        entity = F.concat_ws(":", s["kind"], F.lower(F.replace(s["value"], F.lit(_MARK), F.lit("."))))
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), entity.alias("entity"), near.alias("near"))

    return stored(rows.select("id", F.transform("spans", around).alias("spans"), F.regexp_count(t, F.lit(f"{_WORD}+")).alias("n_words")), "base-spans")


def revealing_terms(docs: DataFrame, found: DataFrame, text: str = "text", met: int = MET, share: float = GENERALISED) -> DataFrame:
    """entity, term and the share of the entity's information that the term gives; stored."""
    contexts = found.select(F.explode("spans").alias("s")).select("s.entity", F.array_sort(F.array_distinct("s.near")).alias("near")).distinct()
    entities = contexts.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    pairs = contexts.select("entity", F.explode("near").alias("term")).groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both"))
    pairs = stored(pairs.filter(F.col("n_both") >= met).join(entities, "entity"), "term-pairs")
    terms = pairs.select("term").distinct()
    used = docs.select(F.explode(_terms(F.col(text))).alias("term")).join(terms, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    words = found.agg(F.sum("n_words").alias("n_words"))
    told = F.log2(F.col("n_both") * F.col("n_words") / (F.col("n_term") * F.col("n_entity") * 2.0 * SIDE))
    shares = pairs.join(used, "term").join(F.broadcast(words))  # one row
    shares = shares.withColumn("share", told / F.log2(F.greatest(F.col("n_words") / F.col("n_entity"), F.lit(2.0))))
    return stored(shares.filter(F.col("share") >= share).select("entity", "term", "share"), "revealing-terms")


def term_spans(docs: DataFrame, found: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id and spans (start, end, share) of revealing terms, in documents that hold their entity."""
    held = found.select("id", F.explode("spans").alias("s")).select("id", F.col("s.entity").alias("entity")).distinct()
    held = held.join(terms, "entity").groupBy("id", "term").agg(F.max("share").alias("share"))
    held = stored(held, "terms-of-documents").withColumnRenamed("id", "held_id")
    ids = held.select("held_id").distinct()
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("_text"))
    rows = rows.join(ids, rows["id"].eqNullSafe(ids["held_id"]), "left_semi").distinct()
    # pieces are a word and the white space after it
    pieces = rows.select("id", F.xxhash64("_text").alias("copy"), F.posexplode(F.split("_text", "(?<=[ \t-\r])(?=[^ \t-\r])")).alias("i", "piece"))
    before = F.sum(F.length("piece")).over(Window.partitionBy("id", "copy").orderBy("i")) - F.length("piece")
    word = F.regexp_extract("piece", r"^([ \t-\r]*+[^\p{L}\p{N}]*+)(.*?)[^\p{L}\p{N}]*$", 2)
    lead = F.length(F.regexp_extract("piece", r"^([ \t-\r]*+[^\p{L}\p{N}]*+)", 1))
    pieces = pieces.select("id", "copy", (before + lead).alias("start"), word.alias("word"))
    hit = pieces.join(held, pieces["id"].eqNullSafe(held["held_id"]) & (F.lower("word") == F.col("term")))
    span = F.struct(F.col("start"), (F.col("start") + F.length("word")).alias("end"), F.col("share"))
    return hit.groupBy("id", "copy").agg(F.array_sort(F.collect_set(span)).alias("terms"))


def _written(kind: Column, span: Column) -> Column:
    return F.concat_ws(":", kind, span["start"], span["end"])


def personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, counts of base kinds, base_sha256, spans (all, written kind:start:end), for every row."""
    found = find(docs, key, text)
    terms = revealing_terms(docs, found, text)
    names = F.array(*map(F.lit, KINDS))
    base = F.array_join(F.transform("spans", lambda s: _written(F.get(names, s["kind"]), s)), ",")
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    out = found.select("id", *counts, base.alias("base"))
    if terms.isEmpty():
        more = out.withColumn("more", F.lit(""))
    else:
        extra = term_spans(docs, found, terms, key, text).groupBy("id").agg(F.max_by("terms", F.size("terms")).alias("terms"))
        extra = extra.select(F.col("id").alias("extra_id"), F.array_join(F.transform("terms", lambda s: _written(F.lit("term"), s)), ",").alias("terms"))
        more = out.join(extra, out["id"].eqNullSafe(extra["extra_id"]), "left").withColumn("more", F.coalesce("terms", F.lit("")))
    spans = F.array_join(F.filter(F.array("base", "more"), lambda x: x != ""), ",")
    return more.select(F.col("id").alias(key), *(f"n_{k}" for k in KINDS), F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), spans.alias("spans"))


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with all their columns; in the text, base spans become <KIND>, revealing terms <TERM> or nothing.

    Where spans overlap, the first one counts.
    """
    found = find(docs, key, text)
    terms = revealing_terms(docs, found, text)
    extra = term_spans(docs, found, terms, key, text).withColumnsRenamed({"id": "_extra_id", "copy": "_copy", "terms": "_terms"})
    names = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))
    both = docs.join(extra, docs[key].eqNullSafe(extra["_extra_id"]) & (F.xxhash64(text) == extra["_copy"]), "left")
    own = F.transform(base_spans(F.coalesce(text, F.lit(""))), lambda s: F.struct(s["start"].cast("long").alias("start"), s["end"].cast("long").alias("end"), F.get(names, s["kind"]).alias("put")))
    told = F.transform(F.coalesce("_terms", F.array().cast("array<struct<start:bigint,end:bigint,share:double>>")), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.when(s["share"] >= REMOVED, "").otherwise("<TERM>").alias("put")))
    both = both.withColumn("_spans", F.array_sort(F.concat(own, told)))
    state = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        kept = F.substr(F.col(text), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        return F.when(s["start"] < a["at"], a).otherwise(F.struct(s["end"].alias("at"), F.concat(a["out"], kept, s["put"]).alias("out")))

    done = F.aggregate("_spans", state, step)
    both = both.withColumn("_done", done)
    left = F.substr(F.col(text), (F.col("_done.at") + 1).cast("int"), F.length(text))
    cleaned = F.when(F.size("_spans") == 0, F.col(text)).otherwise(F.concat(F.col("_done.out"), left))
    return both.select(*(cleaned.alias(c) if c == text else docs[c] for c in docs.columns))
