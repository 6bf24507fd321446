"""Lines that stand on many sites: HyperLogLog sketches of sites per line, exact counts near the threshold.

A line, trimmed, is known by its 64-bit hash and length. One aggregation merges a sketch of its sites, so a line that
is on a third of all pages costs a sketch per map task. The sketch decides where its estimate is clear of the threshold
by four and a half standard errors; the few lines between get an exact count of distinct sites. Lines on enough sites are
boilerplate and leave every document. How many are enough depends on how likely chance repeats are (`Spread`): `min_sites`
for a line of at least `min_words` words, fewer for a long line, and for a short one, which can be anyone's, a share of all sites.

Documents learn which of their own lines go, as a set of hashes joined by document id. The keys of boilerplate lines go to
all executors while they are few (`tables.sent_if_small`), so that a very common line fills no task; beyond, they are joined
by a shuffle. Every document stays, also one that loses all its lines.

Cases: null texts stay null, empty ones empty; lines without a word are never boilerplate; without rules for short and long
lines (the default) a line of fewer than `min_words` words is never boilerplate either; a null site counts as no site;
repeated rows lose the same lines; documents without an id are cleaned as well; an empty table gives an empty one. Other
columns pass through unchanged, whatever their names; the two counts get longer names where theirs are taken.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.tables import sent_if_small, stored

MIN_SITES = 10
MIN_WORDS = 4


@dataclass(frozen=True)
class Spread:
    """Sites that make a line boilerplate, by its number of words; no rule for long or short lines where None."""

    min_sites: int = MIN_SITES
    min_words: int = MIN_WORDS
    long_words: int | None = None
    long_sites: int | None = None
    short_share: float | None = None


#: Lines of twelve words do not repeat by chance: six sites are enough. Shorter than four words: half of all sites.
PRODUCTION = Spread(long_words=12, long_sites=6, short_share=0.5)
#: The sketch has 2^8 registers: its standard error is 1.04 / 16.
LOG_REGISTERS = 8
MARGIN = 4.5 * 1.04 / 16
_WHITE = " \t\n\x0b\x0c\r"


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(_WHITE))


def _known_by(line: Column) -> Column:
    """Hash of the trimmed line and its length."""
    return F.struct(F.xxhash64(_trimmed(line)).alias("h"), F.length(_trimmed(line)).alias("n"))


def _free(name: str, taken: list[str]) -> str:
    """The name, with more underscores before it while a column has it."""
    lower = {c.lower() for c in taken}
    while name in lower:
        name = "_" + name
    return name


def _lines(docs: DataFrame, text: str, rules: Spread, column: Column) -> DataFrame:
    """A row per line that can be boilerplate: the column as `of`, the line's key and its number of words."""
    found = docs.select(column.alias("of"), F.explode(F.split(F.col(text), "\n")).alias("line"))
    found = found.withColumn("line", _trimmed(F.col("line"))).filter(F.length("line") > 0)
    found = found.select("of", _known_by(F.col("line")).alias("key"), F.size(F.split("line", "[ \t-\r]+")).alias("n_words"))
    # what is left of a line has a word, so words are only counted where short lines have no rule or the number is used
    return found.filter(F.col("n_words") >= rules.min_words) if rules.short_share is None else found


def _enough(docs: DataFrame, site: str, rules: Spread) -> Column:
    """The sites that a line of `n_words` words needs."""
    need = F.lit(rules.min_sites)
    if rules.long_words is not None:
        need = F.when(F.col("n_words") >= rules.long_words, rules.long_sites).otherwise(need)
    if rules.short_share is not None:
        sites = docs.select(F.countDistinct(site)).first()[0]
        short = max(rules.min_sites, math.ceil(rules.short_share * sites))
        need = F.when(F.col("n_words") < rules.min_words, short).otherwise(need)
    return need


def boilerplate(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int = MIN_SITES,
                min_words: int = MIN_WORDS, rules: Spread | None = None) -> DataFrame:
    """Keys of lines on enough distinct sites, with the sketch's estimate and the exact count where needed."""
    rules = rules or Spread(min_sites, min_words)
    lines = _lines(docs, text, rules, F.col(site))
    sketches = lines.groupBy("key").agg(F.hll_sketch_agg("of", F.lit(LOG_REGISTERS)).alias("sketch"), F.max("n_words").alias("n_words"))
    wide = sketches.select("key", F.hll_sketch_estimate("sketch").alias("estimate"), _enough(docs, site, rules).alias("need"))
    wide = stored(wide.filter(F.col("estimate") >= (1 - MARGIN) * F.col("need")), "line-spread")
    near = sent_if_small(wide.filter(F.col("estimate") < (1 + MARGIN) * F.col("need")).select("key"), "near-lines")
    pairs = lines.join(near, "key", "left_semi").groupBy("key", "of").agg(F.lit(1).alias("one"))
    exact = pairs.groupBy("key").agg(F.count("of").alias("exact"))
    found = wide.join(exact, "key", "left").withColumn("n_sites", F.coalesce("exact", "estimate"))
    return found.filter(F.col("n_sites") >= F.col("need")).select("key", "estimate", "exact", "n_sites")


def remove_boilerplate(docs: DataFrame, key: str = "doc_id", text: str = "text", site: str = "source",
                       min_sites: int = MIN_SITES, min_words: int = MIN_WORDS, rules: Spread | None = None) -> DataFrame:
    """The documents with all their columns, boilerplate lines gone from the text, and `_n_lines`, `_n_removed`."""
    rules = rules or Spread(min_sites, min_words)
    of, gone, left, n_lines, n_removed = (_free(c, docs.columns) for c in ("_of", "_gone", "_left", "_n_lines", "_n_removed"))
    found = sent_if_small(boilerplate(docs, text, site, rules=rules).select("key"), "boilerplate")
    theirs = (_lines(docs, text, rules, F.col(key)).join(found, "key", "left_semi")
              .groupBy(F.col("of").alias(of)).agg(F.collect_set("key").alias(gone)))
    lines = F.split(F.col(text), "\n")
    marked = docs.join(theirs, docs[key].eqNullSafe(theirs[of]), "left")
    kept = F.filter(lines, lambda x: ~F.array_contains(F.col(gone), _known_by(x)))
    cleaned = marked.withColumn(left, F.when(F.col(gone).isNull(), lines).otherwise(kept))
    return cleaned.select(
        *(F.array_join(left, "\n").alias(c) if c == text else docs[c] for c in docs.columns),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias(n_lines),
        F.coalesce(F.size(lines) - F.size(left), F.lit(0)).cast("long").alias(n_removed))


SQL = rf"""
WITH lines AS (
  SELECT doc_id, source, line, pos, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS k
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents) AS cut
), boilerplate AS (
  SELECT k FROM (SELECT k, source, len(string_split_regex(k, '[\x20\x09-\x0D]+')) AS n FROM lines WHERE k <> '') AS counted
  GROUP BY k, n HAVING count(DISTINCT source) >= CASE
    WHEN n < {MIN_WORDS} THEN greatest({MIN_SITES}, (SELECT ceil({PRODUCTION.short_share} * count(DISTINCT source)) FROM documents))
    WHEN n >= {PRODUCTION.long_words} THEN {PRODUCTION.long_sites} ELSE {MIN_SITES} END
), cleaned AS (
  SELECT l.doc_id, count(*) AS n_lines, count(b.k) AS n_removed,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE b.k IS NULL), '') AS text
  FROM lines AS l LEFT JOIN boilerplate AS b ON l.k = b.k GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN c.text END AS text, coalesce(c.n_lines, 0) AS n_lines,
       coalesce(c.n_removed, 0) AS n_removed
FROM documents AS d LEFT JOIN cleaned AS c ON d.doc_id = c.doc_id
"""
