"""Weak supervision of quality rules: each rule votes or abstains, and the votes together decide.

Ten rules look at a text. Each votes good (1), bad (0) or abstains (null) where its figure is between its two bounds
or means little. How far a rule can be trusted is not set by hand: expectation-maximisation finds, from the votes of
all documents alone, the share of good documents and each rule's rates of right votes on good and on bad documents.
A document is kept where its posterior probability of being good is at least one half.

The votes of a corpus are counted by pattern. There are at most 3^10 patterns whatever the input, so the counts can be
fitted in the driver; the posterior is a sum of one logarithm per vote and is computed in Spark. All columns are built-in
SQL expressions, and each document is handled in its own row, without a shuffle of texts. Figures and votes are stored
once, a few dozen bytes a row beside the columns to keep; fit and verdict read them from there.

Cases: null and empty texts have no words and fail the base; very long texts are handled whole; repeated rows count as
often as they occur and get the same verdict; an empty table gives an empty result (and the start values as model);
other columns are neither read nor changed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.tables import stored

WHITE = " \t\n\x0b\x0c\r"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # percent of words in repeated windows
#: Posterior from which a document is kept.
KEPT_FROM = 0.5
RULES = ["length", "word_length", "symbols", "duplicate_lines", "repetition", "capitals", "sentences", "exclamations", "variety", "plain_words"]
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_P = "_quality_"


def _c(name: str) -> Column:
    return F.col(_P + name)


def with_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds the base figures and a few more, as columns with the prefix `_quality_`."""
    df = df.withColumn(_P + "text", F.coalesce(F.col(text), F.lit("")))
    t = _c("text")
    df = df.withColumns({
        _P + "words": F.filter(F.split(F.btrim(t, F.lit(WHITE)), "[ \t-\r]+"), lambda w: w != ""),
        _P + "lines": F.filter(F.split(t, "\n"), lambda line: line.rlike("[^ \t-\r]")),
        _P + "chars": F.length(t),
        _P + "white": F.regexp_count(t, F.lit("[ \t-\r]")),
        _P + "n_symbols": F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long"),
        _P + "capitals": F.regexp_count(t, F.lit("[A-ZÀ-ÖØ-Þ]")),
        _P + "stops": F.regexp_count(t, F.lit("[.!?…。]")),
        _P + "exclaimed": F.regexp_count(t, F.lit("!!")),
        _P + "plain": F.regexp_count(t, F.lit(r"(?<![^ \t-\r])\p{L}+[.,;:?!]?(?![^ \t-\r])")),
    })
    # hashes of all windows of eight words
    hashes = F.transform(F.sequence(F.lit(1), F.size(_c("words")) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(_c("words"), i, WINDOW)))
    none = F.array().cast("array<bigint>")
    df = df.withColumns({
        _P + "n_words": F.size(_c("words")).cast("long"),
        _P + "n_distinct": F.size(F.array_distinct(_c("words"))),
        _P + "n_lines": F.size(_c("lines")),
        _P + "n_dup_lines": (F.size(_c("lines")) - F.size(F.array_distinct(_c("lines")))).cast("long"),
        _P + "hashes": F.when(F.size(_c("words")) > WINDOW, hashes).otherwise(none),
    }).drop(_P + "words", _P + "lines", _P + "text")
    # only texts with an equal pair of windows are sorted: equal hashes then lie side by side
    pairs = F.sort_array(F.transform(_c("hashes"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct(_c("hashes"))) < F.size(_c("hashes"))
    df = df.withColumn(_P + "sorted", F.when(repeats, pairs)).drop(_P + "hashes")
    twice = F.filter(_c("sorted"), lambda e, k: F.coalesce((F.get(_c("sorted"), k - 1)["h"] == e["h"]), F.lit(False))
                     | F.coalesce((F.get(_c("sorted"), k + 1)["h"] == e["h"]), F.lit(False)))
    df = df.withColumn(_P + "at", F.sort_array(F.transform(twice, lambda e: e["i"]))).drop(_P + "sorted")
    # words that the windows at these places cover together
    covered = F.transform(_c("at"), lambda p, k: F.coalesce(F.least(F.lit(WINDOW), F.get(_c("at"), k + 1) - p), F.lit(WINDOW)))
    return df.withColumns({
        _P + "n_repeat_words": F.coalesce(F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0).cast("long")),
        _P + "word_chars": (_c("chars") - _c("white")).cast("long"),
    }).drop(_P + "at", _P + "white")


def base_failed() -> Column:
    return (_c("n_words") < MIN_WORDS) | (100 * _c("n_repeat_words") > MAX_REPEATED * _c("n_words"))


def votes() -> dict[str, Column]:
    """1 good, 0 bad, null abstains, from the columns of `with_stats`."""
    n, chars = _c("n_words"), F.greatest(_c("word_chars"), F.lit(1))

    def vote(good: Column, bad: Column, counts: Column | None = None) -> Column:
        out = F.when(bad, F.lit(0)).when(good, F.lit(1))
        return out if counts is None else F.when(counts, out)

    return {
        "length": vote(n >= 50, n < MIN_WORDS),
        "word_length": vote(_c("word_chars").between(3 * n, 12 * n), ~_c("word_chars").between(2 * n, 20 * n), n > 0),
        "symbols": vote(_c("n_symbols") * 50 <= n, _c("n_symbols") * 5 > n, n > 0),
        "duplicate_lines": vote(_c("n_dup_lines") * 10 <= _c("n_lines"), _c("n_dup_lines") * 3 > _c("n_lines"), _c("n_lines") > 2),
        "repetition": vote(_c("n_repeat_words") * 10 <= n, _c("n_repeat_words") * 10 > 3 * n, n >= 2 * WINDOW),
        "capitals": vote(_c("capitals") * 6 <= chars, _c("capitals") * 2 > chars, n > 0),
        "sentences": vote(_c("stops") * 60 >= n, _c("stops") * 150 < n, n >= MIN_WORDS),
        "exclamations": vote(_c("exclaimed") * 50 <= n, _c("exclaimed") * 10 > n, n > 0),
        "variety": vote(_c("n_distinct") * 5 >= n, _c("n_distinct") * 10 < n, n.between(50, 1000)),
        "plain_words": vote(_c("plain") * 10 >= 8 * n, _c("plain") * 10 < 6 * n, n > 0),
    }


@dataclass
class Model:
    """Share of good documents, and for each rule the rate of good votes on good and of bad votes on bad documents."""

    good: float = 0.9
    on_good: dict[str, float] = field(default_factory=lambda: dict.fromkeys(RULES, 0.98))
    on_bad: dict[str, float] = field(default_factory=lambda: dict.fromkeys(RULES, 0.3))

    def weight(self, rule: str, vote: int) -> float:
        """What a vote adds to the log-odds of being good."""
        if vote:
            return math.log(self.on_good[rule] / (1 - self.on_bad[rule]))
        return math.log((1 - self.on_good[rule]) / self.on_bad[rule])

    def posterior(self, voted: dict[str, Column]) -> Column:
        odds = F.lit(math.log(self.good / (1 - self.good)))
        for rule, vote in voted.items():
            odds = odds + F.when(vote == 1, self.weight(rule, 1)).when(vote == 0, self.weight(rule, 0)).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def fit(voted: DataFrame, rounds: int = 50, trust: float = 20.0) -> Model:
    """Expectation-maximisation over the counts of vote patterns.

    The start values count as `trust` votes for each rate: a rule that hardly ever votes stays near them. A rule is
    never taken for worse than chance on both sides, which would turn good into bad.
    """
    counts = voted.groupBy(*RULES).agg(F.count(F.lit(1)).alias("n")).orderBy(*RULES).collect()
    start, model = Model(), Model()
    total = sum(r["n"] for r in counts)
    for _ in range(rounds if total else 0):
        mass = dict.fromkeys(RULES, 0.0), dict.fromkeys(RULES, 0.0)
        right = dict.fromkeys(RULES, 0.0), dict.fromkeys(RULES, 0.0)
        good = 0.0
        for r in counts:
            odds = math.log(model.good / (1 - model.good))
            odds += sum(model.weight(rule, r[rule]) for rule in RULES if r[rule] is not None)
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            good += p * r["n"]
            for rule in RULES:
                if r[rule] is not None:
                    for side, q in ((0, 1 - p), (1, p)):
                        mass[side][rule] += q * r["n"]
                        right[side][rule] += q * r["n"] * (r[rule] == side)
        rate = lambda side, prior: {x: min(0.999, max(0.05 if side == 0 else 0.5, (right[side][x] + trust * prior[x]) / (mass[side][x] + trust)))
                                    for x in RULES}
        model = Model(min(0.999, max(0.5, good / total)), rate(1, start.on_good), rate(0, start.on_bad))
    return model


def _voted(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The columns named in `keep`, base figures, the base's verdict and the ten votes, stored: texts are looked at once, and both
    the fit and the verdict read the figures."""
    figures = with_stats(df, text)
    return stored(figures.select(*keep, *(_c(s) for s in STATS), base_failed().alias(_P + "base_failed"),
                                 *(v.alias(_P + "vote_" + k) for k, v in votes().items())), "votes")


def _vote_columns() -> dict[str, Column]:
    return {k: _c("vote_" + k) for k in RULES}


def _p_good(voted: DataFrame, model: Model | None) -> Column:
    model = model or fit(voted.select(*(v.alias(k) for k, v in _vote_columns().items())))
    return model.posterior(_vote_columns())


def judge(df: DataFrame, model: Model | None = None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns named in `keep` (all if none), the base figures, base_failed, p_good and kept."""
    keep = df.columns if keep is None else keep
    voted = _voted(df.select(*{*keep, text}), text, keep)
    p_good = _p_good(voted, model)
    return voted.select(*keep, *(_c(s).alias(s) for s in STATS), _c("base_failed").alias("base_failed"), p_good.alias("p_good"),
                        (~_c("base_failed") & (p_good >= KEPT_FROM)).alias("kept"))


def keep_good(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of documents that pass the base and the vote, with the columns they had."""
    voted = _voted(df, text, df.columns)
    return voted.filter(~_c("base_failed") & (_p_good(voted, None) >= KEPT_FROM)).select(*df.columns)
