"""From raw documents to token ids: quality rules, line dedup, near-dedup, decontamination, encoding.

Each stage takes the documents that the one before it kept, with their columns, and is stored before the next one reads
it. Empty tables pass through all stages; null texts fail the quality rules.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import byte_bpe, line_spread, lsh_forest, quality_rules, template_leaks
from gaugeline.llm.queries import RANKS
from gaugeline.llm.tables import load, stored

#: Expectation-maximisation, signatures and byte-pair merges have no SQL form; tests compare with brute force.
ORACLE_SQL = None
#: Stages on word shingles take a similarity of 0.8 or more.
PERCENT = 80


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the weighed votes."""
    return quality_rules.keep_good(docs)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that stand on many sites; n_chars counts what is left."""
    cleaned = line_spread.remove_boilerplate(docs, rules=line_spread.PRODUCTION)
    counted = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return cleaned.withColumns(counted).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    return lsh_forest.keep_first(docs, percent=PERCENT)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return template_leaks.remove_leaks(docs, load(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its number of ids, and digests of the ids and of the bytes that they decode to."""
    return byte_bpe.digests(docs, RANKS, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", good),
    ("line_dedup", without_boilerplate),
    ("near_dedup", one_of_each),
    ("decontamination", without_leaks),
    ("byte_bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
