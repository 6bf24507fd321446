"""Registered queries of this package and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm import (
    byte_bpe, disclosure, factor_quality, lang_crf, line_blocks, line_spread, lsh_forest, periodic_runs, prefix_trie, quality_rules,
    template_leaks, token_index, warc)
from gaugeline.llm.tables import load, stored

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template_leaks.leaks(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(load(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op3_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_blocks.main_text(load(spark, sf_dir, "pages"))


def op4_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "source")
    cleaned = line_spread.remove_boilerplate(docs, rules=line_spread.PRODUCTION)
    return cleaned.select("doc_id", "text", F.col("_n_lines").alias("n_lines"), F.col("_n_removed").alias("n_removed"))


def _remainder(n: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op5_lang_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    field = lang_crf.fit_on(docs.filter(_remainder(4) != 2))
    found = lang_crf.predict(docs.select("doc_id", "text"), field)
    return found.select("doc_id", F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op6_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(load(spark, sf_dir, "documents"))


def op7_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.personal_data(load(spark, sf_dir, "documents"))


def op8_token_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_index.write_and_read(load(spark, sf_dir, "documents"), TOKENIZER)


def op9_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(load(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select("doc_id", *quality_rules.STATS, "base_failed", "kept", "p_good")


def op10_factor_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    labels = load(spark, sf_dir, "labels").select("doc_id", "quality").filter(_remainder(5) != 0)
    found = factor_quality.score(docs, factor_quality.fit(factor_quality.sample(docs, labels)))
    return found.select("doc_id", F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    files = warc.write_archives(warc.with_revisits(pages))
    captures = warc.assemble(stored(warc.read_records(files, payloads=False), "records"))
    return captures.select(
        warc.key_of("key").cast(kind).alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.type").alias("record_type"),
        warc.key_of("refers-to").cast(kind).alias("refers_to"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id and turns (digest and bytes of each): the first h turns of conversation c - c % 5, then c's own after its first h,
    h = crc32(c) % 9. Turns of one conversation stand by number (null first), those of one number by digest."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turn = F.struct("turn", prefix_trie.element_digest(role, text).alias("digest"), F.octet_length(text).cast("long").alias("weight"))
    own = conversations.filter("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("own"))
    own = stored(own, "conversations")
    heads = own.filter("conv_id % 5 = 0").select(F.col("conv_id").alias("base"), F.slice("own", 1, 8).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    both = own.select("conv_id", "own", h.alias("h"), F.expr("conv_id - conv_id % 5").alias("base")).join(heads, "base", "left")
    head = F.slice(F.coalesce("head", F.expr("slice(own, 1, 0)")), F.lit(1), F.col("h"))
    return both.select("conv_id", F.concat(head, F.slice("own", F.col("h") + 1, F.greatest(F.size("own"), F.lit(1)))).alias("turns"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie.prefix_trie(rebuilt(load(spark, sf_dir, "conversations")), "conv_id", "turns")
    return nodes.select(F.col("key").alias("conv_id"), "depth", F.col("parent_key").alias("parent_conv_id"), F.col("n_members").alias("n_convs"),
                        "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text; with h = crc32(doc_id) and g = h / 10, every text of h % 10 = 0 repeats itself from word g % n on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"),
                        F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))).alias("words"))
    n = F.size("words")
    begun = words.withColumn("a", F.when(n > 0, (F.col("g") % n).cast("int")))
    begun = begun.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    tail = F.transform(F.sequence("a", n - 1), lambda i: F.get("words", F.col("a") + (i - F.col("a")) % F.col("p")))
    repeated = F.concat_ws(" ", F.slice("words", F.lit(1), F.col("a")), tail)
    return begun.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(with_repeats(load(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    found = found.withColumn("longest", longest)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"), F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))


QUERIES = {
    "op1_template_leaks": op1_template_leaks,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_line_blocks": op3_line_blocks,
    "op4_line_spread": op4_line_spread,
    "op5_lang_crf": op5_lang_crf,
    "op6_lsh_forest": op6_lsh_forest,
    "op7_disclosure": op7_disclosure,
    "op8_token_index": op8_token_index,
    "op9_weak_rules": op9_weak_rules,
    "op10_factor_quality": op10_factor_quality,
    "op11_warc_captures": op11_warc_captures,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE: dict[str, str] = {
    "op4_line_spread": line_spread.SQL,
    "op11_warc_captures": warc.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
}
