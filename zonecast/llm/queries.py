"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm import (bloom_cascade, chat_format, fixity, license_scan, mixing, page_diff, pu_quality,
                          simhash, suffix_arrays, token_alignment, toxicity, tree_dedup, whitening)
from zonecast.llm.common import read, staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_schema_fingerprint_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted and read back, and conversation -7, whose
    texts look like control strings. Two thirds of them come as JSON records of
    four other layouts; each record's mapping is picked by its fingerprint."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], rows.schema)
    rows = rows.unionByName(more)
    as_rows = F.pmod(F.xxhash64("conv_id"), F.lit(3)) == 0
    records = chat_format.as_records(rows.where(~as_rows))
    turns = chat_format.canonical_turns(rows.where(as_rows)).select("conv_id", "turns").unionByName(
        chat_format.canonical_json(records, "record", ["conv_id"]).select("conv_id", "turns"))
    return chat_format.digests(chat_format.format_turns(turns, ["conv_id"]), ["conv_id"])


@query
def op2_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of two replicas of all pages as WARC records. The second one is a
    stand-in for a damaged copy: by id, some records have a changed byte, some
    are cut short and some are lost."""
    records = staged(fixity.warc_records(read(spark, sf_dir, "pages")), "records")
    mark = F.conv(F.substring(F.md5(F.col("page_id").cast("string").cast("binary")), 1, 4),
                  16, 10).cast("int") % 100
    content = F.col("content")
    damaged = (F.when(mark == 1, F.overlay(content, F.lit("#").cast("binary"), F.lit(5)))
               .when(mark == 2, F.substring(content, 1, 40)).otherwise(content))
    copy = records.where(mark != 3).withColumn("content", damaged)
    return fixity.audit(records, copy)


@query
def op3_suffix_array_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word windows of the benchmark in all documents."""
    return suffix_arrays.contamination(read(spark, sf_dir, "documents"),
                                       read(spark, sf_dir, "benchmark"))


@query
def op4_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages, and how many lines differencing and markup
    deleted."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    texts = page_diff.extract(pages, ["page_id", "url"])
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"),
                        "n_shared", "n_marked")


@query
def op5_simhash_pivot_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    rows = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                       "component_id")


# Verdict, host, start of the path
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"),
             ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
             ("block", "com", "/de/")]


@query
def op6_bloom_cascade_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules' verdict on the url of all pages."""
    return bloom_cascade.judge(read(spark, sf_dir, "pages"), URL_RULES, ["page_id"])


@query
def op7_tree_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates; the row with the largest doc_id stays."""
    groups = tree_dedup.duplicate_groups(read(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept",
                         F.lower(F.hex("digest")).alias("text_sha256"))


def _judged(scored: DataFrame, folds: int, fold: int) -> DataFrame:
    return scored.select("doc_id", pu_quality.held_out(F.col("doc_id"), folds, fold).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op8_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learnt without the held-out third."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    learn = ~pu_quality.held_out(F.col("doc_id"), 3, 1)
    model = pu_quality.train(docs.where(learn), read(spark, sf_dir, "labels").where(learn))
    return _judged(pu_quality.scores(docs, model, ["doc_id"]), 3, 1)


@query
def op9_toxicity_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt without the held-out fifth."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    learn = ~pu_quality.held_out(F.col("doc_id"), 5, 0)
    trained = toxicity.train(docs.where(learn), read(spark, sf_dir, "labels").where(learn))
    return _judged(toxicity.scores(docs, trained, ["doc_id"]), 5, 0)


@query
def op10_weighted_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the sources' target weights."""
    return mixing.mix(read(spark, sf_dir, "documents"))


@query
def op11_shifted_cholesky_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened by their first eight components."""
    return whitening.whiten(read(spark, sf_dir, "embeddings"), ["vec_id"], "embedding")


def tokenizer_files() -> tuple[str, str]:
    """Paths of the two vocabularies that are aligned."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@query
def op12_pointer_jumping_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token groups of two tokenizers in all documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return token_alignment.alignment(docs, ["doc_id"], "text", *tokenizer_files())


@query
def op13_diagonal_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return license_scan.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
