"""Registered queries of this package, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann, line_dedup, mixing, near_dedup, packing, prefix_trie, quality, resharding, spelling, substring_dedup, token_files,
    url_filter, warc,
)
from .common import tables, text_or_empty
from .oracles import ORACLES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(tables(spark, sf_dir, "documents")).select("block", "place", "copy", "doc_id", "source", "tokens")


@query
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(tables(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", F.col("first").alias("kept"), "similar")


@query
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(tables(spark, sf_dir, "documents"), path, end_id=0)


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substring_dedup.remove_repeats(tables(spark, sf_dir, "documents"), substring_dedup.Repeats(length=20))
    return left.select("doc_id", F.col("__words").alias("n_words"), F.col("__removed").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


@query
def op5_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.write_and_read(tables(spark, sf_dir, "pages"))


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(tables(spark, sf_dir, "documents"))
    return judged.select("doc_id", *quality.METRICS, "base_failed", "kept")


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = line_dedup.dedup_lines(tables(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return left.select(
        "doc_id", F.col("__lines").alias("n_lines"), F.col("__dropped").alias("n_dropped"), F.sha2(text_or_empty(), 256).alias("kept_sha256")
    )


#: The rules of the URL query, as verdict, host and path.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(tables(spark, sf_dir, "pages"), url_filter.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("distrust", 6).alias("distrust"))


@query
def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(tables(spark, sf_dir, "embeddings"), ann.Search(k=20, every=20))


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_files.write_and_read(tables(spark, sf_dir, "documents"), path, end_id=1).drop("shard")


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(tables(spark, sf_dir, "conversations"))


@query
def op12_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resharding.grow(tables(spark, sf_dir, "documents"), before=6, after=8)
    text = F.coalesce(F.col(f"{resharding.ROW}.text"), F.lit(""))
    return rows.select(
        F.col(f"{resharding.ROW}.doc_id").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "moved",
    )


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(tables(spark, sf_dir, "documents"))
