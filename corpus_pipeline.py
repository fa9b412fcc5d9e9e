"""Documents to packed training sequences: rules, line and near-duplicate removal, mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import line_dedup, mixing, near_dedup, packing, quality
from millrace.llm.common import shared_table, text_length

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: A stage that adds columns of its own carries the document's in this one, whatever their names.
WHOLE = "__document"


def _packed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(WHOLE))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects, of hosts that are not rejected."""
    own = ("doc_id", "source", "text")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in own]  # without the text, which is stored once
    judged = quality.judge(docs.select(*own, *([F.struct(*others).alias(WHOLE)] if others else []))).filter("kept")
    return judged.select(*[c if c in own else F.col(f"{WHOLE}.`{c}`").alias(c) for c in docs.columns])


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents share are gone; ``n_chars`` follows the text."""
    left = line_dedup.dedup_lines(docs, min_docs=10, min_chars=1).select(*docs.columns)
    return text_length(left)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return near_dedup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight shows them, every one at least once."""
    return mixing.mixed(_packed(docs), carry=(WHOLE,)).select(f"{WHOLE}.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place in it."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("near-duplicate documents", dedup_documents),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: SQL can express neither the sampled near-duplicate search nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = shared_table(docs, f"stage-{k}")
    return docs
