"""A training corpus from raw documents: quality rules, line dedup, near-duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir), calls one operator of ``tidemark.llm``
on all rows its predecessor kept, and returns a DataFrame; all but the last
return the columns of ``documents``.  Stages are joined by Parquet tables below
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, lines, mixing, packing, quality
from tidemark.llm.common import fresh_prefix, read_table, staged

TOKENIZER = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs of their language."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def _with_text(docs: DataFrame, new: DataFrame, text: F.Column) -> DataFrame:
    """The columns of ``docs`` from ``new``, with another text and its length."""
    columns = {"text": text, "n_chars": F.length(text).cast("long")}
    return new.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that other documents keep."""
    prefix = fresh_prefix(docs, "_line_")
    return _with_text(docs, lines.dedup_lines(docs, prefix=prefix), F.col(f"{prefix}kept_text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0 to 3 times)."""
    return mixing.repeat_rows(docs, mixing.word_count(F.col("text")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: the pieces of all documents."""
    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix),
    ("pack_sequences", pack),
]

#: Certified cutoffs, connected components and tokenizers are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
