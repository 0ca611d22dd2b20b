"""Registered queries: each operator over its whole table, and its DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment, counts, embeddings, jaccard, lines, mixing, packing, pii, quality, ring, substrings, urls, whitening)
from tidemark.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "stratum", "failed_rules")


#: Rules of the url query (host, path, verdict).
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


@query
def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, URL_RULES))} AS rules(host, path, verdict)")
    return urls.match_rules(read_table(spark, sf_dir, "pages"), rules)


ORACLES["op8_url_rules"] = f"""
WITH rules(rhost, rpath, rverdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1) AS h,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
named AS (
  SELECT page_id, translate(h, '{urls.UPPER}', '{urls.LOWER}') AS host, path FROM split),
best AS (
  SELECT n.host, n.path, max_by(r.rhost || r.rpath, length(r.rhost || r.rpath)) AS rule,
         max_by(r.rverdict, length(r.rhost || r.rpath)) AS verdict
  FROM (SELECT DISTINCT host, path FROM named) n
  JOIN rules r ON (n.host = r.rhost OR ends_with(n.host, '.' || r.rhost)) AND starts_with(n.path, r.rpath)
  GROUP BY 1, 2)
SELECT n.page_id, n.host, n.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
FROM named n LEFT JOIN best b ON n.host = b.host AND n.path = b.path
"""


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


_SPACES = "||".join(f"chr({ord(c)})" for c in lines.SPACES)
ORACLES["op9_line_dedup"] = f"""
WITH numbered AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM numbered),
keyed AS (SELECT *, translate(trim(line, {_SPACES}), '{lines.UPPER}', '{lines.LOWER}') AS k FROM lines),
common AS (SELECT k, max(doc_id) AS last_doc FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT y.*, c.k IS NOT NULL AND y.doc_id <> c.last_doc AS gone FROM keyed y LEFT JOIN common c ON y.k = c.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix_sources(docs, mixing.word_count(F.col("text")))
    return mixed.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op7_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = ring.assign_shards(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op2_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset", "sequence_cost")


@query
def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"),
                        pii.as_text(F.col("spans")).alias("spans"))


@query
def op6_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(read_table(spark, sf_dir, "documents"))


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = substrings.remove_repeats(read_table(spark, sf_dir, "documents"))
    return stripped.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                           F.sha2("kept", 256).alias("kept_sha256"))


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


@query
def op12_align_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
