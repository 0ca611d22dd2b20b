"""Line deduplication by sorted line hashes and keep bitmaps (operator 9, DataFrame functions only).

Lines become rows of (128-bit hash, document, position), without their text.
Rows are range-partitioned by hash and document and sorted by hash, document
and position, so that a common line's rows spread over several partitions;
each task streams over them, takes the first occurrence in each document and
passes on one partial count and last document per hash (map-side combined).  A row is dropped if its
hash is common and its document is not the last.  Dropped positions come back
per document as a compressed keep bitmap: the runs of kept lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACES = "\t\n\x0b\x0c\r "


def lines_of(text: Column) -> Column:
    """The text split at line feeds; null or empty: one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
                 min_docs: int = 5) -> DataFrame:
    """``id_col``, text hash and ``keep`` of each document that loses lines.

    ``keep`` is the document's bitmap of kept lines, run-length compressed:
    an array of (start, length), lines counted from 0.  Keys of at least
    ``min_chars`` code points found in at least ``min_docs`` documents lose
    all their lines except in the largest id holding them.  Rows with a null
    id count together as one document that is smaller than all others;
    repeated rows of one id count as one document, and rows that differ only
    in their text are told apart by the text's hash.
    """
    lines = F.filter(F.transform(lines_of(F.col(text_col)), lambda line, at: F.struct(
        F.btrim(line, F.lit(SPACES)).alias("line"), at.alias("at"))), lambda x: F.length(x["line"]) >= min_chars)
    rows = (docs.where(F.length(text_col) >= min_chars)
            .select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("text_hash"), F.explode(lines).alias("x"))
            .select("doc", "text_hash", F.translate("x.line", UPPER, LOWER).alias("key"), F.col("x.at").alias("at"))
            .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "text_hash", "at"))
    rows = staged(rows, "line-hashes")
    spread = rows.repartitionByRange("h1", "h2", "doc").sortWithinPartitions("h1", "h2", "doc", "at")
    # Partitions and order are the window's own, so each task streams over its sorted rows.
    first = F.row_number().over(Window.partitionBy("h1", "h2", "doc").orderBy("at"))
    holders = spread.withColumn("nth", first).where("nth = 1").select("h1", "h2", "doc")
    common = (holders.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("holders"), F.max("doc").alias("last"))
              .where(F.col("holders") >= min_docs).select("h1", "h2", "last"))
    common = staged(common, "line-common")  # a plain table, so that a common line's rows are split in the join
    dropped = (rows.join(common, ["h1", "h2"]).where(~F.col("doc").eqNullSafe(F.col("last")))
               .groupBy("doc", "text_hash").agg(F.sort_array(F.collect_set("at")).alias("gone")))
    return dropped.select(F.col("doc").alias(id_col), "text_hash", "gone")


def kept_runs(gone: Column, n_lines: Column) -> Column:
    """Runs (start, length) of lines 0 .. n_lines - 1 that are not in the sorted array ``gone``."""
    before = F.concat(F.array(F.lit(-1)), gone)
    after = F.concat(gone, F.array(n_lines))
    runs = F.zip_with(before, after, lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("length")))
    return F.filter(runs, lambda r: r["length"] > 0)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40,
                min_docs: int = 5, prefix: str = "") -> DataFrame:
    """``docs`` with ``prefix`` n_lines, n_dropped, keep (bitmap runs; null: all kept) and kept_text.

    The kept lines are joined by line feeds; where all go, the text is empty.
    Null texts count as one empty line.  Columns of ``docs`` with such names
    are replaced.
    """
    names = {k: prefix + k for k in ("n_lines", "n_dropped", "keep", "kept_text")}
    docs = docs.drop(*names.values())
    doc, hash_, gone_ = fresh(docs, "_line_doc", "_line_hash", "_line_gone")
    gone = keep_bitmaps(docs.select(id_col, text_col), id_col, text_col, min_chars, min_docs).select(
        F.col(id_col).alias(doc), F.col("text_hash").alias(hash_), F.col("gone").alias(gone_))
    joined = docs.join(gone, F.col(id_col).eqNullSafe(F.col(doc)) & (F.xxhash64(text_col) == F.col(hash_)), "left")
    lines, text = lines_of(F.col(text_col)), F.coalesce(F.col(text_col), F.lit(""))
    n_lines = F.size(lines)
    keep = F.when(F.col(gone_).isNotNull(), kept_runs(F.col(gone_), n_lines))
    # The one-element array holds the split text, so that it is split once and not for every run.
    kept = F.transform(F.array(lines), lambda all_lines: F.array_join(F.flatten(F.transform(
        keep, lambda r: F.slice(all_lines, r["start"] + 1, r["length"]))), "\n"))
    kept = F.when(F.col(gone_).isNotNull(), kept[0])
    return joined.select(*docs.columns, n_lines.cast("long").alias(names["n_lines"]),
                         F.coalesce(F.size(gone_), F.lit(0)).cast("long").alias(names["n_dropped"]),
                         keep.alias(names["keep"]), F.coalesce(kept, text).alias(names["kept_text"]))
