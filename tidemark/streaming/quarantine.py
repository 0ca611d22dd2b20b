"""Bad messages set aside: one pass writes decoded records and quarantined messages.

A batch is decoded once and written once, in a folder of its own that a replay
replaces as a whole; ``status`` folders in it part good rows from bad ones, so
a reader of either never opens the other's files.  Counts by reason are
observed while the batch is written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.schema import LABEL_COL, METRIC_COLS
from tidemark.sources.records import BAD_REASONS, OFFSET_COL, classify_records
from tidemark.streaming.sinks import write_batch

STATUS_COL = "status"
DECODED, QUARANTINED = "decoded", "quarantined"


def write_split(classified: DataFrame, path: str, batch_id: int) -> dict[str, int]:
    """Write one batch of ``classify_records`` rows; rows by reason (``decoded``: the good ones).

    ``path`` gets ``batch_id=<b>/status=<decoded|quarantined>``, replay-safe.
    Every reason is in the counts, with 0 if no row has it.  A task holds a
    file of either status open, so no row is sorted and its memory does not
    grow with its rows.
    """
    seen = Observation()
    counts = [F.count_if(F.col("reason").isNull()).alias(DECODED),
              *[F.count_if(F.col("reason") == F.lit(r)).alias(r) for r in BAD_REASONS]]
    status = F.when(F.col("reason").isNull(), F.lit(DECODED)).otherwise(F.lit(QUARANTINED))
    write_batch(classified.observe(seen, *counts).withColumn(STATUS_COL, status), path, batch_id, [STATUS_COL],
                open_files=2)
    return {k: seen.get[k] for k in (DECODED, *BAD_REASONS)}


def start_record_split_stream(messages: DataFrame, path: str, checkpoint: str, metrics: Sequence[str] = METRIC_COLS,
                              label: str = LABEL_COL, keep: Sequence[str] = (OFFSET_COL,), trigger_seconds: int = 60,
                              available_now: bool = False,
                              on_counts: Callable[[int, dict[str, int]], None] | None = None) -> StreamingQuery:
    """Split a message stream below ``path``; ``on_counts(batch_id, counts)`` is called after each batch (again on replay)."""
    def each(batch: DataFrame, batch_id: int) -> None:
        counts = write_split(classify_records(batch, metrics, label, keep), path, batch_id)
        if on_counts is not None:
            on_counts(batch_id, counts)

    how = {"availableNow": True} if available_now else {"processingTime": f"{trigger_seconds} seconds"}
    return (messages.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**how).start())


def _read(spark: SparkSession, path: str, status: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col(STATUS_COL) == F.lit(status)).drop(STATUS_COL)


def read_decoded(spark: SparkSession, path: str) -> DataFrame:
    """All good records written so far, with their ``batch_id``."""
    return _read(spark, path, DECODED).drop("value", "reason")


def read_quarantine(spark: SparkSession, path: str, metrics: Sequence[str] = METRIC_COLS) -> DataFrame:
    """All quarantined messages written so far: label, kept columns, ``value``, ``reason``, ``batch_id``."""
    return _read(spark, path, QUARANTINED).drop(*metrics)
