"""Sinks: batch-keyed result files, daily partitions, console and memory.

All file sinks are idempotent per micro-batch: batch ``b`` owns the folder
``<path>/batch_id=<b>`` and overwrites it as a whole, so a batch replayed
after a failure between the write and the checkpoint commit replaces its
first attempt instead of duplicating it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.schema import DAILY_INDEX_PREFIX, DAY_PATTERN

BATCH_COL = "batch_id"


#: Output files a task may hold open; set, Spark parts rows by folder without sorting them.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def write_batch(df: DataFrame, path: str, batch_id: int, partition_cols: Sequence[str] = (),
                open_files: int | None = None) -> None:
    """Write one micro-batch's rows to ``<path>/batch_id=<batch_id>`` (replay-safe).

    The folder is replaced as a whole, whatever the session's overwrite mode:
    a replay may write other partitions (another day) than the first attempt.
    Spark sorts a task's rows by ``partition_cols``, unless ``open_files`` names
    how many of their folders a task writes at once; beyond that it sorts too.
    """
    conf = df.sparkSession.conf
    before = conf.get(OPEN_FILES, None)
    if open_files is not None:
        conf.set(OPEN_FILES, str(open_files))
    try:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_cols).parquet(f"{path.rstrip('/')}/{BATCH_COL}={batch_id}")
    finally:
        if open_files is not None:
            conf.unset(OPEN_FILES) if before is None else conf.set(OPEN_FILES, before)


def daily_partitions(df: DataFrame, time_col: str | None = None,
                     prefix: str = DAILY_INDEX_PREFIX) -> DataFrame:
    """Add ``index_name = prefix + yyyy_MM_dd``.

    The day comes from ``time_col`` (event time, deterministic on replay) or,
    when ``time_col`` is None, from the processing clock like the original job.
    """
    ts: Column = F.col(time_col) if time_col else F.current_timestamp()
    return df.withColumn("index_name", F.concat(F.lit(prefix), F.date_format(ts, DAY_PATTERN)))


def write_daily(df: DataFrame, path: str, batch_id: int, time_col: str | None = None,
                prefix: str = DAILY_INDEX_PREFIX) -> None:
    """Daily-index sink: one folder per ``index_name``, replay-safe per batch."""
    write_batch(daily_partitions(df, time_col, prefix), path, batch_id, ["index_name"])


def read_latest(spark: SparkSession, path: str, key_cols: Sequence[str]) -> DataFrame:
    """Final view of an update-style sink: the last emitted row of every key.

    Each key has at most one row per micro-batch, so the window groups are
    bounded by the number of batches.
    """
    df = spark.read.parquet(path)
    w = Window.partitionBy(*key_cols).orderBy(F.col(BATCH_COL).desc())
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn", BATCH_COL)


def console(df: DataFrame, trigger_seconds: int = 60, output_mode: str = "update") -> StreamingQuery:
    """Print every micro-batch (the job's ``show()`` / ``print()``)."""
    return (df.writeStream.format("console").outputMode(output_mode)
            .option("truncate", False)
            .trigger(processingTime=f"{trigger_seconds} seconds").start())


def memory(df: DataFrame, name: str, output_mode: str = "update") -> StreamingQuery:
    """In-memory table for tests (bounded runs only)."""
    return (df.writeStream.format("memory").queryName(name).outputMode(output_mode)
            .trigger(availableNow=True).start())
