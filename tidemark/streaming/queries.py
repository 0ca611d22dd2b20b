"""Registered streaming queries.

Each query copies ``events`` into a handful of time-range files (data Spark
derives from the table, so the work grows with it), streams them a few files
per micro-batch with ``availableNow``, and returns the final state of the
sink as a batch DataFrame.  The oracle is the batch SQL of the same operator:
stream = batch.  File modification times of one write are nearly equal, so
files may be picked in any order; the allowed lateness covers the whole table
so that no row is late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.catalog import (
    SQL_MA_PER_SERIES,
    SQL_RECORD_SPLIT,
    _wma_sql_per_user,
    SQL_SLIDING_AVG,
    SQL_SLIDING_COUNT,
    Query,
    _window_model_sql,
    line_messages,
    rounded,
    rounded_sql,
)
from tidemark.session import scratch_path
from tidemark.sources.records import decode_records
from tidemark.sources.tables import table
from tidemark.streaming.daily import CompactingDailySink, read_daily
from tidemark.streaming.jobs import (
    file_stream,
    start_dynamic_threshold_job,
    start_sliding_aggregate_stream,
    start_threshold_stream,
    start_window_count_stream,
)
from tidemark.streaming.keyed import start_keyed_latest_n_stream
from tidemark.streaming.quarantine import read_quarantine, start_record_split_stream
from tidemark.streaming.sinks import read_latest, write_daily
from tidemark.streaming.window_state import start_window_state_stream

N_FILES = 8
FILES_PER_BATCH = 2
LATENESS_S = 40 * 86400
#: Lateness of the queries that write closed windows (their files come in time order).
CLOSED_DELAY_S = 6 * 3600


# Time-range copies of events already written in this Spark application, by
# table folder: the queries only read them, so one copy serves them all.
_EVENT_FILES: dict[tuple[str, str], str] = {}


def _event_files(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    ev = table(spark, sf, "events")
    key = (spark.sparkContext.applicationId, sf)
    if key not in _EVENT_FILES:
        path = f"{scratch_path(spark, 'events-by-time')}/input"
        ev.repartitionByRange(N_FILES, "ts").write.mode("overwrite").parquet(path)
        _EVENT_FILES[key] = path
    return _EVENT_FILES[key], ev


def _stream(spark: SparkSession, sf: str, name: str):
    root = scratch_path(spark, name)
    path, ev = _event_files(spark, sf)
    src = file_stream(spark, path, ev.schema, max_files_per_trigger=FILES_PER_BATCH)
    return root, src


def q_stream_window_wma(spark: SparkSession, sf: str) -> DataFrame:
    root, src = _stream(spark, sf, "stream_window_wma")
    q = start_threshold_stream(src, "WMA", ["value"], "event_id", 20, f"{root}/out", f"{root}/ckpt",
                               ["event_type"], window=(21600, 3600), time_col="ts", delay_s=LATENESS_S,
                               label_col="ts", available_now=True)
    q.awaitTermination()
    return rounded(read_latest(spark, f"{root}/out", ["event_type", "window_start", "window_end"]))


def q_stream_latest_n_ma(spark: SparkSession, sf: str) -> DataFrame:
    root, src = _stream(spark, sf, "stream_latest_n_ma")
    q = start_threshold_stream(src, "MA", ["value"], "event_id", 20, f"{root}/out", f"{root}/ckpt",
                               ["user_id"], label_col="ts", available_now=True)
    q.awaitTermination()
    return rounded(read_latest(spark, f"{root}/out", ["user_id"]))


def _daily_writer(df, path, batch_id):
    write_daily(df, path, batch_id, time_col="create_date")


def q_stream_daily_sink(spark: SparkSession, sf: str) -> DataFrame:
    root, src = _stream(spark, sf, "stream_daily_sink")
    q = start_threshold_stream(src, "MA", ["value"], "event_id", 20, f"{root}/out", f"{root}/ckpt",
                               ["user_id"], label_col="ts", available_now=True, writer=_daily_writer)
    q.awaitTermination()
    return rounded(read_latest(spark, f"{root}/out", ["user_id"]))


def q_stream_sliding_count(spark: SparkSession, sf: str) -> DataFrame:
    root, src = _stream(spark, sf, "stream_sliding_count")
    q = start_window_count_stream(src, "ts", 1200, 60, f"{root}/out", f"{root}/ckpt",
                                  delay_s=LATENESS_S, available_now=True)
    q.awaitTermination()
    return read_latest(spark, f"{root}/out", ["window_start", "window_end"])


def _event_records(spark: SparkSession, sf: str, path: str) -> DataFrame:
    """Events as metric messages: label = event time text, value = the metric, offset = event id."""
    ev = table(spark, sf, "events")
    recs = ev.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("key"),
                     F.col("value").cast("string").alias("value"),
                     F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"))
    recs.repartitionByRange(N_FILES, "timestamp").write.mode("overwrite").parquet(path)
    return recs


def q_stream_record_job(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job: messages -> 20-minute windows every minute -> newest 20 -> decode -> WMA."""
    root = scratch_path(spark, "stream_record_job")
    recs = _event_records(spark, sf, f"{root}/input")
    src = file_stream(spark, f"{root}/input", recs.schema, max_files_per_trigger=FILES_PER_BATCH)
    q = start_dynamic_threshold_job(src, f"{root}/out", f"{root}/ckpt", model=" WMA", n=20, slide_minutes=1,
                                    metrics=["value"], time_col="timestamp", delay_s=LATENESS_S,
                                    available_now=True, daily_time_col="window_end",
                                    processing_stamp=False,  # @timestamp is wall-clock: no oracle value
                                    emit="update")           # every window, compared with batch
    q.awaitTermination()
    return rounded(read_latest(spark, f"{root}/out", ["window_start", "window_end"]))


SQL_STREAM_RECORD_JOB = (
    "SELECT *, 'poc_os_metric_dt_' || strftime(window_end, '%Y_%m_%d') AS index_name "
    f"FROM ({_window_model_sql('WMA', 1200, 60, 20, [])}) w")

def q_stream_sliding_avg(spark: SparkSession, sf: str) -> DataFrame:
    root, src = _stream(spark, sf, "stream_sliding_avg")
    src = src.withColumn("cents", F.round(F.col("value") * 100).cast("long"))  # exact sums, see sliding_avg
    q = start_sliding_aggregate_stream(src, "ts", 3600, 600, f"{root}/out", f"{root}/ckpt", ["cents"],
                                       ["event_type"], delay_s=LATENESS_S, available_now=True)
    q.awaitTermination()
    return rounded(read_latest(spark, f"{root}/out", ["event_type", "window_start", "window_end"]))


def q_stream_sliding_count_closed(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per closed window, from panes (two chained stateful aggregations)."""
    root = scratch_path(spark, "stream_sliding_count_closed")
    src = _in_time_order(spark, table(spark, sf, "events"), "ts", f"{root}/input")
    q = start_window_count_stream(src, "ts", 1200, 60, f"{root}/out", f"{root}/ckpt", delay_s=CLOSED_DELAY_S,
                                  available_now=True, emit="closed")
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("batch_id")


def q_stream_sliding_avg_closed(spark: SparkSession, sf: str) -> DataFrame:
    """Aggregates of closed windows per event type, from panes."""
    root = scratch_path(spark, "stream_sliding_avg_closed")
    src = _in_time_order(spark, table(spark, sf, "events"), "ts", f"{root}/input")
    src = src.withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    q = start_sliding_aggregate_stream(src, "ts", 3600, 600, f"{root}/out", f"{root}/ckpt", ["cents"], ["event_type"],
                                       delay_s=CLOSED_DELAY_S, available_now=True, emit="closed")
    q.awaitTermination()
    return rounded(spark.read.parquet(f"{root}/out").drop("batch_id"))


def _closed_sql(inner: str) -> str:
    return (f"SELECT * FROM ({inner}) w WHERE window_end <= (SELECT date_trunc('milliseconds', max(ts)) "
            f"- INTERVAL '{CLOSED_DELAY_S} seconds' FROM events)")


def q_stream_daily_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Updated thresholds in daily folders that are compacted as batches go by; the newest row per key and day."""
    root, src = _stream(spark, sf, "stream_daily_compacted")
    sink = CompactingDailySink(["event_type", "window_start"], "window_start", max_deltas=2)
    q = start_threshold_stream(src, "MA", ["value"], "event_id", 20, f"{root}/out", f"{root}/ckpt", ["event_type"],
                               window=(21600, 3600), time_col="ts", delay_s=LATENESS_S, label_col="ts",
                               available_now=True, writer=sink)
    q.awaitTermination()
    return rounded(read_daily(spark, f"{root}/out", ["event_type", "window_start"]))


SQL_STREAM_DAILY_COMPACTED = (
    "SELECT *, 'poc_os_metric_dt_' || strftime(window_start, '%Y_%m_%d') AS index_name "
    f"FROM ({_window_model_sql('MA', 21600, 3600, 20, ['event_type'])}) w")


def q_stream_keyed_wma(spark: SparkSession, sf: str) -> DataFrame:
    """Per-user banded WMA of the newest 20 events on the keyed state store."""
    root, src = _stream(spark, sf, "stream_keyed_wma")
    q = start_keyed_latest_n_stream(src, "WMA", ["value"], "event_id", 20, ["user_id"], f"{root}/out",
                                    f"{root}/ckpt", label_col="ts", available_now=True)
    q.awaitTermination()
    return rounded(read_latest(spark, f"{root}/out", ["user_id"]))


def q_stream_latest_n_null_series(spark: SparkSession, sf: str) -> DataFrame:
    """Latest-N thresholds of a series column that holds nulls."""
    root, src = _stream(spark, sf, "stream_latest_n_null_series")
    src = src.withColumn("grp", F.nullif(F.col("user_id") % 5, F.lit(0)))
    q = start_threshold_stream(src, "MA", ["value"], "event_id", 20, f"{root}/out", f"{root}/ckpt",
                               ["grp"], label_col="ts", available_now=True)
    q.awaitTermination()
    return rounded(read_latest(spark, f"{root}/out", ["grp"]))


SQL_STREAM_LATEST_N_NULL_SERIES = rounded_sql("""
SELECT grp, avg(value) AS dt_value, max(ts) AS create_date
FROM (SELECT *, NULLIF(user_id % 5, 0) AS grp FROM events
      QUALIFY row_number() OVER (PARTITION BY NULLIF(user_id % 5, 0) ORDER BY event_id DESC) <= 20) t
GROUP BY grp""", ["dt_value"])


def q_stream_keyed_wma_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed WMA of a metric that is null for two thirds of the users."""
    root, src = _stream(spark, sf, "stream_keyed_wma_nulls")
    src = src.withColumn("value", F.when(F.col("user_id") % 3 == 0, F.col("value")))
    q = start_keyed_latest_n_stream(src, "WMA", ["value"], "event_id", 20, ["user_id"], f"{root}/out",
                                    f"{root}/ckpt", label_col="ts", available_now=True)
    q.awaitTermination()
    return rounded(read_latest(spark, f"{root}/out", ["user_id"]))


SQL_STREAM_KEYED_WMA_NULLS = _wma_sql_per_user(20).replace(
    "sum(value ", "sum(CASE WHEN user_id % 3 = 0 THEN value END ")


def _in_time_order(spark: SparkSession, rows: DataFrame, time_col: str, path: str) -> DataFrame:
    """Stream of ``rows``, one file per micro-batch, written (and so read) in time order."""
    first, last = rows.agg(F.min(time_col), F.max(time_col)).first()
    step = (last - first) / N_FILES
    for i in range(N_FILES):
        part = rows.where(F.col(time_col) >= F.lit(first + i * step).cast("timestamp_ntz"))
        if i + 1 < N_FILES:
            part = part.where(F.col(time_col) < F.lit(first + (i + 1) * step).cast("timestamp_ntz"))
        part.coalesce(1).write.mode("append").parquet(path)
    return file_stream(spark, path, rows.schema, max_files_per_trigger=1)


def _records_in_time_order(spark: SparkSession, sf: str, root: str) -> DataFrame:
    """Stream of events as messages, in time order."""
    ev = table(spark, sf, "events")
    recs = ev.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("key"),
                     F.col("value").cast("string").alias("value"),
                     F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"))
    return _in_time_order(spark, recs, "timestamp", f"{root}/input")


def q_stream_record_job_closed(spark: SparkSession, sf: str) -> DataFrame:
    """The job's default emission: every window once, when the watermark has passed its end."""
    root = scratch_path(spark, "stream_record_job_closed")
    src = _records_in_time_order(spark, sf, root)
    q = start_dynamic_threshold_job(src, f"{root}/out", f"{root}/ckpt", model="WMA", n=20, slide_minutes=1,
                                    metrics=["value"], delay_s=CLOSED_DELAY_S, available_now=True,
                                    daily_time_col="window_end", processing_stamp=False)
    q.awaitTermination()
    return rounded(spark.read.parquet(f"{root}/out").drop("batch_id"))


SQL_STREAM_RECORD_JOB_CLOSED = (
    f"SELECT * FROM ({SQL_STREAM_RECORD_JOB}) j WHERE window_end <= (SELECT date_trunc('minute', max(ts)) "
    f"+ INTERVAL '{60 - CLOSED_DELAY_S} seconds' FROM events)")

def q_stream_window_state(spark: SparkSession, sf: str) -> DataFrame:
    """The same windows on the keyed state store, closed by event-time timers; messages decoded once ranked."""
    root = scratch_path(spark, "stream_window_state")
    src = _records_in_time_order(spark, sf, root)

    def decode(ranked: DataFrame) -> DataFrame:
        return decode_records(ranked, ["value"], keep=("window_start", "window_end", "__rank"))

    def daily(df: DataFrame, path: str, batch_id: int) -> None:
        write_daily(df, path, batch_id, "window_end")

    q = start_window_state_stream(src, "WMA", ["value"], "offset", 20, (1200, 60), "timestamp", f"{root}/out",
                                  f"{root}/ckpt", delay_s=CLOSED_DELAY_S, label_col="create_date",
                                  payload=["key", "value"], prepare=decode, writer=daily, available_now=True)
    q.awaitTermination()
    return rounded(spark.read.parquet(f"{root}/out").drop("batch_id"))


def q_stream_window_state_series(spark: SparkSession, sf: str) -> DataFrame:
    """Closed windows of a series column that holds nulls, on the keyed state store."""
    root = scratch_path(spark, "stream_window_state_series")
    path, ev = _event_files(spark, sf)
    src = file_stream(spark, path, ev.schema)
    src = src.withColumn("grp", F.nullif(F.col("user_id") % 5, F.lit(0)))
    q = start_window_state_stream(src, "MA", ["value"], "event_id", 20, (21600, 3600), "ts", f"{root}/out",
                                  f"{root}/ckpt", ["grp"], delay_s=CLOSED_DELAY_S, label_col="ts", available_now=True)
    q.awaitTermination()
    return rounded(spark.read.parquet(f"{root}/out").drop("batch_id"))


SQL_STREAM_WINDOW_STATE_SERIES = (
    "SELECT * FROM (" + _window_model_sql("MA", 21600, 3600, 20, ["grp"]).replace(
        "FROM events", "FROM (SELECT *, NULLIF(user_id % 5, 0) AS grp FROM events) g")
    + ") w WHERE window_end <= (SELECT date_trunc('hour', max(ts)) + "
    f"INTERVAL '{3600 - CLOSED_DELAY_S} seconds' FROM events)")

SQL_STREAM_DAILY_SINK = (
    "SELECT *, 'poc_os_metric_dt_' || strftime(create_date, '%Y_%m_%d') AS index_name "
    f"FROM ({SQL_MA_PER_SERIES}) m")


def q_stream_record_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Messages that a stream of line items sets aside, beside the decoded ones."""
    root = scratch_path(spark, "stream_record_quarantine")
    # by hash: a round-robin shuffle would sort each task's messages first
    line_messages(spark, sf).repartition(N_FILES, "key", "value", "offset").write.parquet(f"{root}/input")
    src = file_stream(spark, f"{root}/input", line_messages(spark, sf).schema, max_files_per_trigger=FILES_PER_BATCH)
    start_record_split_stream(src, f"{root}/out", f"{root}/ckpt", available_now=True).awaitTermination()
    return read_quarantine(spark, f"{root}/out").select("create_date", "offset", "reason")


SQL_STREAM_RECORD_QUARANTINE = f"SELECT create_date, \"offset\", reason FROM ({SQL_RECORD_SPLIT}) r WHERE reason IS NOT NULL"


STREAM_QUERIES: list[Query] = [
    Query("stream_record_quarantine", ("S3", "S4", "S5", "W4"), q_stream_record_quarantine, SQL_STREAM_RECORD_QUARANTINE),
    Query("stream_window_wma", ("W1", "W2", "W3", "W4", "W5", "A2"), q_stream_window_wma,
          _window_model_sql("WMA", 21600, 3600, 20, ["event_type"])),
    Query("stream_latest_n_ma", ("S2", "W3", "W4", "T2", "A1"), q_stream_latest_n_ma, SQL_MA_PER_SERIES),
    Query("stream_daily_sink", ("K1", "E7", "W4"), q_stream_daily_sink, SQL_STREAM_DAILY_SINK),
    Query("stream_sliding_count", ("A5", "W2", "W1"), q_stream_sliding_count, SQL_SLIDING_COUNT),
    Query("stream_sliding_avg", ("W1", "W2", "W4"), q_stream_sliding_avg, SQL_SLIDING_AVG),
    Query("stream_keyed_wma", ("W3", "W4", "T2", "T3", "A2"), q_stream_keyed_wma, _wma_sql_per_user(20)),
    Query("stream_record_job", ("S3", "S4", "S5", "W1", "W2", "W5", "T1", "T3", "A2", "E3", "K1", "M7"),
          q_stream_record_job, SQL_STREAM_RECORD_JOB),
    Query("stream_record_job_closed", ("S3", "S4", "S5", "W1", "W2", "W3", "W4", "W5", "A2", "K1"),
          q_stream_record_job_closed, SQL_STREAM_RECORD_JOB_CLOSED),
    Query("stream_sliding_count_closed", ("A5", "W2", "W4"), q_stream_sliding_count_closed,
          _closed_sql(SQL_SLIDING_COUNT)),
    Query("stream_sliding_avg_closed", ("W2", "W4"), q_stream_sliding_avg_closed, _closed_sql(SQL_SLIDING_AVG)),
    Query("stream_daily_compacted", ("K1", "E7", "W2", "W5"), q_stream_daily_compacted, SQL_STREAM_DAILY_COMPACTED),
    Query("stream_window_state", ("W2", "W3", "W4", "W5", "S4", "A2", "K1"), q_stream_window_state,
          SQL_STREAM_RECORD_JOB_CLOSED),
    Query("stream_window_state_series", ("W2", "W3", "W5", "A1"), q_stream_window_state_series,
          SQL_STREAM_WINDOW_STATE_SERIES),
    Query("stream_latest_n_null_series", ("W3", "W4", "T2", "A1"), q_stream_latest_n_null_series,
          SQL_STREAM_LATEST_N_NULL_SERIES),
    Query("stream_keyed_wma_nulls", ("W3", "W4", "T2", "A2"), q_stream_keyed_wma_nulls, SQL_STREAM_KEYED_WMA_NULLS),
]
