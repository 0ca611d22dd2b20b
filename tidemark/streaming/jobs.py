"""Starting threshold streams: source -> (window) -> latest-N model -> sink.

``start_threshold_stream`` is the streaming form of the whole job: every
micro-batch (``trigger_seconds``, 60 by default) updates the newest-N state
and writes the thresholds of the touched series or windows.  Tests and the
registered queries use ``available_now=True`` for bounded runs; production
calls ``query.awaitTermination()`` to run until stopped.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.weights import DEFAULT_WEIGHTS
from tidemark.streaming.processors import LatestNProcessor, WindowedLatestNProcessor
from tidemark.streaming.sinks import write_batch
from tidemark.streaming.state import DEFAULT_BUCKETS


def file_stream(spark: SparkSession, directory: str, schema, file_glob: str | None = None,
                max_files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Stream the files of ``directory`` (optionally only those matching ``file_glob``)."""
    r = spark.readStream.format(fmt).schema(schema)
    if file_glob:
        r = r.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(directory)


def _start(df: DataFrame, handler, checkpoint: str, trigger_seconds: int, available_now: bool,
           name: str | None) -> StreamingQuery:
    w = df.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()


def start_threshold_stream(
    df: DataFrame,
    model: str,
    metrics: Sequence[str],
    order_by: str | Sequence[str],
    n: int,
    out_path: str,
    checkpoint: str,
    series_cols: str | Sequence[str] = (),
    window: tuple[int, int] | None = None,
    time_col: str | None = None,
    delay_s: int = 3600,
    weights: Sequence[float] = DEFAULT_WEIGHTS,
    label_col: str | None = None,
    trigger_seconds: int = 60,
    available_now: bool = False,
    name: str | None = None,
    writer=write_batch,
    emit: str = "update",
    state_buckets: int = DEFAULT_BUCKETS,
) -> StreamingQuery:
    """Run a latest-N threshold model over a stream; results go to ``out_path``
    (batch-keyed parquet, read the final state with ``sinks.read_latest``).

    ``window=(length_s, slide_s)`` with ``time_col`` computes the model inside
    every sliding event-time window; without it, per series over the stream.
    With a window, ``emit`` is ``"update"`` (rewrite every window that got
    rows) or ``"closed"`` (each window once, when the watermark passes its
    end).  State lives in ``checkpoint/state``, dealt to ``state_buckets``: a batch
    rewrites the buckets it touches, one task each, so give a large cluster
    as many as it has cores (fixed for the life of a checkpoint).
    """
    state = f"{checkpoint.rstrip('/')}/state"
    if window:
        if not time_col:
            raise ValueError("time_col is required with a window")
        proc = WindowedLatestNProcessor(df.schema, state, out_path, time_col, window[0], window[1],
                                        metrics, order_by, n, series_cols, model, weights,
                                        label_col, delay_s, writer=writer, emit=emit, buckets=state_buckets)
    else:
        proc = LatestNProcessor(df.schema, state, out_path, metrics, order_by, n, series_cols,
                                model, weights, label_col, writer=writer, buckets=state_buckets)
    return _start(df, proc, f"{checkpoint.rstrip('/')}/query", trigger_seconds, available_now, name)


def start_sliding_aggregate_stream(
    df: DataFrame,
    time_col: str,
    length_s: int,
    slide_s: int,
    out_path: str,
    checkpoint: str,
    metrics: Sequence[str] = (),
    series_cols: Sequence[str] = (),
    delay_s: int = 3600,
    trigger_seconds: int = 60,
    available_now: bool = False,
    emit: str = "update",
) -> StreamingQuery:
    """Row count and per-metric sum / avg / min / max of every sliding window,
    with Spark's own stateful window aggregation (same columns as the batch
    :func:`tidemark.operators.windows.sliding_aggregate`).

    State per window is a handful of partial aggregates; the watermark
    (``delay_s``) bounds it, and partial aggregation runs before the shuffle.
    ``emit="update"``: every batch writes the windows it changed, and each row
    is copied into its windows.  ``emit="closed"``: two chained stateful
    aggregations, rows into panes of ``gcd(length, slide)`` seconds and closed
    panes into windows, so only pane rows are copied; each window is written
    once, when the watermark has passed its end.  A
    ``timestamp_ntz`` time column is taken as UTC wall-clock time for the
    watermark (which needs zoned timestamps) and converted back, so windows
    match the batch ``window()`` in any session time zone.
    """
    series = list(series_cols)
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    ntz = isinstance(df.schema[time_col].dataType, T.TimestampNTZType)
    if ntz:
        # wall-clock time read as UTC (watermarks need zoned timestamps), so windows
        # align exactly like the batch window() on timestamp_ntz, in any session zone
        ts = F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(time_col)).cast("timestamp")
    else:
        ts = F.col(time_col)
    if emit not in ("update", "closed"):
        raise ValueError("emit must be 'update' or 'closed'")
    timed = (df.select(*series, *[m for m in metrics if m not in series], ts.alias("__et"))
             .withWatermark("__et", f"{delay_s} seconds"))
    length, slide = f"{length_s} seconds", f"{slide_s} seconds"
    if emit == "update":
        aggs = [F.count(F.lit(1)).alias("n_rows")]
        for m in metrics:
            aggs += [F.sum(m).alias(f"{m}_sum"), F.try_divide(F.sum(m), F.count(m)).alias(f"{m}_avg"),
                     F.min(m).alias(f"{m}_min"), F.max(m).alias(f"{m}_max")]
        agg = timed.groupBy(*series, F.window("__et", length, slide).alias("__w")).agg(*aggs)
    else:
        partial, aggs = [F.count(F.lit(1)).alias("__n")], [F.sum("__n").alias("n_rows")]
        for i, m in enumerate(metrics):
            partial += [F.sum(m).alias(f"__s{i}"), F.count(m).alias(f"__c{i}"), F.min(m).alias(f"__lo{i}"),
                        F.max(m).alias(f"__hi{i}")]
            aggs += [F.sum(f"__s{i}").alias(f"{m}_sum"),
                     F.try_divide(F.sum(f"__s{i}"), F.sum(f"__c{i}")).alias(f"{m}_avg"),
                     F.min(f"__lo{i}").alias(f"{m}_min"), F.max(f"__hi{i}").alias(f"{m}_max")]
        pane = F.window("__et", f"{math.gcd(length_s, slide_s)} seconds").alias("__pane")
        panes = timed.groupBy(*series, pane).agg(*partial)
        agg = panes.groupBy(*series, F.window("__pane", length, slide).alias("__w")).agg(*aggs)
    out_cols = [c for c in agg.columns if c not in (*series, "__w")]

    def back(c):
        # window bounds as UTC wall-clock time (timestamp_ntz input) or unchanged
        if not ntz:
            return F.col(c)
        return F.convert_timezone(F.lit(zone), F.lit("UTC"), F.col(c).cast("timestamp_ntz"))

    def handler(batch: DataFrame, batch_id: int) -> None:
        out = batch.select(*series, back("__w.start").alias("window_start"),
                           back("__w.end").alias("window_end"), *out_cols)
        write_batch(out, out_path, batch_id)

    mode = "update" if emit == "update" else "append"
    w = (agg.writeStream.outputMode(mode).foreachBatch(handler)
         .option("checkpointLocation", f"{checkpoint.rstrip('/')}/query"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_seconds} seconds")
    return w.start()


def start_window_count_stream(
    df: DataFrame,
    time_col: str,
    length_s: int,
    slide_s: int,
    out_path: str,
    checkpoint: str,
    delay_s: int = 3600,
    series_cols: Sequence[str] = (),
    trigger_seconds: int = 60,
    available_now: bool = False,
    emit: str = "update",
) -> StreamingQuery:
    """Rows per sliding window on a stream (the job's window row count)."""
    return start_sliding_aggregate_stream(df, time_col, length_s, slide_s, out_path, checkpoint, (),
                                          series_cols, delay_s, trigger_seconds, available_now, emit)


def start_daily_stream(
    df: DataFrame,
    out_path: str,
    checkpoint: str,
    time_col: str | None = None,
    trigger_seconds: int = 60,
    available_now: bool = False,
) -> StreamingQuery:
    """Append every micro-batch to daily ``index_name`` folders (replay-safe)."""
    from tidemark.streaming.sinks import write_daily

    def handler(batch: DataFrame, batch_id: int) -> None:
        write_daily(batch, out_path, batch_id, time_col)

    return _start(df, handler, f"{checkpoint.rstrip('/')}/query", trigger_seconds, available_now, None)


def start_dynamic_threshold_job(
    records: DataFrame,
    out_path: str,
    checkpoint: str,
    model: str = "MA",
    n: int = 100,
    slide_minutes: int = 1,
    weights: str | Sequence[float] = DEFAULT_WEIGHTS,
    metrics: Sequence[str] | None = None,
    time_col: str | None = "timestamp",
    delay_s: int | None = None,
    trigger_seconds: int = 60,
    available_now: bool = False,
    daily_time_col: str | None = None,
    processing_stamp: bool = True,
    emit: str = "closed",
    series_cols: Sequence[str] = (),
    order_by: str | Sequence[str] = "offset",
    state_buckets: int = DEFAULT_BUCKETS,
) -> StreamingQuery:
    """The whole threshold job on a message stream ``(key, value, offset, <time_col>)``.

    Sliding window of ``n`` minutes every ``slide_minutes`` (the window length
    equals the number of records kept, as in the original configuration), the
    newest ``n`` records of each window by offset, decode, then ``MA`` or
    ``WMA`` (``model`` trimmed: ``"WMA"`` selects the banded average, anything
    else the plain average).  Results go to daily ``index_name`` folders under
    ``out_path``: by the processing clock like the original job, or by
    ``daily_time_col`` (e.g. ``"window_end"``) for replay-stable days.
    ``processing_stamp`` adds the ``@timestamp`` run-time column.

    ``time_col`` is the Kafka message time by default; ``None`` windows by
    arrival at the job (the micro-batch's processing time), like the
    original arrival-time windows.  ``delay_s`` defaults to an hour of
    lateness, and to none for arrival time, which can't be late.  ``emit="closed"`` (default) writes one
    result per window when the watermark passes its end: one result per
    slide, as the original job prints one per batch.  ``"update"`` rewrites
    every window that received rows.  ``series_cols`` (e.g. a host column)
    runs one independent series per value; empty means one series, as in the
    original single-partition job.  Messages are newest first by ``order_by``;
    with several partitions use ``sources.kafka.MESSAGE_ORDER``, because
    offsets only order one partition.
    """
    from tidemark.functions.schema import METRIC_COLS, PROCESSING_TS_COL, processing_timestamp
    from tidemark.functions.weights import parse_weights
    from tidemark.sources.records import decode_records
    from tidemark.streaming.sinks import write_daily

    metrics = list(metrics or METRIC_COLS)
    name = "WMA" if model.strip() == "WMA" else "MA"
    w = parse_weights(weights)

    def prepare(ranked: DataFrame) -> DataFrame:
        keep = (*series_cols, "window_start", "window_end", "__rank")
        return decode_records(ranked, metrics, keep=keep)

    def writer(df: DataFrame, path: str, batch_id: int) -> None:
        if processing_stamp:
            df = df.withColumn(PROCESSING_TS_COL, processing_timestamp())
        write_daily(df, path, batch_id, daily_time_col)

    if time_col is None:
        records = records.withColumn("__arrival", F.current_timestamp())
        time_col = "__arrival"
        delay_s = 0 if delay_s is None else delay_s
    delay_s = 3600 if delay_s is None else delay_s
    length_s, slide_s = n * 60, slide_minutes * 60
    proc = WindowedLatestNProcessor(records.schema, f"{checkpoint.rstrip('/')}/state", out_path, time_col,
                                    length_s, slide_s, metrics, order_by, n, list(series_cols), name, w,
                                    "create_date", delay_s, writer=writer,
                                    state_cols=["key", "value"], prepare=prepare, emit=emit, buckets=state_buckets)
    return _start(records, proc, f"{checkpoint.rstrip('/')}/query", trigger_seconds, available_now, None)


def run_until_stopped(query: StreamingQuery) -> None:
    """Block until the query is stopped or fails (the job's ``awaitTermination``)."""
    query.awaitTermination()
