"""Per-series latest-N thresholds on Spark's keyed state store.

The ``foreachBatch`` processors rewrite the state buckets a micro-batch
touches.  With very many series and few touched per batch, the keyed state
store is cheaper: series are dealt to many small buckets by the hash of their
key, and only the buckets with a series in the batch are loaded and updated
(with the RocksDB state store provider configured, checkpoints are
incremental too).

Plan per micro-batch:

1. ``mapInPandas`` (stateless) keeps the newest N rows of every series inside
   each Arrow batch (``spark.sql.execution.arrow.maxRecordsPerBatch`` rows,
   10,000 by default), so a series holding a third of the stream ships at
   most N rows per batch into the shuffle, and memory stays bounded by the
   batch size;
2. ``groupBy(bucket).applyInPandasWithState`` merges those rows with the
   bucket's state (the newest N rows of each of its series), keeps the newest
   N of every series and emits the model (MA / WMA / WMA_FLAT) of the series
   that the batch holds.

A call of step 2 handles all series of a bucket in a few vector operations, so
a batch costs at most ``state_buckets`` calls however many series it has.  A
bucket must fit a task: N rows for each of its series.

The weights, bands and denominator are the same constants as the batch
models (:mod:`tidemark.functions.weights`).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupStateTimeout

from tidemark.functions.schema import LABEL_COL, output_name
from tidemark.functions.weights import DEFAULT_WEIGHTS, band_bounds, denominator, parse_weights
from tidemark.operators.recent import _as_list
from tidemark.streaming.sinks import write_batch

#: Buckets of series in the state store: few rows each, and enough for millions of series.
KEYED_BUCKETS = 4_096


def _with_null_flag(name: str, column: Column, kind: T.DataType) -> list[Column]:
    """``name`` and ``name_null``: pandas would turn integers beside nulls into floats."""
    value = F.coalesce(column, F.lit(0).cast(kind)) if isinstance(kind, T.IntegralType) else column
    return [value.alias(name), column.isNull().alias(f"{name}_null")]


def start_keyed_latest_n_stream(
    df: DataFrame,
    model: str,
    metrics: Sequence[str],
    order_col: str,
    n: int,
    series_cols: str | Sequence[str],
    out_path: str,
    checkpoint: str,
    weights: Sequence[float] = DEFAULT_WEIGHTS,
    label_col: str | None = None,
    trigger_seconds: int = 60,
    available_now: bool = False,
    state_buckets: int = KEYED_BUCKETS,
) -> StreamingQuery:
    """Newest-``n`` model per series with keyed state; results to ``out_path``
    (batch-keyed parquet; final values via ``sinks.read_latest``).  A checkpoint
    keeps the ``state_buckets`` it was started with."""
    name = model.strip()
    if name not in ("MA", "WMA", "WMA_FLAT"):
        name = "MA"
    series = _as_list(series_cols)
    if not series:
        raise ValueError("series_cols is required for keyed state")
    metrics = list(metrics)
    # Own column names: a column may be the order, a metric and the label at once.
    keys = [f"s{i}" for i in range(len(series))]
    values = [f"m{i}" for i in range(len(metrics))]
    rows = df.select(
        *[c for k, s in zip(keys, series) for c in _with_null_flag(k, F.col(s), df.schema[s].dataType)],
        *_with_null_flag("o", F.col(order_col), df.schema[order_col].dataType),
        *[F.col(m).cast("double").alias(v) for v, m in zip(values, metrics)],
        *(_with_null_flag("l", F.col(label_col), df.schema[label_col].dataType) if label_col else []))
    names = rows.columns
    # Everything the executors need is computed here and captured by value:
    # the functions below use only numpy and pandas (no import of this package).
    d = denominator(n, weights)
    w = parse_weights(weights)
    if name == "WMA_FLAT":
        rank_weights = np.full(n, w[0])
    else:
        b = band_bounds(n)
        ranks = np.arange(n)
        rank_weights = np.select([ranks < b[0], ranks < b[1], ranks < b[2]], [w[0], w[1], w[2]], default=w[3])
    out_names = [output_name(m) for m in metrics]
    label_type = df.schema[label_col].dataType if label_col else None
    parse_label = bool(label_col and name != "MA" and isinstance(label_type, T.StringType))
    is_ma = name == "MA"

    def series_codes(pdf):
        nulls = [f"{k}_null" for k in keys if pdf[f"{k}_null"].any()]
        return pdf.groupby([*keys, *nulls], sort=False, dropna=False).ngroup().to_numpy()

    def newest(pdf, codes):
        """Positions of the newest n rows of every series, a series together and its newest first; their series and ranks."""
        by = pdf["o"].reset_index(drop=True).sort_values(ascending=False, kind="stable").index.to_numpy()
        by = by[np.argsort(pdf["o_null"].to_numpy()[by], kind="stable")]
        by = by[np.argsort(codes[by], kind="stable")]
        c = codes[by]
        starts = np.flatnonzero(np.r_[True, c[1:] != c[:-1]])
        rank = np.arange(len(c)) - np.repeat(starts, np.diff(np.r_[starts, len(c)]))
        keep = rank < n
        return by[keep], c[keep], rank[keep]

    def newest_per_task(batches):
        for pdf in batches:
            if len(pdf):
                yield pdf.iloc[newest(pdf, series_codes(pdf))[0]]

    def packed(pdf):
        batch = pa.record_batch([pa.array(pdf[c], from_pandas=True) for c in names], names=names)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        return sink.getvalue().to_pybytes()

    def update(key, pdfs, state):
        frames = [p[names] for p in pdfs]
        n_old = 0
        if state.exists:
            old = pa.ipc.open_stream(state.get[0]).read_pandas(use_threads=False)
            n_old = len(old)
            frames.insert(0, old)
        pdf = pd.concat(frames, ignore_index=True) if len(frames) > 1 else frames[0].reset_index(drop=True)
        codes = series_codes(pdf)
        n_series = codes.max() + 1
        in_batch = np.zeros(n_series, dtype=bool)
        in_batch[codes[n_old:]] = True
        kept, codes, rank = newest(pdf, codes)
        pdf = pdf.iloc[kept].reset_index(drop=True)
        state.update((packed(pdf),))
        out = pdf.loc[np.flatnonzero(rank == 0)[in_batch], [c for k in keys for c in (k, f"{k}_null")]].reset_index(drop=True)
        for v in values:
            x = pdf[v].to_numpy(dtype=float)
            seen = ~np.isnan(x)
            found = np.bincount(codes, seen, n_series)
            total = np.bincount(codes, np.where(seen, x if is_ma else x * rank_weights[rank], 0.0), n_series)
            by = found if is_ma else np.full(n_series, d, dtype=float)
            # no value at all: null, as in the batch models
            out[v] = np.divide(total, by, out=np.full(n_series, np.nan), where=(found > 0) & (by != 0))[in_batch]
        if label_col:
            known = ~pdf["l_null"].to_numpy()
            label, of = pdf["l"][known], codes[known]
            if parse_label:
                label = pd.to_datetime(label, errors="coerce", utc=True, format="mixed").dt.tz_localize(None)
            newest_label = label.groupby(of).max().reindex(np.flatnonzero(in_batch), fill_value=0 if whole_label else None)
            out["l"] = newest_label.to_numpy()
            out["l_null"] = (np.bincount(of, minlength=n_series) == 0)[in_batch]
        yield out

    whole_label = isinstance(label_type, T.IntegralType)
    bucketed = rows.mapInPandas(newest_per_task, rows.schema).withColumn(
        "bucket", F.pmod(F.xxhash64(*keys, *[f"{k}_null" for k in keys]), F.lit(state_buckets)).cast("int"))
    out_schema = T.StructType([
        *[rows.schema[c] for k in keys for c in (k, f"{k}_null")],
        *[T.StructField(v, T.DoubleType()) for v in values],
        *([T.StructField("l", T.TimestampNTZType() if parse_label else label_type),
           T.StructField("l_null", T.BooleanType())] if label_col else [])])
    result = bucketed.groupBy("bucket").applyInPandasWithState(
        update, out_schema, T.StructType([T.StructField("rows", T.BinaryType())]), "update", GroupStateTimeout.NoTimeout)
    result = result.select(
        *[F.when(~F.col(f"{k}_null"), F.col(k)).alias(s) for k, s in zip(keys, series)],
        *[F.col(v).alias(o) for v, o in zip(values, out_names)],
        *([F.when(~F.col("l_null"), F.col("l")).alias(LABEL_COL)] if label_col else []))

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, out_path, batch_id)

    writer = (result.writeStream.outputMode("update").foreachBatch(sink)
              .option("checkpointLocation", f"{checkpoint.rstrip('/')}/query"))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=f"{trigger_seconds} seconds"))
    return writer.start()
