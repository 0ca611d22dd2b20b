"""Latest-N per sliding window on Spark's own keyed state (``transformWithState``).

The ``foreachBatch`` processors keep their state as tables and read all open
panes every batch.  Here state lives in the state store:

* a map state per series, from block of ``k`` panes to the newest N rows of each
  of its panes, so a batch loads and rewrites only the blocks it has rows for;
* one event-time timer per series, at the end of its oldest open window.  When
  the watermark passes it, all windows that ended are ranked from the blocks
  they touch, blocks no open window needs are removed, and the timer is set to
  the next window.

Before the shuffle, every Arrow batch keeps the newest N rows per (series,
pane), so a hot series ships at most N rows per pane and batch.  Ranked rows
leave the operator; decoding and the model are the batch operators, in the sink.

Needs the RocksDB state store, which :func:`start_window_state_stream` sets for
its query.  Rows whose pane the watermark has passed are late and dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tidemark.functions.weights import DEFAULT_WEIGHTS
from tidemark.operators.panes import pane_index, pane_time
from tidemark.operators.recent import _as_list
from tidemark.operators.windows import TIE, WINDOW_END, WINDOW_START, aggregate_windows, pane_of, settle_ties
from tidemark.streaming.sinks import write_batch

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Ranked rows handed over at a time.
ROWS_OUT = 100_000


def _newest_per_pane(order: Sequence[str], keys: Sequence[str], n: int):
    """Keeps the newest ``n`` rows of each key of a pandas frame (first order column first, ties by row hash)."""
    by = [*order, "tie"]

    def newest(frame):
        ranked = frame.sort_values(by, ascending=False, na_position="last", kind="stable")
        return ranked.groupby(list(keys), sort=False, dropna=False).head(n)

    return newest


def _processor(payload: Sequence[str], order: Sequence[str], n: int, k: int, pane_s: int, state_schema: T.StructType):
    """The stateful processor, defined here so that executors get it by value."""
    import numpy as np
    import pandas as pd

    columns, payload, by = ["pidx", *payload], list(payload), [*order, "tie"]
    newest = _newest_per_pane(order, ["pidx"], n)

    class CloseWindows(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.blocks = handle.getMapState("blocks", "block bigint", state_schema)
            self.closed = handle.getValueState("closed", "last bigint")

        def _frame(self, value):
            return pd.DataFrame({c: list(v) for c, v in zip(columns, value, strict=True)}, columns=columns)

        def handleInputRows(self, key, rows, timerValues):
            new = pd.concat(list(rows), ignore_index=True)[columns]
            for block, part in new.groupby(new["pidx"] // k, sort=True):
                at = (int(block),)
                if self.blocks.containsKey(at):
                    part = pd.concat([self._frame(self.blocks.getValue(at)), part], ignore_index=True)
                kept = newest(part)
                self.blocks.updateValue(at, tuple(kept[c].astype(object).where(kept[c].notna(), None).tolist()
                                                  for c in columns))
            closed = self.closed.get()[0] if self.closed.exists() else None
            first = int(new["pidx"].min())
            if closed is not None:
                first = max(first, closed + 1)
            self._wake(first)
            return iter(())

        def _wake(self, window: int) -> None:
            # A timer fires when the watermark is beyond it; a window that ends at the watermark is closed.
            at = (window + 1) * pane_s * 1000 - 1
            if at not in set(self.handle.listTimers()):
                self.handle.registerTimer(at)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            upto = timerValues.getCurrentWatermarkInMs() // (pane_s * 1000) - 1
            closed = self.closed.get()[0] if self.closed.exists() else None
            if closed is not None and upto <= closed:
                return
            held = {at[0]: self._frame(value) for at, value in self.blocks.iterator()}
            if not held:
                return
            panes = pd.concat(held.values(), ignore_index=True)
            lowest = int(panes["pidx"].min())
            low = lowest if closed is None else max(lowest, closed + 1)
            near = panes[(panes["pidx"] <= upto) & (panes["pidx"] > low - k)]
            # Order all rows once; a window is a slice of the panes, and takes its n least order numbers.
            near = near.sort_values(by, ascending=False, na_position="last", kind="stable").reset_index(drop=True)
            by_pane = np.argsort(near["pidx"].to_numpy(), kind="stable")
            pane = near["pidx"].to_numpy()[by_pane]
            ends = np.unique((np.unique(pane)[:, None] + np.arange(k)[None, :]).ravel())
            ends = ends[(ends >= low) & (ends <= upto)]
            starts, stops = np.searchsorted(pane, ends - k + 1), np.searchsorted(pane, ends, "right")
            picks = [np.sort(by_pane[a:b])[:n] for a, b in zip(starts, stops, strict=True)]
            self.closed.update((upto,))
            for block, frame in held.items():
                if int(frame["pidx"].max()) <= upto - k + 1:
                    self.blocks.removeKey((block,))
            alive = panes[panes["pidx"] > upto - k + 1]
            if len(alive):
                self._wake(max(upto + 1, int(alive["pidx"].min())))
            step = max(1, ROWS_OUT // n)
            for at in range(0, len(picks), step):
                some = picks[at : at + step]
                sizes = [len(x) for x in some]
                out = near[payload].iloc[np.concatenate(some)].reset_index(drop=True)
                out.insert(0, "wpane", np.repeat(ends[at : at + step], sizes))
                out.insert(1, "place", np.concatenate([np.arange(x) for x in sizes]))
                for i, name in enumerate(self.key_names):
                    out.insert(i, name, pd.Series([key[i]] * len(out), dtype=object))
                yield out

        def close(self) -> None:
            pass

    return CloseWindows


def start_window_state_stream(
    df: DataFrame,
    model: str,
    metrics: Sequence[str],
    order_by: str | Sequence[str],
    n: int,
    window: tuple[int, int],
    time_col: str,
    out_path: str,
    checkpoint: str,
    series_cols: str | Sequence[str] = (),
    delay_s: int = 3600,
    weights: Sequence[float] = DEFAULT_WEIGHTS,
    label_col: str | None = None,
    payload: Sequence[str] | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    writer: Callable[[DataFrame, str, int], None] = write_batch,
    trigger_seconds: int = 60,
    available_now: bool = False,
) -> StreamingQuery:
    """Model over the newest ``n`` rows of each sliding window; every window is written once, when it has closed.

    ``window`` is (length, slide) in seconds, length a multiple of slide.  The
    watermark is the end of the newest pane seen less ``delay_s``.  Series
    columns may be null; they are one more series, and no series at all is one
    key.  ``payload`` columns are kept per row (default: metrics and label) and
    ``prepare`` turns ranked rows into metrics, e.g. decodes messages.  Order
    columns must not be null, and NaN metrics count as null.
    """
    length_s, slide_s = window
    if length_s % slide_s:
        raise ValueError("length must be a multiple of slide")
    k = length_s // slide_s
    series, order = _as_list(series_cols), _as_list(order_by)
    kept = list(dict.fromkeys([*order, *(payload if payload is not None else [*metrics, *([label_col] if label_col else [])])]))
    # Inside the operator columns go by plain names: pandas tuples don't take every name.
    inner = {c: f"c{i}" for i, c in enumerate(kept)}
    inner_order = [inner[c] for c in order]
    spark = df.sparkSession
    used = df.select(*dict.fromkeys([*series, time_col, *kept])).where(F.col(time_col).isNotNull())
    paned = settle_ties(pane_of(used, time_col, slide_s, slide_s))
    time_type = paned.schema["__pane"].dataType
    index = pane_index(time_type, F.col("__pane"), slide_s)
    # A series key is a null flag and a value, so a null is a key of its own; a pane's end is its rows' event time.
    keys = [f"k{i}" for i in range(len(series))]
    rows = paned.select(*[F.col(c).isNull().alias(f"{kk}n") for kk, c in zip(keys, series, strict=True)],
                        *[F.col(c).alias(kk) for kk, c in zip(keys, series, strict=True)],
                        index.alias("pidx"), *[F.col(c).alias(inner[c]) for c in kept], F.col(TIE).alias("tie"))
    rows = rows.withColumn("at", F.timestamp_seconds((F.col("pidx") + 1) * F.lit(slide_s)))
    if not series:
        keys, rows = ["k0"], rows.withColumn("k0", F.lit(0)).withColumn("k0n", F.lit(False))
    else:  # a flagged null has some value of its type
        for kk in keys:
            kind = rows.schema[kk].dataType
            rows = rows.withColumn(kk, F.coalesce(kk, F.lit("0").try_cast(kind), F.lit("1970-01-01").try_cast(kind)))

    key_cols = [c for kk in keys for c in (f"{kk}n", kk)]
    payload_cols = [*inner.values(), "tie"]
    state_schema = T.StructType([T.StructField(c, T.ArrayType(rows.schema[c].dataType)) for c in ["pidx", *payload_cols]])
    processor = _processor(payload_cols, inner_order, n, k, slide_s, state_schema)
    processor.key_names = key_cols
    out_schema = T.StructType([*[T.StructField(c, rows.schema[c].dataType) for c in key_cols],
                               T.StructField("wpane", T.LongType()), T.StructField("place", T.LongType()),
                               *[T.StructField(c, rows.schema[c].dataType) for c in payload_cols]])
    fewer = _newest_per_pane(inner_order, [*key_cols, "pidx"], n)

    def per_batch(frames):
        for frame in frames:
            if len(frame):
                yield fewer(frame)

    reduced = rows.mapInPandas(per_batch, rows.schema).withWatermark("at", f"{delay_s} seconds")
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        ranked = reduced.groupBy(*key_cols).transformWithStateInPandas(
            statefulProcessor=processor(), outputStructType=out_schema, outputMode="append", timeMode="EventTime")

        def sink(batch: DataFrame, batch_id: int) -> None:
            end = pane_time(time_type, F.col("wpane") + 1, slide_s)
            names = [F.when(~F.col(f"{kk}n"), F.col(kk)).alias(c) for kk, c in zip(keys, series, strict=False)]
            placed = batch.select(*names, (end - F.make_dt_interval(secs=F.lit(length_s))).alias(WINDOW_START),
                                  end.alias(WINDOW_END), F.col("place").alias("__rank"),
                                  *[F.col(i).alias(c) for c, i in inner.items()])
            placed = prepare(placed) if prepare else placed
            writer(aggregate_windows(placed, model, metrics, n, series, weights, label_col), out_path, batch_id)

        w = (ranked.writeStream.outputMode("append").foreachBatch(sink)
             .option("checkpointLocation", f"{checkpoint.rstrip('/')}/query"))
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{trigger_seconds} seconds")
        return w.start()
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
