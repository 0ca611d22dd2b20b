"""``foreachBatch`` processors for latest-N thresholds on a stream.

Structured Streaming rejects sorts and ``row_number`` on streaming frames, and
a ``collect_list`` aggregation would keep every row of a window in state.
These processors instead keep an explicit, bounded state table and run the
*batch* operators on each micro-batch:

* :class:`LatestNProcessor` - state = newest N rows per series.
* :class:`WindowedLatestNProcessor` - state = newest N rows per (series, pane)
  for panes that can still belong to an open window; a pane is evicted once
  the watermark has passed the end of the last window containing it.  With
  ``state_cols``/``prepare`` the state can hold raw message columns that are
  decoded only for the ranked rows (as the original job decodes after taking
  the newest N, so a bad record outside them never fails a batch).

Per batch: merge new rows into the state with ``latest_n`` (a partial
``WindowGroupLimit`` runs before the shuffle, so a hot series never ships more
than N rows per task), persist the state (replay-safe, see
:mod:`tidemark.streaming.state`), then recompute the model for the series or
windows touched by the batch and write them to a batch-keyed sink.  The final
answer of every key is its last emitted row (:func:`sinks.read_latest`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.weights import DEFAULT_WEIGHTS
from tidemark.operators.models import aggregate_ranked
from tidemark.operators.recent import _as_list, latest_n, recency_rank, semi_join
from tidemark.operators.windows import (
    BLOCKED_MIN_WINDOWS_PER_PANE,
    WINDOW_END,
    WINDOW_START,
    _check,
    _window_latest_n_blocked,
    aggregate_windows,
    expand_panes,
    pane_of,
    settle_ties,
)
from tidemark.streaming.sinks import write_batch
from tidemark.streaming.state import DEFAULT_BUCKETS, VersionedState


def _columns(*groups) -> list[str]:
    out: list[str] = []
    for g in groups:
        for c in _as_list(g):
            if c and c not in out:
                out.append(c)
    return out


class LatestNProcessor:
    """Per-series latest-N model on a stream (no time window)."""

    def __init__(self, input_schema: T.StructType, state_path: str, sink_path: str,
                 metrics: Sequence[str], order_by: str | Sequence[str], n: int,
                 series_cols: str | Sequence[str] = (), model: str = "MA",
                 weights: Sequence[float] = DEFAULT_WEIGHTS, label_col: str | None = None,
                 rename: Mapping[str, str] | None = None, writer=write_batch, buckets: int = DEFAULT_BUCKETS):
        self.writer = writer
        self.series = _as_list(series_cols)
        self.order = _as_list(order_by)
        self.metrics, self.n, self.model = list(metrics), n, model
        self.weights, self.label_col, self.rename = weights, label_col, rename
        self.cols = _columns(self.series, self.order, self.metrics, label_col)
        schema = T.StructType([input_schema[c] for c in self.cols])
        self.state = VersionedState(state_path, schema, self.series, buckets)
        self.sink_path = sink_path

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        new = batch.select(*self.cols).persist()
        try:
            self._process(new, batch_id)
        finally:
            new.unpersist()

    def _process(self, new: DataFrame, batch_id: int) -> None:
        spark = new.sparkSession
        manifest = self.state.manifest(spark, batch_id)
        buckets = self.state.touched(new)
        prev = self.state.read(spark, manifest, buckets)
        merged = latest_n(prev.unionByName(new), self.n, self.order, self.series, rank_col=None)
        manifest = self.state.write(merged, batch_id, manifest, buckets)
        current = self.state.read(spark, manifest, buckets)
        if self.series:
            touched = new.select(*self.series).distinct()
            current = semi_join(current, touched, self.series)
        ranked = recency_rank(current, self.order, self.series, "__rank")
        out = aggregate_ranked(ranked, self.model, self.metrics, self.n, self.series, "__rank",
                               self.weights, self.label_col, self.rename)
        self.writer(out, self.sink_path, batch_id)
        self.state.commit(spark, batch_id, manifest)


class WindowedLatestNProcessor:
    """Latest-N model inside every sliding event-time window of a stream.

    ``delay_s`` is the allowed lateness: the watermark is the end of the
    newest pane seen so far minus ``delay_s``.  Rows whose windows have all
    closed are ignored; state keeps at most N rows per (series, open pane).

    ``emit="update"`` writes, every batch, each window that received rows
    (its final value is its last emission).  ``emit="closed"`` writes each
    window once, in the batch where the watermark passes its end, like
    Spark's append mode.  This is the job's one-result-per-slide behaviour.
    The windows closing in a batch form one time range, so each pane expands
    only into those windows: O(N x length/slide) rows per series and batch,
    instead of O(N x (length/slide)^2) for updating every open window.
    """

    def __init__(self, input_schema: T.StructType, state_path: str, sink_path: str,
                 time_col: str, length_s: int, slide_s: int, metrics: Sequence[str],
                 order_by: str | Sequence[str], n: int, series_cols: str | Sequence[str] = (),
                 model: str = "MA", weights: Sequence[float] = DEFAULT_WEIGHTS,
                 label_col: str | None = None, delay_s: int = 3600,
                 rename: Mapping[str, str] | None = None, writer=write_batch,
                 state_cols: Sequence[str] | None = None, prepare=None, emit: str = "update",
                 buckets: int = DEFAULT_BUCKETS):
        if emit not in ("update", "closed"):
            raise ValueError("emit must be 'update' or 'closed'")
        self.emit = emit
        self.writer = writer
        self.prepare = prepare
        self.pane_s = _check(length_s, slide_s)
        self.length_s, self.slide_s, self.delay_s = length_s, slide_s, delay_s
        self.time_col = time_col
        self.series = _as_list(series_cols)
        self.order = _as_list(order_by)
        self.metrics, self.n, self.model = list(metrics), n, model
        self.weights, self.label_col, self.rename = weights, label_col, rename
        if state_cols is not None:
            self.cols = _columns(self.series, time_col, self.order, state_cols)
        else:
            self.cols = _columns(self.series, time_col, self.order, self.metrics, label_col)
        self.time_type = input_schema[time_col].dataType
        schema = T.StructType([input_schema[c] for c in self.cols]
                              + [T.StructField("__pane", self.time_type, True)])
        self.state = VersionedState(state_path, schema, [*self.series, "__pane"], buckets)
        self.sink_path = sink_path
        self._blocked = self.pane_s == slide_s and length_s // slide_s >= BLOCKED_MIN_WINDOWS_PER_PANE

    def _last_window_end(self, pane: str = "__pane"):
        """End of the latest window that contains the pane."""
        start = F.window(pane, f"{self.slide_s} seconds").start
        return start + F.make_dt_interval(secs=F.lit(self.length_s))

    def _watermark_text(self, new: DataFrame, before: str | None) -> str | None:
        """Watermark as text: end of the newest pane seen (in ``new`` or before) minus the lateness."""
        wm = F.max("__pane") + F.make_dt_interval(secs=F.lit(self.pane_s - self.delay_s))
        text = new.agg(F.date_format(wm, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("m")).first()["m"]
        return max(filter(None, (text, before)), default=None)

    def _ts(self, text: str):
        return F.lit(text).cast(self.time_type)

    def _floor(self, c):
        return F.window(c, f"{self.slide_s} seconds").start

    def _closing_windows(self, current: DataFrame, lo: str | None, hi: str) -> DataFrame:
        """Pane rows copied into each window whose end lies in ``(lo, hi]``."""
        length = F.make_dt_interval(secs=F.lit(self.length_s))
        slide = F.make_dt_interval(secs=F.lit(self.slide_s))
        p = F.col("__pane")
        # window starts s (multiples of slide) with p - L < s <= p and lo < s + L <= hi;
        # one window() per projection (Spark allows no more), hence the steps
        low = p - length if lo is None else F.greatest(p - length, self._ts(lo) - length)
        rows = current.filter(p < self._ts(hi))
        if lo is not None:
            rows = rows.filter(p + length > self._ts(lo))
        rows = (rows.withColumn("__s_lo", low).withColumn("__s_lo", self._floor("__s_lo") + slide)
                .withColumn("__s_hi", F.least(p, self._ts(hi) - length))
                .withColumn("__s_hi", self._floor("__s_hi")))
        starts = F.when(F.col("__s_lo") <= F.col("__s_hi"), F.sequence("__s_lo", "__s_hi", slide))
        return (rows.select("*", F.explode(starts).alias(WINDOW_START))
                .withColumn(WINDOW_END, F.col(WINDOW_START) + length)
                .drop("__pane", "__s_lo", "__s_hi"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        new = pane_of(batch.select(*self.cols), self.time_col, self.length_s, self.slide_s).persist()
        try:
            self._process(new, batch_id)
        finally:
            new.unpersist()

    def _process(self, new: DataFrame, batch_id: int) -> None:
        spark = new.sparkSession
        manifest = self.state.manifest(spark, batch_id)
        passed = manifest.get("watermark")
        wm = None if passed is None else self._ts(passed)
        open_pane = F.lit(True) if wm is None else self._last_window_end() > wm
        new = new.filter(open_pane)
        # only the buckets of panes that got rows are merged and rewritten; closed panes go when theirs is
        buckets = self.state.touched(new)
        prev = self.state.read(spark, manifest, buckets).filter(open_pane)
        merged = latest_n(prev.unionByName(new), self.n, self.order, [*self.series, "__pane"], rank_col=None)
        manifest = self.state.write(merged, batch_id, manifest, buckets)
        manifest["watermark"] = hi = self._watermark_text(new, passed)
        current = self.state.read(spark, manifest).filter(open_pane)

        keys = [*self.series, WINDOW_START, WINDOW_END]
        if self.emit == "closed":
            emitted_to = manifest.get("emitted_to")
            if hi is None or (emitted_to is not None and hi <= emitted_to):
                self.state.commit(spark, batch_id, manifest)
                return
            rows = self._closing_windows(current, emitted_to, hi)
        else:
            touched_panes = new.select(*self.series, "__pane").distinct()
            touched = expand_panes(touched_panes, self.length_s, self.slide_s).distinct()
            if wm is not None:
                # a late row can lie in an open pane that closed windows share: those stay as they were written
                touched = touched.filter(F.col(WINDOW_END) > wm)
            # only panes that share a window with a touched pane (closer than the
            # window length) can matter: expand those, not the whole state
            span = F.make_dt_interval(secs=F.lit(self.length_s - self.pane_s))
            step = F.make_dt_interval(secs=F.lit(self.pane_s))
            near = touched_panes.select(*self.series, F.explode(F.sequence(
                F.col("__pane") - span, F.col("__pane") + span, step)).alias("__pane")).distinct()
            relevant = semi_join(current, near, [*self.series, "__pane"])
            if self._blocked:
                # many windows per pane: rank every window of the relevant panes with
                # the blocked method (rows copied at most twice), keep the touched ones
                ranked = _window_latest_n_blocked(settle_ties(relevant), self.time_col, self.length_s, self.slide_s,
                                                  self.n, self.order, self.series, "__rank")
                rows = None
                ranked = semi_join(ranked, touched, keys)
            else:
                rows = semi_join(expand_panes(relevant, self.length_s, self.slide_s), touched, keys)
        if rows is not None:
            ranked = latest_n(rows, self.n, self.order, keys, rank_col="__rank")
        if self.prepare is not None:
            ranked = self.prepare(ranked)
        out = aggregate_windows(ranked, self.model, self.metrics, self.n, self.series,
                                self.weights, self.label_col, self.rename)
        self.writer(out, self.sink_path, batch_id)
        if self.emit == "closed":
            manifest["emitted_to"] = hi
        self.state.commit(spark, batch_id, manifest)
