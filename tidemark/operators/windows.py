"""Sliding time windows: counts and aggregates, and latest-N inside each window.

Windows are aligned to the epoch (Spark ``window()``), ``length`` and
``slide`` in seconds.  A sliding window copies every row into
``length / slide`` windows; both operators here avoid copying raw rows:

* :func:`sliding_aggregate` first aggregates rows into *panes* of
  ``gcd(length, slide)`` seconds (one partial row per series and pane), then
  expands only the pane rows into windows and combines the partials.
* :func:`window_latest_n` keeps the newest N rows of every pane first (a row
  outside its pane's newest N can never be among the newest N of a window that
  contains the pane), so at most ``N x length / pane`` rows reach any window:
  the per-window group is bounded however hot a series is.  With many windows
  per pane it merges the panes' arrays inside blocks of contiguous panes
  (:mod:`tidemark.operators.panes`), so rows are copied at most twice instead
  of once per window; :func:`window_threshold` then computes the model from
  each window's array, one row per window.
* :func:`sliding_moments`, :func:`sliding_summary` and :func:`sliding_limits`
  merge count, mean and squared deviations of panes in the same way.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.schema import LABEL_COL, label_to_utc, output_name
from tidemark.functions.weights import DEFAULT_WEIGHTS, band_bounds, denominator, parse_weights
from tidemark.operators.models import DEFAULT_LAMBDA, SUMMARY_STATS, aggregate_ranked, control_limits
from tidemark.operators.panes import (
    PANE_INDEX,
    WINDOW_INDEX,
    merge_moments,
    merge_windows,
    moments,
    newest_rows,
    pane_index,
    pane_time,
    stddev_samp,
)
from tidemark.operators.recent import _as_list, latest_n

WINDOW_START = "window_start"
WINDOW_END = "window_end"


def _check(length_s: int, slide_s: int) -> int:
    if length_s <= 0 or slide_s <= 0:
        raise ValueError("window length and slide must be positive")
    return math.gcd(length_s, slide_s)


def _dur(seconds: int) -> str:
    return f"{seconds} seconds"


def _pane_start(time_col: str, pane_s: int):
    return F.window(time_col, _dur(pane_s)).start


def sliding_aggregate(
    df: DataFrame,
    time_col: str,
    length_s: int,
    slide_s: int,
    metrics: Sequence[str] = (),
    series_cols: str | Sequence[str] = (),
) -> DataFrame:
    """Row count and per-metric sum / avg / min / max of every sliding window.

    Output: ``series.., window_start, window_end, n_rows`` and
    ``<m>_sum, <m>_avg, <m>_min, <m>_max`` per metric.  Only windows that
    contain at least one row appear (as with ``window()``).
    """
    pane_s = _check(length_s, slide_s)
    series = _as_list(series_cols)
    partial = [F.count(F.lit(1)).alias("__n")]
    for m in metrics:
        partial += [F.sum(m).alias(f"__s_{m}"), F.count(m).alias(f"__c_{m}"),
                    F.min(m).alias(f"__lo_{m}"), F.max(m).alias(f"__hi_{m}")]
    panes = (df.select(*series, time_col, *metrics)
             .groupBy(*series, _pane_start(time_col, pane_s).alias("__pane"))
             .agg(*partial))
    final = [F.sum("__n").alias("n_rows")]
    for m in metrics:
        final += [F.sum(f"__s_{m}").alias(f"{m}_sum"),
                  F.try_divide(F.sum(f"__s_{m}"), F.sum(f"__c_{m}")).alias(f"{m}_avg"),
                  F.min(f"__lo_{m}").alias(f"{m}_min"), F.max(f"__hi_{m}").alias(f"{m}_max")]
    win = F.window("__pane", _dur(length_s), _dur(slide_s))
    out = panes.groupBy(*series, win.alias("__w")).agg(*final)
    return out.select(*series, F.col("__w.start").alias(WINDOW_START),
                      F.col("__w.end").alias(WINDOW_END), *[c for c in out.columns
                                                            if c not in (*series, "__w")])


def sliding_moments(df: DataFrame, time_col: str, length_s: int, slide_s: int, metrics: Sequence[str],
                    series_cols: str | Sequence[str] = ()) -> DataFrame:
    """``series.., window_start, window_end`` and a struct (n, mean, m2, lo, hi) per metric of every sliding window.

    Rows are reduced to panes of ``gcd(length, slide)`` seconds; panes are merged
    pairwise, so a large mean does not swallow a small spread.  Only windows
    that contain a row appear; a metric without values has n = 0 and nulls.
    """
    pane_s = _check(length_s, slide_s)
    series, metrics = _as_list(series_cols), list(metrics)
    panes = (df.select(*series, time_col, *[m for m in metrics if m not in series and m != time_col])
             .groupBy(*series, _pane_start(time_col, pane_s).alias("__pane"))
             .agg(F.struct(*[moments(m).alias(f"m{i}") for i, m in enumerate(metrics)]).alias("__m")))
    time_type = panes.schema["__pane"].dataType
    panes = panes.withColumn(PANE_INDEX, pane_index(time_type, F.col("__pane"), pane_s)).drop("__pane")

    def merge(a: Column, b: Column) -> Column:
        return F.struct(*[merge_moments(a[f"m{i}"], b[f"m{i}"]).alias(f"m{i}") for i in range(len(metrics))])

    merged = merge_windows(panes, series, "__m", length_s // pane_s, merge)
    # a window ends with a pane whose number and one is a multiple of slide / pane
    step = slide_s // pane_s
    ends = F.col(WINDOW_INDEX) + 1 - F.lit(length_s // pane_s)
    merged = merged.where(F.pmod(ends, F.lit(step)) == 0)
    end = pane_time(time_type, F.col(WINDOW_INDEX) + 1, pane_s)
    return merged.select(*series, (end - F.make_dt_interval(secs=F.lit(length_s))).alias(WINDOW_START),
                         end.alias(WINDOW_END), *[F.col(f"__m.m{i}").alias(m) for i, m in enumerate(metrics)])


def sliding_summary(df: DataFrame, time_col: str, length_s: int, slide_s: int, metrics: Sequence[str],
                    series_cols: str | Sequence[str] = ()) -> DataFrame:
    """count / mean / stddev (sample) / min / max of each metric in every sliding window: rows
    ``(series.., window_start, window_end, metric, <metrics>)`` as ``describe_summary`` has them."""
    series, metrics = _as_list(series_cols), list(metrics)
    wide = sliding_moments(df, time_col, length_s, slide_s, metrics, series)
    stat = {"count": lambda m: m["n"].cast("double"), "mean": lambda m: m["mean"], "stddev": stddev_samp,
            "min": lambda m: m["lo"], "max": lambda m: m["hi"]}
    rows = F.array(*[F.struct(F.lit(s).alias("metric"), *[stat[s](F.col(m)).alias(m) for m in metrics])
                     for s in SUMMARY_STATS])
    return wide.select(*series, WINDOW_START, WINDOW_END, F.inline(rows))


def sliding_limits(df: DataFrame, time_col: str, length_s: int, slide_s: int, metrics: Sequence[str],
                   series_cols: str | Sequence[str] = (), lam: float = DEFAULT_LAMBDA) -> DataFrame:
    """Control limits of each metric over all rows of every sliding window: rows
    ``(series.., window_start, window_end, field, mean, stddev, ucl, lcl)``; null limits for fewer than two values."""
    series, metrics = _as_list(series_cols), list(metrics)
    wide = sliding_moments(df, time_col, length_s, slide_s, metrics, series)
    rows = F.array(*[F.struct(F.lit(m).alias("field"), F.col(m)["mean"].alias("mean"),
                              stddev_samp(F.col(m)).alias("stddev")) for m in metrics])
    return control_limits(wide.select(*series, WINDOW_START, WINDOW_END, F.inline(rows)), lam)


def window_count(df: DataFrame, time_col: str, length_s: int, slide_s: int,
                 series_cols: str | Sequence[str] = ()) -> DataFrame:
    """Rows per sliding window."""
    return sliding_aggregate(df, time_col, length_s, slide_s, (), series_cols)


def pane_of(df: DataFrame, time_col: str, length_s: int, slide_s: int, pane_col: str = "__pane") -> DataFrame:
    """Tag rows with the start of their pane (``gcd(length, slide)`` seconds)."""
    return df.withColumn(pane_col, _pane_start(time_col, _check(length_s, slide_s)))


def expand_panes(df: DataFrame, length_s: int, slide_s: int, pane_col: str = "__pane") -> DataFrame:
    """One copy of each pane row per window containing the pane (``pane_col`` dropped)."""
    win = F.window(pane_col, _dur(length_s), _dur(slide_s))
    return df.select("*", win.start.alias(WINDOW_START), win.end.alias(WINDOW_END)).drop(pane_col)


BLOCKED_MIN_WINDOWS_PER_PANE = 16
TIE = "__tie"


def _has_map(t: T.DataType) -> bool:
    return "map<" in t.simpleString()


def settle_ties(df: DataFrame) -> DataFrame:
    """Add a hash of the whole row: the last word between rows that ``order_by`` leaves tied."""
    return df.withColumn(TIE, F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if not _has_map(f.dataType)]))


def window_latest_n(
    df: DataFrame,
    time_col: str,
    length_s: int,
    slide_s: int,
    n: int,
    order_by: str | Sequence[str],
    series_cols: str | Sequence[str] = (),
    rank_col: str = "rank",
    method: str = "auto",
) -> DataFrame:
    """The newest ``n`` rows (by ``order_by``) of every sliding window, ranked 0 = newest.

    Rows tied in ``order_by`` are ordered by pane and then by a hash of the row,
    so both methods choose the same.  Both first keep the newest ``n`` rows of
    every (series, pane).  ``"expand"`` then copies each pane row into its
    ``k = length / slide`` windows and takes the newest ``n`` per window (cost
    grows with ``k``).  ``"blocked"`` (needs ``length`` to be a multiple of
    ``slide``, and no map columns) keeps a pane's rows as one sorted array and
    merges arrays inside blocks of ``k`` panes (:mod:`tidemark.operators.panes`):
    three merges per window, each row copied at most twice, no join.  Both give
    the same rows and ranks; ``"auto"`` takes the cheaper one (``blocked`` from
    ``k = 16`` on).
    """
    series = _as_list(series_cols)
    order = _as_list(order_by)
    method = _method(df, method, length_s, slide_s)
    paned = settle_ties(pane_of(df, time_col, length_s, slide_s))
    per_pane = latest_n(paned, n, [*order, TIE], [*series, "__pane"], rank_col=None)
    if method == "blocked":
        return _window_latest_n_blocked(per_pane, time_col, length_s, slide_s, n, order, series, rank_col)
    expanded = expand_panes(per_pane.withColumn("__p", F.col("__pane")), length_s, slide_s)
    ranked = latest_n(expanded, n, [*order, "__p", TIE], [*series, WINDOW_START, WINDOW_END], rank_col=rank_col)
    return ranked.drop("__p", TIE)


def _method(df: DataFrame, method: str, length_s: int, slide_s: int) -> str:
    k, whole = length_s // slide_s, _check(length_s, slide_s) == slide_s
    possible = whole and not any(_has_map(f.dataType) for f in df.schema.fields)
    if method == "auto":
        return "blocked" if possible and k >= BLOCKED_MIN_WINDOWS_PER_PANE else "expand"
    if method == "blocked" and not possible:
        raise ValueError("blocked needs length to be a multiple of slide, and no map columns")
    return method


def _window_arrays(per_pane: DataFrame, length_s: int, slide_s: int, n: int, order: Sequence[str],
                   series: list[str], payload: Sequence[str]) -> DataFrame:
    """``series, window_start, window_end, __rows``: each window's newest rows as one array, newest first.

    ``per_pane`` holds the newest ``n`` rows of each (series, ``__pane``) and ``__tie``.  An
    element is the order columns, pane and tie, then the payload as ``row``; arrays sort
    as ``ORDER BY .. DESC`` does (nulls last, NaN first).
    """
    time_type = per_pane.schema["__pane"].dataType
    element = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col("__pane").alias("pane"),
                       F.col(TIE).alias("tie"), F.struct(*[F.col(c) for c in payload]).alias("row"))
    panes = per_pane.groupBy(*series, "__pane").agg(F.sort_array(F.collect_list(element), asc=False).alias("__rows"))
    panes = panes.withColumn(PANE_INDEX, pane_index(time_type, F.col("__pane"), slide_s)).drop("__pane")
    merged = merge_windows(panes, series, "__rows", length_s // slide_s, newest_rows(n))
    end = pane_time(time_type, F.col(WINDOW_INDEX) + 1, slide_s)
    return merged.select(*series, (end - F.make_dt_interval(secs=F.lit(length_s))).alias(WINDOW_START),
                         end.alias(WINDOW_END), "__rows")


def _window_latest_n_blocked(per_pane: DataFrame, time_col: str, length_s: int, slide_s: int, n: int,
                             order: Sequence[str], series: list[str], rank_col: str) -> DataFrame:
    """Every window's newest rows from blocks of panes (see :func:`window_latest_n`)."""
    payload = [c for c in per_pane.columns if c not in (*series, "__pane", TIE)]
    arrays = _window_arrays(per_pane, length_s, slide_s, n, order, series, payload)
    rows = arrays.select(*series, WINDOW_START, WINDOW_END, F.posexplode("__rows").alias(rank_col, "__row"))
    return rows.select(*series, *[F.col(f"__row.row.{c}").alias(c) for c in payload],
                       F.col(rank_col).cast("long").alias(rank_col), WINDOW_START, WINDOW_END)


def _array_sum(rows: Column, item, kind: str = "double") -> Column:
    """Sum of the items that are not null; null without any (as ``sum``)."""
    add = lambda total, r: F.coalesce((total + item(r)).cast(kind), total, item(r).cast(kind))
    return F.aggregate(rows, F.lit(None).cast(kind), add)


def _metric(name: str, kind: str | None = None):
    """Reads a metric of a row in a window's array."""
    return lambda r: r["row"][name].cast(kind) if kind else r["row"][name]


def _array_avg(rows: Column, metric: str, kind: T.DataType) -> Column:
    """As ``avg`` of the metric: doubles, and decimals as decimals."""
    item = _metric(metric)
    count = F.size(F.filter(rows, lambda r: item(r).isNotNull()))
    if isinstance(kind, T.DecimalType):
        total = _array_sum(rows, item, f"decimal(38,{kind.scale})")
        out = T.DecimalType(min(38, kind.precision + 4), min(38, kind.scale + 4))
        return F.try_divide(total, count.cast("decimal(20,0)")).cast(out)
    return F.try_divide(_array_sum(rows, lambda r: item(r).cast("double")), count)


def _array_model(arrays: DataFrame, name: str, metrics: Sequence[str], n: int, series: Sequence[str],
                 weights: Sequence[float], label_col: str | None, rename: Mapping[str, str] | None,
                 kinds: Mapping[str, T.DataType]) -> DataFrame:
    """The model of each window from its array of newest rows: one row per window, nothing exploded."""
    rows, rows_type = F.col("__rows"), arrays.schema["__rows"].dataType
    keys = [*series, WINDOW_START, WINDOW_END]
    if name == "EWMA":
        limits = []
        for m in metrics:
            values = F.filter(F.transform(rows, _metric(m, "double")), lambda x: x.isNotNull())
            limits.append(F.struct(F.lit(m).alias("field"), _array_avg(rows, m, kinds[m]).alias("mean"),
                                   _array_avg(rows, m, T.DoubleType()).alias("centre"), values.alias("x")))
        long = arrays.select(*keys, F.inline(F.array(*limits)))
        squares = F.aggregate("x", F.lit(0.0), lambda a, x: a + (x - F.col("centre")) * (x - F.col("centre")))
        spread = F.when(F.size("x") > 1, F.sqrt(squares / (F.size("x") - 1)))
        return control_limits(long.select(*keys, "field", "mean", spread.alias("stddev")))
    out = [F.size(rows).cast("long").alias("n_rows")]
    if name in ("WMA", "WMA_FLAT"):
        w = parse_weights(weights)
        d = F.lit(denominator(n, w))
        ends = [n] if name == "WMA_FLAT" else band_bounds(n)
        for m in metrics:
            total = F.lit(None).cast("double")
            for weight, start, stop in zip(w, [0, *ends], ends, strict=False):
                band = F.slice(rows, start + 1, stop - start) if stop > start else F.array().cast(rows_type)
                part = _array_sum(band, _metric(m, "double")) * weight
                total = F.coalesce(total + part, total, part)
            out.append(F.try_divide(total, d).alias(output_name(m, rename)))
    else:
        out += [_array_avg(rows, m, kinds[m]).alias(output_name(m, rename)) for m in metrics]
    if label_col:
        as_time = name in ("WMA", "WMA_FLAT") and isinstance(kinds[label_col], T.StringType)
        label = lambda r: label_to_utc(r["row"][label_col]) if as_time else r["row"][label_col]
        out.append(F.array_max(F.transform(rows, label)).alias(LABEL_COL))
    return arrays.select(*keys, *out)


def window_threshold(
    df: DataFrame,
    model: str,
    time_col: str,
    length_s: int,
    slide_s: int,
    metrics: Sequence[str],
    order_by: str | Sequence[str],
    n: int,
    series_cols: str | Sequence[str] = (),
    weights: Sequence[float] = DEFAULT_WEIGHTS,
    label_col: str | None = None,
    rename: Mapping[str, str] | None = None,
    method: str = "auto",
) -> DataFrame:
    """MA / WMA / WMA_FLAT / EWMA over the newest ``n`` rows of each sliding window.

    Output: ``series.., window_start, window_end, n_rows`` and the model columns
    (EWMA: its limits in long form, one row per metric, without ``n_rows``).
    ``method`` picks how windows are ranked (see :func:`window_latest_n`).
    """
    name = model.strip()
    series = _as_list(series_cols)
    cols = list(dict.fromkeys([*series, time_col, *_as_list(order_by), *metrics,
                               *([label_col] if label_col else [])]))
    used, order = df.select(*cols), _as_list(order_by)
    method = _method(used, method, length_s, slide_s)
    if method == "blocked":
        paned = settle_ties(pane_of(used, time_col, length_s, slide_s))
        per_pane = latest_n(paned, n, [*order, TIE], [*series, "__pane"], rank_col=None)
        payload = list(dict.fromkeys([*metrics, *([label_col] if label_col else [])]))
        arrays = _window_arrays(per_pane, length_s, slide_s, n, order, series, payload)
        kinds = {c: used.schema[c].dataType for c in payload}
        return _array_model(arrays, name, metrics, n, series, weights, label_col, rename, kinds)
    ranked = window_latest_n(used, time_col, length_s, slide_s, n, order_by, series, rank_col="__rank", method=method)
    return aggregate_windows(ranked, name, metrics, n, series, weights, label_col, rename)


def aggregate_windows(ranked: DataFrame, model: str, metrics: Sequence[str], n: int,
                      series: Sequence[str], weights: Sequence[float] = DEFAULT_WEIGHTS,
                      label_col: str | None = None, rename: Mapping[str, str] | None = None) -> DataFrame:
    """Model per (series, window) over rows ranked inside their window."""
    return aggregate_ranked(ranked, model, metrics, n, [*series, WINDOW_START, WINDOW_END], "__rank",
                            weights, label_col, rename, extra_aggs=[F.count(F.lit(1)).alias("n_rows")])
