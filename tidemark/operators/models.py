"""Threshold models over the newest N rows.

Every model takes ``(df, metrics, order_by, n, series_cols=())`` and returns
one row per series (one row in total without series).  The latest-N step is
:func:`tidemark.operators.recent.latest_n`; the models themselves are a
single aggregation on top of it, so the whole job is one Catalyst plan with at
most one shuffle on the series key (the aggregation reuses the window's hash
partitioning).

Models
------
``MA``        average of each metric, ``max(label)``.
``WMA``       banded weighted average ``sum(w(rank) * x) / D``, ``max(label)`` as a timestamp.
``WMA_FLAT``  the same with every row weighted by the first weight.
``EWMA``      control limits ``mean +/- 3 * sqrt(l / (2 - l)) * stddev`` (long form).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.schema import (
    LABEL_COL,
    PROCESSING_TS_COL,
    output_name,
    label_to_utc,
    processing_timestamp,
)
from tidemark.functions.weights import (
    DEFAULT_WEIGHTS,
    band_weight,
    denominator,
    ewma_k,
    parse_weights,
)
from tidemark.operators.recent import _as_list, latest_n

SUMMARY_STATS = ("count", "mean", "stddev", "min", "max")
DEFAULT_LAMBDA = 0.3
MODELS = ("MA", "WMA", "WMA_FLAT", "EWMA")


def _group(df: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


LABEL_TIMESTAMP_TYPE = "utc"


def _label_agg(df: DataFrame, label_col: str | None, as_timestamp: bool,
               label_type: str = LABEL_TIMESTAMP_TYPE) -> list[Column]:
    """``max(label)``; text labels are cast to timestamps when ``as_timestamp``.

    By default a zone suffix is honoured and the result is UTC wall-clock time
    (labels without a zone are taken as they are), so it does not depend on
    the session time zone.  ``label_type="timestamp_ntz"`` ignores zones,
    ``"timestamp"`` casts in the session zone.
    """
    if not label_col:
        return []
    c = F.col(label_col)
    if as_timestamp and isinstance(df.schema[label_col].dataType, T.StringType):
        c = label_to_utc(c) if label_type == "utc" else c.try_cast(label_type)
    return [F.max(c).alias(LABEL_COL)]


def _finish(out: DataFrame, processing_stamp: bool) -> DataFrame:
    return out.withColumn(PROCESSING_TS_COL, processing_timestamp()) if processing_stamp else out


def _needed(df: DataFrame, *groups: Sequence[str] | str | None) -> DataFrame:
    cols: list[str] = []
    for g in groups:
        for c in _as_list(g):
            if c not in cols:
                cols.append(c)
    return df.select(*cols)


# ---------------------------------------------------------------- aggregations
# These work on rows that are already the newest N of their group and carry a
# 0-based recency rank; the windowed and streaming paths reuse them.

def ma_aggs(df: DataFrame, metrics: Sequence[str], label_col: str | None = None,
            rename: Mapping[str, str] | None = None) -> list[Column]:
    aggs = [F.avg(m).alias(output_name(m, rename)) for m in metrics]
    return aggs + _label_agg(df, label_col, as_timestamp=False)


def wma_aggs(df: DataFrame, metrics: Sequence[str], n: int, rank_col: str,
             weights: Sequence[float] = DEFAULT_WEIGHTS, flat: bool = False,
             label_col: str | None = None, rename: Mapping[str, str] | None = None,
             label_type: str = LABEL_TIMESTAMP_TYPE) -> list[Column]:
    w = parse_weights(weights)
    weight = F.lit(w[0]) if flat else band_weight(rank_col, n, w)
    d = F.lit(denominator(n, w))
    aggs = [F.try_divide(F.sum(F.col(m) * weight), d).alias(output_name(m, rename)) for m in metrics]
    return aggs + _label_agg(df, label_col, True, label_type)


# ---------------------------------------------------------------- models

def moving_average(
    df: DataFrame,
    metrics: Sequence[str],
    order_by: str | Sequence[str],
    n: int,
    series_cols: str | Sequence[str] | None = (),
    label_col: str | None = None,
    rename: Mapping[str, str] | None = None,
    processing_stamp: bool = False,
    salt_buckets: int = 0,
) -> DataFrame:
    """MA: mean of each metric over the newest ``n`` rows (divides by rows present)."""
    series = _as_list(series_cols)
    base = _needed(df, series, order_by, metrics, label_col)
    top = latest_n(base, n, order_by, series, rank_col=None, salt_buckets=salt_buckets)
    return _finish(_group(top, series, ma_aggs(top, metrics, label_col, rename)), processing_stamp)


def weighted_moving_average(
    df: DataFrame,
    metrics: Sequence[str],
    order_by: str | Sequence[str],
    n: int,
    series_cols: str | Sequence[str] | None = (),
    weights: str | Sequence[float] = DEFAULT_WEIGHTS,
    weighting: str = "banded",
    label_col: str | None = None,
    rename: Mapping[str, str] | None = None,
    processing_stamp: bool = False,
    salt_buckets: int = 0,
    label_type: str = LABEL_TIMESTAMP_TYPE,
) -> DataFrame:
    """WMA: ``sum(w(rank) * x) / D`` over the newest ``n`` rows.

    ``weighting="flat"`` weights every row with the first weight.  ``D`` is
    fixed by ``n`` (see :mod:`tidemark.functions.weights`); ``n < 4`` gives
    ``D = 0`` and a null result.
    """
    if weighting not in ("banded", "flat"):
        raise ValueError("weighting must be 'banded' or 'flat'")
    w = parse_weights(weights)
    series = _as_list(series_cols)
    base = _needed(df, series, order_by, metrics, label_col)
    ranked = latest_n(base, n, order_by, series, rank_col="__rank", salt_buckets=salt_buckets)
    aggs = wma_aggs(ranked, metrics, n, "__rank", w, weighting == "flat", label_col, rename, label_type)
    return _finish(_group(ranked, series, aggs), processing_stamp)


def describe_summary(
    df: DataFrame,
    metrics: Sequence[str],
    order_by: str | Sequence[str] | None = None,
    n: int | None = None,
    series_cols: str | Sequence[str] | None = (),
) -> DataFrame:
    """count / mean / stddev (sample) / min / max per metric, one row per statistic.

    Shape follows ``DataFrame.describe``: a ``metric`` column naming the
    statistic and one double column per input metric, plus the series keys.
    With ``order_by`` and ``n`` only the newest ``n`` rows are summarised.
    """
    series = _as_list(series_cols)
    base = _needed(df, series, order_by, metrics)
    if n is not None:
        base = latest_n(base, n, order_by, series, rank_col=None)
    fns = {
        "count": lambda m: F.count(m).cast("double"),
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "min": lambda m: F.min(m).cast("double"),
        "max": lambda m: F.max(m).cast("double"),
    }
    aggs = [fns[s](m).alias(f"{s}__{m}") for s in SUMMARY_STATS for m in metrics]
    wide = _group(base, series, aggs)
    rows = F.array(*[
        F.struct(F.lit(s).alias("metric"), *[F.col(f"{s}__{m}").alias(m) for m in metrics])
        for s in SUMMARY_STATS
    ])
    return wide.select(*series, F.inline(rows))


def ewma_limits(
    df: DataFrame,
    metrics: Sequence[str],
    order_by: str | Sequence[str] | None = None,
    n: int | None = None,
    series_cols: str | Sequence[str] | None = (),
    lam: float = DEFAULT_LAMBDA,
) -> DataFrame:
    """EWMA control limits per metric: rows ``(series.., field, mean, stddev, ucl, lcl)``.

    ``ucl/lcl = mean +/- 3 * sqrt(lam / (2 - lam)) * stddev_samp``; one row or
    an empty group gives null limits.  Not a recursive EWMA: only the limits.
    """
    series = _as_list(series_cols)
    base = _needed(df, series, order_by, metrics)
    if n is not None:
        base = latest_n(base, n, order_by, series, rank_col=None)
    return ewma_from_rows(base, metrics, series, lam)


def ewma_from_rows(rows: DataFrame, metrics: Sequence[str], group_cols: Sequence[str],
                   lam: float = DEFAULT_LAMBDA) -> DataFrame:
    """One aggregation (mean, stddev per metric), then one row per metric with limits."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"mean__{m}"), F.stddev_samp(m).alias(f"stddev__{m}")]
    wide = _group(rows, group_cols, aggs)
    long = F.array(*[
        F.struct(F.lit(m).alias("field"), F.col(f"mean__{m}").alias("mean"),
                 F.col(f"stddev__{m}").alias("stddev"))
        for m in metrics
    ])
    return control_limits(wide.select(*group_cols, F.inline(long)), lam)


def aggregate_ranked(
    ranked: DataFrame,
    model: str,
    metrics: Sequence[str],
    n: int,
    group_cols: Sequence[str],
    rank_col: str = "__rank",
    weights: Sequence[float] = DEFAULT_WEIGHTS,
    label_col: str | None = None,
    rename: Mapping[str, str] | None = None,
    lam: float = DEFAULT_LAMBDA,
    extra_aggs: Sequence[Column] = (),
    strict: bool = False,
) -> DataFrame:
    """Apply a model to rows that are already the newest ``n`` of each group.

    Unknown names fall back to ``MA`` unless ``strict``.  ``EWMA`` gives its
    limits in long form, without ``extra_aggs`` and label.
    """
    name = model.strip()
    if strict and name not in MODELS:
        raise ValueError(f"unknown model {model!r}; expected one of {MODELS}")
    if name in ("WMA", "WMA_FLAT"):
        aggs = wma_aggs(ranked, metrics, n, rank_col, weights, name == "WMA_FLAT", label_col, rename)
    elif name == "EWMA":
        return ewma_from_rows(ranked, metrics, list(group_cols), lam)
    else:
        aggs = ma_aggs(ranked, metrics, label_col, rename)
    return _group(ranked, list(group_cols), [*extra_aggs, *aggs])


def control_limits(df: DataFrame, lam: float = DEFAULT_LAMBDA,
                   mean_col: str = "mean", stddev_col: str = "stddev") -> DataFrame:
    """Add ``ucl``/``lcl`` from mean and stddev columns (constant lambda)."""
    c = 3 * ewma_k(lam)
    spread = F.lit(c) * F.col(stddev_col)
    return df.withColumn("ucl", F.col(mean_col) + spread).withColumn("lcl", F.col(mean_col) - spread)


def threshold(
    df: DataFrame,
    model: str,
    metrics: Sequence[str],
    order_by: str | Sequence[str],
    n: int,
    series_cols: str | Sequence[str] | None = (),
    weights: str | Sequence[float] = DEFAULT_WEIGHTS,
    label_col: str | None = None,
    lam: float = DEFAULT_LAMBDA,
    strict: bool = False,
    **kw,
) -> DataFrame:
    """Model dispatch by name (trimmed, case-sensitive).  Unknown names fall
    back to ``MA`` like the streaming job does, unless ``strict``."""
    name = model.strip()
    if name not in MODELS:
        if strict:
            raise ValueError(f"unknown model {model!r}; expected one of {MODELS}")
        name = "MA"
    if name == "MA":
        return moving_average(df, metrics, order_by, n, series_cols, label_col, **kw)
    if name in ("WMA", "WMA_FLAT"):
        return weighted_moving_average(df, metrics, order_by, n, series_cols, weights,
                                       "flat" if name == "WMA_FLAT" else "banded", label_col, **kw)
    if any(kw.values()):
        raise ValueError(f"EWMA limits take none of {sorted(kw)}")
    return ewma_limits(df, metrics, order_by, n, series_cols, lam)


def model_table(
    df: DataFrame,
    models: Sequence[str],
    metrics: Sequence[str],
    order_by: str | Sequence[str],
    n: int,
    series_cols: str | Sequence[str] | None = (),
    weights: Sequence[float] = DEFAULT_WEIGHTS,
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Several MA / WMA / WMA_FLAT models from one ranking pass and one aggregation.

    Output rows ``(model, series.., dt_*)``: one shuffle on the series key for
    all models instead of one per model.
    """
    names = [m.strip() for m in models]
    for m in names:
        if m not in ("MA", "WMA", "WMA_FLAT"):
            raise ValueError(f"model_table supports MA, WMA and WMA_FLAT, not {m!r}")
    series = _as_list(series_cols)
    base = _needed(df, series, order_by, metrics)
    ranked = latest_n(base, n, order_by, series, rank_col="__rank")
    outs = [output_name(m, rename) for m in metrics]
    aggs = []
    for name in names:
        if name == "MA":
            cols = ma_aggs(ranked, metrics, None, rename)
        else:
            cols = wma_aggs(ranked, metrics, n, "__rank", weights, name == "WMA_FLAT", None, rename)
        aggs += [c.alias(f"{name}__{o}") for c, o in zip(cols, outs)]
    wide = _group(ranked, series, aggs)
    rows = F.array(*[
        F.struct(F.lit(name).alias("model"), *[F.col(f"{name}__{o}").alias(o) for o in outs])
        for name in names
    ])
    return wide.select(*series, F.inline(rows))
