"""Reshaping: summary to long form, transpose, fixed-size blocks, date index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.recent import _as_list


def summary_to_long(summary: DataFrame, fields: Sequence[str],
                    id_cols: str | Sequence[str] = ("metric",)) -> DataFrame:
    """Wide summary (one column per field) to rows ``(ids.., field, value)``."""
    ids = _as_list(id_cols)
    return summary.unpivot(ids, list(fields), "field", "value")


def mean_stddev_rows(long_summary: DataFrame, stat_col: str = "metric") -> DataFrame:
    """Keep only the mean and stddev rows of a long summary."""
    return long_summary.filter(F.col(stat_col).isin("mean", "stddev"))


def transpose(df: DataFrame, fields: Sequence[str], position_col: str, n_positions: int,
              series_cols: str | Sequence[str] = ()) -> DataFrame:
    """Instants x fields -> fields x instants.

    One output row per (series, field) with a column ``p<i>`` per position
    ``0 .. n_positions-1`` (null where a position is missing).  Written as one
    conditional aggregation over an explicit position list, so it adds no
    shuffle when the input is already partitioned by the series (as the
    output of a per-series ``latest_n`` is).  A position of ``n_positions`` or
    more fails the query, so no instant is left out silently.
    """
    series = _as_list(series_cols)
    pos = F.col(position_col)
    aggs = [F.max(F.when(pos == F.lit(i), F.col(f))).alias(f"{f}__p{i}")
            for f in fields for i in range(n_positions)]
    aggs.append(F.max(pos).alias("__top"))
    wide = df.groupBy(*series).agg(*aggs) if series else df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(f).alias("field"),
                 *[F.col(f"{f}__p{i}").cast("double").alias(f"p{i}") for i in range(n_positions)])
        for f in fields
    ])
    too_far = F.raise_error(F.concat(F.lit(f"transpose has {n_positions} positions, got position "),
                                     F.col("__top").cast("string")))
    return wide.select(*series, F.inline(F.when(F.col("__top") >= n_positions, too_far).otherwise(rows)))


def chunk_blocks(df: DataFrame, fields: Sequence[str], position_col: str, size: int,
                 series_cols: str | Sequence[str] = ()) -> DataFrame:
    """Group consecutive positions into blocks of ``size`` rows (the last may be short).

    Output per block: ``block``, ``n_rows`` and one array column per field with
    the values in position order.  Each group holds at most ``size`` rows.
    """
    if size < 1:
        raise ValueError("size must be >= 1")
    series = _as_list(series_cols)
    blk = df.withColumn("block", F.floor(F.col(position_col) / F.lit(size)).cast("long"))
    rows = F.array_sort(F.collect_list(F.struct(F.col(position_col).alias("pos"),
                                                *[F.col(f) for f in fields])))
    grouped = blk.groupBy(*series, "block").agg(rows.alias("__rows"))
    return grouped.select(
        *series, "block", F.size("__rows").cast("long").alias("n_rows"),
        *[F.transform("__rows", _field_getter(f)).alias(f) for f in fields],
    )


def _field_getter(name: str):
    return lambda r: r.getField(name)


def row_positions(df: DataFrame, order_by: str | Sequence[str],
                  series_cols: str | Sequence[str] = (), position_col: str = "pos",
                  work_path: str | None = None) -> DataFrame:
    """0-based ascending position of each row inside its series.

    ``order_by`` must be unique within a series.  No series is ever sorted in
    one task: rows are range-partitioned on ``(series, order)`` (a hot series
    spreads over many tasks), sorted inside each task and numbered there with
    ``monotonically_increasing_id``.  The numbered rows are written once as a
    table in the shared checkpoint folder (``work_path``): the per-task,
    per-series counts and the rows themselves are then read from the same
    files, so both agree on task ids even though a range shuffle's sampling
    differs from one shuffle to the next.  A prefix sum over the small count
    table gives each slice its starting offset; it is joined back on
    ``(task, series)``.  Runs one write job when called.
    """
    from tidemark.session import scratch_path

    series = _as_list(series_cols)
    order = _as_list(order_by)
    spark = df.sparkSession
    path = work_path or scratch_path(spark, "row-positions")
    (df.repartitionByRange(*series, *order)
       .sortWithinPartitions(*series, *order)
       .withColumn("__pid", F.spark_partition_id())
       .withColumn("__row", F.monotonically_increasing_id())
       .write.mode("overwrite").parquet(path))
    numbered = spark.read.parquet(path)
    slices = numbered.groupBy("__pid", *series).agg(F.count(F.lit(1)).alias("__cnt"),
                                                   F.min("__row").alias("__first"))
    before = Window.partitionBy(*series).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.withColumn("__off", F.coalesce(F.sum("__cnt").over(before), F.lit(0)))
    # null-safe: a null series is a series like any other
    found = offsets.select(F.col("__pid").alias("__k"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(series)],
                           "__off", "__first")
    same = F.col("__pid") == F.col("__k")
    for i, c in enumerate(series):
        same = same & F.col(c).eqNullSafe(F.col(f"__k{i}"))
    return (numbered.join(found, same)
            .withColumn(position_col, F.col("__off") + F.col("__row") - F.col("__first"))
            .drop("__pid", "__row", "__first", "__off", "__k", *[f"__k{i}" for i in range(len(series))]))


def business_day_index(starts: DataFrame, start_col: str, periods: int, step: int = 1,
                       out_col: str = "day") -> DataFrame:
    """Uniform business-day index: ``periods`` dates from ``start_col`` every ``step``
    business days (Mon-Fri).  A start on a weekend rolls to the next Monday.

    Built from a bounded ``sequence`` per start row: ``periods * step``
    business days fit in ``periods * step * 7 // 5 + 7`` calendar days (the
    extra week covers a weekend start and the rounding).
    """
    if periods < 0 or step < 1:
        raise ValueError("periods must be >= 0 and step >= 1")
    span = (periods * step * 7) // 5 + 7
    start = F.to_date(F.col(start_col))
    days = F.sequence(start, F.date_add(start, span))
    # dayofweek: 1 = Sunday .. 7 = Saturday
    bdays = F.filter(days, lambda d: ~F.dayofweek(d).isin(1, 7))
    picked = F.slice(
        F.filter(bdays, lambda d, i: (i % F.lit(step)) == 0), 1, periods)
    return starts.select("*", F.posexplode(picked).alias("period", out_col))
