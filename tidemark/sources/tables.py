"""Parquet table loading and the metric series derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.schema import LABEL_COL, METRIC_COLS
from tidemark.operators.recent import restrict_to_newest_keys

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def order_metrics(spark: SparkSession, sf_dir: str, newest: int | None = None) -> DataFrame:
    """Seven per-order metrics from ``lineitem`` in the fixed metric-record layout.

    One row per ``l_orderkey`` (the order key is the offset): line count, sum
    of quantity, sum of price, average discount, average tax, min and max
    quantity; the label is the last ship date as text.  Grouping is needed
    because ``(l_orderkey, l_linenumber)`` is not unique in the data.

    ``newest=N`` keeps only the N newest orders, selected *before* the
    aggregation (top-k of distinct keys per task; the N-th key then filters a second
    scan), so lineitem is never shuffled in full.  The rows for
    those orders are the same as in the full result.
    """
    li = table(spark, sf_dir, "lineitem")
    if newest is not None:
        li = restrict_to_newest_keys(li, newest, "l_orderkey")
    values = [
        F.count(F.lit(1)).cast("double"),
        F.sum("l_quantity"),
        F.sum("l_extendedprice"),
        F.avg("l_discount"),
        F.avg("l_tax"),
        F.min("l_quantity"),
        F.max("l_quantity"),
    ]
    return li.groupBy(F.col("l_orderkey").alias("offset")).agg(
        F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias(LABEL_COL),
        *[v.alias(m) for v, m in zip(values, METRIC_COLS)],
    )


ORDER_METRICS_SQL = """
SELECT l_orderkey AS "offset",
       strftime(max(l_shipdate), '%Y-%m-%d') AS create_date,
       CAST(count(*) AS DOUBLE) AS cpu_total_pct,
       sum(l_quantity) AS cpu_user_pct,
       sum(l_extendedprice) AS memory_actual_used_pct,
       avg(l_discount) AS memory_swap_total,
       avg(l_tax) AS diskio_read_time,
       min(l_quantity) AS diskio_write_time,
       max(l_quantity) AS filesystem_used_pct
FROM lineitem GROUP BY l_orderkey
"""
