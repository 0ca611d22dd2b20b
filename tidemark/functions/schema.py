"""Fixed metric-record schema, output names and label/date expressions.

The metric record is a label string plus seven doubles.  Output columns of
the threshold models carry a ``dt_`` name from an explicit map (the names are
irregular, so a prefix rule would be wrong for two of them).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: names that must match the metric records and the output
# documents exactly (record order = value order in the comma-separated string)
LABEL_COL = "create_date"
PROCESSING_TS_COL = "@timestamp"
METRIC_COLS = (
    "cpu_total_pct",
    "cpu_user_pct",
    "memory_actual_used_pct",
    "memory_swap_total",
    "diskio_read_time",
    "diskio_write_time",
    "filesystem_used_pct",
)
OUTPUT_NAMES = {
    "cpu_total_pct": "dt_cpu_total_pct",
    "cpu_user_pct": "dt_cpu_user_pct",
    "memory_actual_used_pct": "dt_mem_actual_used_pct",
    "memory_swap_total": "dt_mem_swap_used_pct",
    "diskio_read_time": "dt_diskio_read_time",
    "diskio_write_time": "dt_diskio_write_time",
    "filesystem_used_pct": "dt_fs_used_pct",
}
PROCESSING_TS_PATTERN = "y-MM-dd'T'HH:mm:ssZ"
DAY_PATTERN = "yyyy_MM_dd"
DAILY_INDEX_PREFIX = "poc_os_metric_dt_"
# --- end of fixed values


def metric_schema(metrics: Sequence[str] = METRIC_COLS, label: str | None = LABEL_COL) -> T.StructType:
    """Label (string) followed by one nullable double per metric."""
    fields = [T.StructField(label, T.StringType(), True)] if label else []
    fields += [T.StructField(m, T.DoubleType(), True) for m in metrics]
    return T.StructType(fields)


METRIC_SCHEMA = metric_schema()


def output_name(metric: str, rename: Mapping[str, str] | None = None) -> str:
    """Output column for ``metric``: explicit map first, then ``dt_<metric>``."""
    if rename and metric in rename:
        return rename[metric]
    return OUTPUT_NAMES.get(metric, f"dt_{metric}")


def processing_timestamp() -> Column:
    """Wall-clock stamp of the run, formatted like ``2026-12-01T13:07:10+0000``."""
    return F.from_unixtime(F.unix_timestamp(), PROCESSING_TS_PATTERN)


def day_bucket(ts: Column | str) -> Column:
    """``yyyy_MM_dd`` day string used to name daily result partitions."""
    return F.date_format(ts, DAY_PATTERN)


def daily_index_name(ts: Column | str, prefix: str = DAILY_INDEX_PREFIX) -> Column:
    return F.concat(F.lit(prefix), day_bucket(ts))


def label_to_timestamp(label: Column | str, ntz: bool = False) -> Column:
    """Lenient cast of a text label to a timestamp; unparseable labels become null."""
    c = F.col(label) if isinstance(label, str) else label
    return c.try_cast("timestamp_ntz" if ntz else "timestamp")


def label_to_utc(label: Column | str) -> Column:
    """Lenient cast of a text label to UTC wall-clock time (``timestamp_ntz``).

    A zone suffix (``Z``, ``+09:00``, a region name) is converted; labels without
    one are taken as they are, in any session time zone.
    """
    c = F.trim(F.col(label) if isinstance(label, str) else label)
    zoned = c.rlike(r"(?i)\d(z|[ ]?(utc|gmt|ut)([+-][\d:]+)?|[ ]?[+-]\d{1,2}(:?\d{2}){0,2}|[ ]?[a-z]+/[a-z_/]+)$") & c.contains(":")
    instant = F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.try_cast("timestamp").cast("timestamp_ntz"))
    return F.when(zoned, instant).otherwise(c.try_cast("timestamp_ntz"))
