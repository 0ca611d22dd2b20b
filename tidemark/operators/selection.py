"""The newest N rows for an N beyond what one task can hold.

``latest_n`` merges N rows in one task.  Here the N-th newest key is found
first: a quantile sketch gives pivots, exact counts above each pivot tell which
two enclose the N-th key, and the range between them is searched again until it
is small.  Rows above that key are then a plain filter, where they lie.  Only
pivots and their counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.recent import RANK_COL, _as_list
from tidemark.operators.reshape import row_positions

PIVOTS = 63
#: A range of at most so many rows is finished by one top-k.
FINISH_ROWS = 100_000


def _same(a: Any, b: Any) -> bool:
    """Equal, NaN included."""
    return a == b or (a != a and b != b)


def _number(df: DataFrame, column: str) -> Column:
    """A number in the order of the column, so that values pass through the driver unchanged."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        since = c - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return (since.cast("interval second").cast("decimal(20,6)") * F.lit(1_000_000)).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    if isinstance(kind, T.NumericType):
        return c
    raise TypeError(f"newest_rows orders by numbers, dates and timestamps, not {column!r} ({kind.simpleString()})")


def nth_largest(df: DataFrame, key: Column, n: int, finish_rows: int = FINISH_ROWS) -> tuple[Any, int, int]:
    """The ``n``-th largest of ``key`` (null left out), how many rows are above it, and how many equal it.

    ``df`` must hold at least ``n`` rows with a key.  Every round leaves out at
    least the largest key, in practice all but a 64th of the rows.
    """
    df, above = df.select(key.alias("k")).where(F.col("k").isNotNull()), 0
    k = F.col("k")
    shares = F.array(*[F.lit((i + 1) / (PIVOTS + 1)) for i in range(PIVOTS)])
    part = df
    while True:
        seen = part.agg(F.count("k").alias("rows"), F.min("k").alias("least"), F.max("k").alias("most"),
                        F.percentile_approx("k", shares, 1000).alias("pivots")).first()
        if _same(seen["least"], seen["most"]) or seen["rows"] <= finish_rows:
            break
        below = {seen["least"], *(p for p in seen["pivots"] if p == p)} - {seen["most"]}
        pivots = [*sorted(below), seen["most"]]
        counts = part.agg(*[F.count_if(k >= F.lit(p)).alias(f"c{i}") for i, p in enumerate(pivots)]).first()
        at = max(i for i, c in enumerate(counts) if above + c >= n)
        part = part.where(k >= F.lit(pivots[at]))
        if at + 1 < len(pivots):
            above += counts[at + 1]
            part = part.where(k < F.lit(pivots[at + 1]))
    value = seen["least"]
    if not _same(value, seen["most"]):
        value = part.orderBy(k.desc()).limit(n - above).agg(F.min("k")).first()[0]
    higher, equal = df.agg(F.count_if(k > F.lit(value)), F.count_if(k == F.lit(value))).first()
    return value, higher, equal


def newest_rows(df: DataFrame, n: int, order_by: str | Sequence[str], rank_col: str | None = RANK_COL,
                finish_rows: int = FINISH_ROWS) -> DataFrame:
    """The newest ``n`` rows by ``order_by``, for any ``n``; fewer rows are all kept.

    Same rows and ranks (0 the newest) as ``latest_n`` without series, for
    orders by numbers, dates and timestamps (nulls oldest, NaN newest).  Rows
    tied in the order are chosen by the hash of all their columns (maps left
    out), so reruns agree.  ``df`` is scanned some times: stage it before if it is
    costly.  Ranks are exact positions after a range shuffle of the kept rows,
    and no task holds them all.  Runs jobs when called.
    """
    from tidemark.session import scratch_path

    if n < 0:
        raise ValueError("n must be >= 0")
    order = _as_list(order_by)
    if not order:
        raise ValueError("order_by is required")
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields
              if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    keys = [_number(df, c) for c in order] + ([F.xxhash64(*hashed)] if hashed else [])
    total, need = df.count(), n
    chosen, tied = F.lit(False), F.lit(True)
    for key in keys:
        rows, known = df.where(tied).agg(F.count(F.lit(1)), F.count(key)).first()
        if need >= rows or not need:
            break
        if need > known:
            chosen, tied, need = chosen | (tied & key.isNotNull()), tied & key.isNull(), need - known
            continue
        if need == known:
            chosen, tied, need = chosen | (tied & key.isNotNull()), F.lit(False), 0
            break
        value, higher, _ = nth_largest(df.where(tied), key, need, finish_rows)
        chosen, tied, need = chosen | (tied & (key > F.lit(value))), tied & key.eqNullSafe(F.lit(value)), need - higher
    rest = df.where(tied).count() if need else 0
    if not need:
        kept = df.where(F.coalesce(chosen, F.lit(False)))
    elif need >= rest:
        kept = df.where(F.coalesce(chosen | tied, F.lit(False)))
    else:
        # Rows equal in all columns: any will do, told apart by a number of their own.
        path = scratch_path(df.sparkSession, "tied-rows")
        df.where(tied).withColumn("__tie", F.monotonically_increasing_id()).write.parquet(path)
        same = df.sparkSession.read.parquet(path)
        value, _, _ = nth_largest(same, F.col("__tie"), need, finish_rows)
        kept = df.where(F.coalesce(chosen, F.lit(False))).unionByName(same.where(F.col("__tie") >= F.lit(value)).drop("__tie"))
    if rank_col is None:
        return kept
    last = min(n, total) - 1
    return row_positions(kept, order, (), "__place").withColumn(rank_col, F.lit(last).cast("long") - F.col("__place")).drop("__place")
