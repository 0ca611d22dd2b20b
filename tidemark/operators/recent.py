"""Latest-N selection and recency rank.

``latest_n`` keeps the newest ``n`` rows overall or per series, ranked 0 =
newest.  Plans:

* global: ``ORDER BY .. DESC LIMIT n`` -> ``TakeOrderedAndProject``; every
  task keeps its own top n, one task merges ``n x tasks`` rows.
* per series: ``row_number() <= n`` -> Catalyst inserts a *partial*
  ``WindowGroupLimit`` before the shuffle, so each map task ships at most n
  rows per series; a hot series costs ``n x map tasks`` rows after the shuffle.
* ``salt_buckets > 1`` adds a first round keyed by ``(series, salt)`` so that
  even the ``n x map tasks`` rows of a hot series are reduced in parallel
  before the final per-series round (at most ``n x salt_buckets`` rows).
  Catalyst only adds the partial limit for ``n`` up to
  ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000 by default); above
  it the salted plan is used automatically, so a hot series is never sorted
  whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK_COL = "rank"
AUTO_SALT_BUCKETS = 64


def _as_list(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    if isinstance(cols, str):
        return [cols]
    return list(cols)


def _desc(order_by: Sequence[str]) -> list[Column]:
    return [F.col(c).desc() for c in order_by]


def latest_n(
    df: DataFrame,
    n: int,
    order_by: str | Sequence[str],
    series_cols: str | Sequence[str] | None = (),
    rank_col: str | None = RANK_COL,
    salt_buckets: int = 0,
) -> DataFrame:
    """Newest ``n`` rows by ``order_by`` (descending; extra columns break ties).

    Fewer than ``n`` rows keeps them all.  ``rank_col`` (if given) holds
    ``0 .. n-1`` with 0 the newest row.
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    order = _as_list(order_by)
    if not order:
        raise ValueError("order_by is required")
    series = _as_list(series_cols)

    if not series:
        # repartition(1) moves only the n kept rows; it stops Catalyst from
        # pushing later projections (e.g. decoding) below the limit, where
        # they would break the TakeOrderedAndProject pattern into a full sort.
        top = df.orderBy(*_desc(order)).limit(n).repartition(1)
        if rank_col is None:
            return top
        # at most n rows reach this single-partition window
        w = Window.orderBy(*_desc(order))
        return top.withColumn(rank_col, (F.row_number().over(w) - 1).cast("long"))

    if not salt_buckets and n > _group_limit_threshold(df):
        salt_buckets = AUTO_SALT_BUCKETS
    if salt_buckets and salt_buckets > 1:
        salt = F.pmod(F.xxhash64(*order), F.lit(salt_buckets))
        ws = Window.partitionBy(*series, "__salt").orderBy(*_desc(order))
        df = (
            df.withColumn("__salt", salt)
            .withColumn("__rn", F.row_number().over(ws))
            .filter(F.col("__rn") <= n)
            .drop("__salt", "__rn")
        )

    w = Window.partitionBy(*series).orderBy(*_desc(order))
    ranked = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n)
    if rank_col is None:
        return ranked.drop("__rn")
    return ranked.withColumn(rank_col, (F.col("__rn") - 1).cast("long")).drop("__rn")


def _group_limit_threshold(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    return int(conf) if conf is not None and int(conf) >= 0 else 0


def recency_rank(
    df: DataFrame,
    order_by: str | Sequence[str],
    series_cols: str | Sequence[str] | None = (),
    rank_col: str = RANK_COL,
) -> DataFrame:
    """Rank every row, 0 = newest.  Use after :func:`latest_n` (bounded groups)."""
    series = _as_list(series_cols)
    w = Window.partitionBy(*series).orderBy(*_desc(_as_list(order_by)))
    return df.withColumn(rank_col, (F.row_number().over(w) - 1).cast("long"))


def newest_keys(df: DataFrame, n: int, key: str) -> DataFrame:
    """The ``n`` largest distinct values of ``key`` (a null key sorts last).

    Every task keeps the top ``n`` distinct keys of its own rows (Arrow batches,
    only the key column leaves the JVM), so at most ``n`` keys per task are
    shuffled, however many rows or repeats a key has.  Use it to push a
    "newest n groups" limit below an aggregation on ``key``: the result is
    bounded by ``n`` rows and safe to broadcast.
    """
    schema = df.select(key).schema

    def per_task(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        best, has_null = None, False
        for b in batches:
            col = b.column(0)
            has_null = has_null or col.null_count > 0
            vals = pc.unique(col.drop_null())
            if best is not None:
                vals = pc.unique(pa.concat_arrays([best, vals]))
            if len(vals) > n:
                vals = vals.take(pc.top_k_unstable(vals, n))
            best = vals
        if best is None:
            return
        if has_null:
            best = pa.concat_arrays([best, pa.nulls(1, type=best.type)])
        yield pa.RecordBatch.from_arrays([best], names=[key])

    return (df.select(key).mapInArrow(per_task, schema)
            .distinct().orderBy(F.col(key).desc_nulls_last()).limit(n))


def restrict_to_newest_keys(df: DataFrame, n: int, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is among its ``n`` largest distinct keys (null: the smallest).

    The n-th key becomes a scalar filter on the scan: nothing is broadcast or
    shuffled for it, and files or row groups of older keys can be skipped.
    """
    keys = newest_keys(df, n, key)
    least = keys.agg(F.min(key)).scalar()
    known = keys.agg(F.count(key)).scalar()
    return df.where((F.col(key) >= least) | (F.col(key).isNull() & (known < n)))


def semi_join(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose ``on`` columns occur in ``keys``; nulls equal nulls."""
    renamed = keys.select(*[F.col(c).alias(f"__semi_{i}") for i, c in enumerate(on)])
    same = F.lit(True)
    for i, c in enumerate(on):
        same = same & F.col(c).eqNullSafe(F.col(f"__semi_{i}"))
    return df.join(renamed, same, "left_semi")
