"""Moving averages at every record: each row's model over the N rows up to and including it.

Rows get exact positions (a range shuffle, see ``row_positions``) and are cut
into blocks of successive positions, each with the last N - 1 rows of the block
before it as a halo.  So a series of any length spreads over tasks, and a row
is copied at most once.

A band of ``w`` ranks is a sum over ``w`` successive rows.  Positions fall into
groups of ``w``; such a sum is the suffix of one group plus the prefix of the
next, so it costs the same for every N, and only rows of the band are added:
one huge value never spoils the rows around it, as differences of running sums
would.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.schema import output_name
from tidemark.functions.weights import DEFAULT_WEIGHTS, band_bounds, denominator, parse_weights
from tidemark.operators.recent import _as_list
from tidemark.operators.reshape import row_positions

#: Rows of a block (at least N are taken).
BLOCK_ROWS = 4096


def _plus(a: Column, b: Column) -> Column:
    """Sum that ignores a null side, as ``sum`` does."""
    return F.coalesce(a + b, a, b)


def _trailing_sums(df: DataFrame, values: Mapping[str, Column], width: int, part: Sequence[str]) -> DataFrame:
    """``df`` with, per name, the sum of its value over the ``width`` rows ending at each row."""
    group = F.floor(F.col("__pos") / F.lit(width))
    up = Window.partitionBy(*part, "__group").orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*part, "__group").orderBy(F.desc("__pos")).rowsBetween(Window.unboundedPreceding, 0)
    line = Window.partitionBy(*part).orderBy("__pos")
    sums = df.withColumn("__group", group)
    sums = sums.select("*", *[F.sum(v).over(down).alias(f"__down_{k}") for k, v in values.items()])
    sums = sums.select("*", *[F.sum(v).over(up).alias(f"__up_{k}") for k, v in values.items()])
    if width == 1:
        found = {k: F.col(f"__up_{k}") for k in values}
    else:
        whole = F.pmod("__pos", F.lit(width)) == F.lit(width - 1)
        sums = sums.select("*", *[F.lag(f"__down_{k}", width - 1).over(line).alias(f"__before_{k}") for k in values])
        found = {k: F.when(whole, F.col(f"__up_{k}")).otherwise(_plus(F.col(f"__up_{k}"), F.col(f"__before_{k}")))
                 for k in values}
    return sums.select(*df.columns, *[c.alias(k) for k, c in found.items()])


def rolling_threshold(
    df: DataFrame,
    model: str,
    metrics: Sequence[str],
    order_by: str | Sequence[str],
    n: int,
    series_cols: str | Sequence[str] | None = (),
    weights: str | Sequence[float] = DEFAULT_WEIGHTS,
    keep: Sequence[str] = (),
    rename: Mapping[str, str] | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``MA``, ``WMA`` or ``WMA_FLAT`` at every record: ``series.., order.., keep.., dt_*``.

    A row gets what the batch model gives if it is the newest one: bands count
    back from it, the denominator is fixed by ``n`` (null for a WMA of
    ``n < 4``), rows before the first do not count, null metrics are left out
    and a window without any value gives null.  A null series is a series.
    ``order_by`` must be unique within a series (repeated rows get successive
    places in no fixed order); nulls come first.  Runs one write job when called.
    """
    name = model.strip()
    if name not in ("MA", "WMA", "WMA_FLAT"):
        raise ValueError(f"rolling models are MA, WMA and WMA_FLAT, not {model!r}")
    if n < 1 or block_rows < 1:
        raise ValueError("n and block_rows must be >= 1")
    series, order = _as_list(series_cols), _as_list(order_by)
    own = list(dict.fromkeys([*series, *order, *keep]))
    base = df.select(*own, *[F.col(m).cast("double").alias(f"__m{i}") for i, m in enumerate(metrics)])
    placed = row_positions(base, order, series, "__pos")
    rows = max(block_rows, n)
    block = F.floor(F.col("__pos") / F.lit(rows))
    ends = F.pmod("__pos", F.lit(rows)) > F.lit(rows - n)
    cut = placed.withColumn("__block", F.explode(F.when(ends, F.array(block, block + 1)).otherwise(F.array(block))))
    part = [*series, "__block"]
    # One shuffle by block serves every window below, whatever else it is partitioned by.
    cut = cut.repartition(*part)
    line = Window.partitionBy(*part).orderBy("__pos")
    columns = [f"__m{i}" for i in range(len(metrics))]

    if name in ("MA", "WMA_FLAT"):
        values = {f"__s{c}": F.col(c) for c in columns}
        counts = {f"__n{c}": F.when(F.col(c).isNotNull(), F.lit(1)) for c in columns} if name == "MA" else {}
        cut = _trailing_sums(cut, values | counts, n, part)
        flat = F.lit(parse_weights(weights)[0])
        result = [F.try_divide(F.col(f"__s{c}"), F.col(f"__n{c}")) if name == "MA"
                  else F.try_divide(F.col(f"__s{c}") * flat, F.lit(denominator(n, weights))) for c in columns]
    elif n < 4:
        result = [F.lit(None).cast("double") for _ in columns]
    else:
        first, bounds = 0, band_bounds(n)
        bands = []
        for weight, bound in zip(parse_weights(weights), bounds, strict=True):
            bands.append((first, bound - first, weight))
            first = bound
        for width in sorted({w for _, w, _ in bands}):
            cut = _trailing_sums(cut, {f"__s{width}{c}": F.col(c) for c in columns}, width, part)
        result = []
        for c in columns:
            total = None
            for back, width, weight in bands:
                band = F.lag(f"__s{width}{c}", back).over(line) * F.lit(weight) if back else F.col(f"__s{width}{c}") * F.lit(weight)
                total = band if total is None else _plus(total, band)
            result.append(F.try_divide(total, F.lit(denominator(n, weights))))
    outs = [r.alias(output_name(m, rename)) for r, m in zip(result, metrics, strict=True)]
    done = cut.select("__pos", "__block", *own, *outs)
    return done.where(block == F.col("__block")).drop("__pos", "__block")
