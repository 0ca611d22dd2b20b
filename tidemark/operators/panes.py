"""Sliding windows from pane values: two-pass prefix / suffix merges inside blocks of panes.

A window of ``k`` panes spans at most two blocks of ``k`` panes each: the end of
one and the beginning of the next.  With the running merges of a block from its
first pane (prefixes) and from its last (suffixes), each window is one merge of
a suffix and a prefix.  So a window costs three merges however many panes it
has, and a pane is copied at most twice (its own block, and the next one's
windows) instead of once per window.

Any value with an associative, commutative merge will do: the newest N rows of a
pane as a sorted array, or count, mean and squared deviations.  All of it is
Spark expressions, so keys, orders and payloads keep their exact types.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PANE_INDEX = "__pidx"
WINDOW_INDEX = "__widx"


def pane_index(time_type: T.DataType, pane: Column, pane_s: int) -> Column:
    """Pane number of a pane's start: epoch seconds for zoned timestamps, wall-clock
    fields for ``timestamp_ntz`` (no time zone involved either way)."""
    if isinstance(time_type, T.TimestampType):
        secs = F.unix_seconds(pane)
    else:
        secs = (F.datediff(F.to_date(pane), F.lit("1970-01-01").cast("date")).cast("long") * 86400
                + F.hour(pane) * 3600 + F.minute(pane) * 60 + F.second(pane).cast("long"))
    return F.floor(secs / F.lit(pane_s)).cast("long")


def pane_time(time_type: T.DataType, index: Column, pane_s: int) -> Column:
    """Start of the pane of this number (inverse of :func:`pane_index`)."""
    secs = (index * F.lit(pane_s)).cast("long")
    if isinstance(time_type, T.TimestampType):
        return F.timestamp_seconds(secs)
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=secs)


def barrier(df: DataFrame, *keep: str, **values: Column) -> DataFrame:
    """``keep`` columns and ``values``, each evaluated once per row.

    A projection could be merged with the one that reads it and so move into a
    lambda or be copied; a generator (one struct per row) is left where it is.
    """
    one = F.array(F.struct(*[v.alias(n) for n, v in values.items()]))
    return df.select(*keep, F.inline(one))


def _nullable(t: T.DataType) -> T.DataType:
    """The type with nulls allowed everywhere (a merge may not keep what a pane promises)."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType)) for f in t.fields])
    return T.ArrayType(_nullable(t.elementType)) if isinstance(t, T.ArrayType) else t


def merge_windows(panes: DataFrame, series: Sequence[str], value: str, k: int,
                  merge: Callable[[Column, Column], Column]) -> DataFrame:
    """``series, __widx, value`` of every window of ``k`` panes that holds a pane.

    ``panes`` has one row per series and pane (``__pidx``); ``__widx`` is the number of a
    window's last pane.  A task sees one series' two blocks of panes at a time.
    """
    kind = _nullable(panes.schema[value].dataType)
    entry = T.ArrayType(T.StructType([T.StructField("pos", T.LongType()), T.StructField("v", kind)]))
    block = F.floor(F.col(PANE_INDEX) / F.lit(k)).cast("long")
    pos = F.col(PANE_INDEX) - block * F.lit(k)
    own = F.struct(block.alias("block"), F.lit(True).alias("own"))
    following = F.struct((block + 1).alias("block"), F.lit(False).alias("own"))
    copies = F.when(pos > 0, F.array(own, following)).otherwise(F.array(own))
    placed = panes.select(*series, F.col(value).alias("__v"), pos.alias("__pos"), F.inline(copies).alias("__blk", "__own"))
    item = lambda p: F.struct(p.alias("pos"), F.col("__v").alias("v"))
    grouped = placed.groupBy(*series, "__blk").agg(
        F.sort_array(F.collect_list(F.when(F.col("__own"), item(F.col("__pos"))))).alias("__first"),
        F.sort_array(F.collect_list(F.when(~F.col("__own"), item(-F.col("__pos"))))).alias("__last"))

    def running(items: Column) -> Column:
        def add(done: Column, x: Column) -> Column:
            before = F.try_element_at(done, F.lit(-1))
            value = F.when(before.isNull(), x["v"]).otherwise(merge(before["v"], x["v"]))
            return F.concat(done, F.array(F.struct(x["pos"].alias("pos"), value.alias("v"))).cast(entry))

        return F.aggregate(items, F.array().cast(entry), add)

    merged = barrier(grouped, *series, "__blk", __prefix=running(F.col("__first")), __suffix=running(F.col("__last")))

    def both(j: Column) -> Column:
        # Prefixes lie by rising position; suffixes by falling position, stored negative.
        right = F.try_element_at(F.filter("__prefix", lambda x: x["pos"] <= j), F.lit(-1))["v"]
        left = F.try_element_at(F.filter("__suffix", lambda x: -x["pos"] > j), F.lit(-1))["v"]
        return F.struct(j.alias("j"), left.alias("l"), right.alias("r"))

    halves = merged.select(*series, "__blk", F.inline(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), both)))
    halves = halves.where(F.col("l").isNotNull() | F.col("r").isNotNull())
    joined = (F.when(F.col("l").isNull(), F.col("r")).when(F.col("r").isNull(), F.col("l"))
              .otherwise(merge(F.col("l"), F.col("r"))))
    index = (F.col("__blk") * F.lit(k) + F.col("j")).alias(WINDOW_INDEX)
    # Evaluated once, however many columns are read from it.
    return barrier(halves.select(*series, index, "l", "r"), *series, WINDOW_INDEX, **{value: joined})


# --- newest rows -------------------------------------------------------------

def newest_rows(n: int) -> Callable[[Column, Column], Column]:
    """Merge of two arrays of rows, newest first: the newest ``n`` of both."""
    return lambda a, b: F.slice(F.sort_array(F.concat(a, b), asc=False), 1, n)


# --- moments -----------------------------------------------------------------

MOMENTS = "n long, mean double, m2 double, lo double, hi double"


def moments(metric: str) -> Column:
    """Count, mean, sum of squared deviations, least and largest value of a metric (an aggregate)."""
    x = F.col(metric).cast("double")
    n = F.count(x)
    return F.struct(n.alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * n).alias("m2"),
                    F.min(x).alias("lo"), F.max(x).alias("hi"))


def merge_moments(a: Column, b: Column) -> Column:
    """Moments of both parts, from theirs alone (pairwise update, stable for large means)."""
    n = a["n"] + b["n"]
    delta = b["mean"] - a["mean"]
    merged = F.struct(
        n.alias("n"), (a["mean"] + delta * b["n"] / n).alias("mean"),
        (a["m2"] + b["m2"] + delta * delta * a["n"] * b["n"] / n).alias("m2"),
        F.least(a["lo"], b["lo"]).alias("lo"), F.greatest(a["hi"], b["hi"]).alias("hi"))
    return F.when(a["n"] == 0, b).when(b["n"] == 0, a).otherwise(merged)


def stddev_samp(m: Column) -> Column:
    """Sample standard deviation from moments; null for fewer than two values."""
    return F.when(m["n"] > 1, F.sqrt(m["m2"] / (m["n"] - 1)))
