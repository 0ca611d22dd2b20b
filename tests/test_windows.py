"""Pane-based sliding windows vs Spark's own window expansion (brute force)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators.windows import (
    sliding_aggregate,
    sliding_limits,
    sliding_summary,
    window_latest_n,
    window_threshold,
)
from tidemark.sources.tables import table


def native_windows(ev, length_s, slide_s, series=()):
    w = F.window("ts", f"{length_s} seconds", f"{slide_s} seconds")
    return ev.select("*", w.start.alias("window_start"), w.end.alias("window_end"))


@pytest.mark.parametrize("length_s,slide_s,series", [
    (1200, 60, ()),
    (3600, 600, ("event_type",)),
    (1500, 600, ("event_type",)),   # length not a multiple of slide: panes of gcd = 300 s
])
def test_sliding_aggregate_matches_native(spark, length_s, slide_s, series):
    ev = table(spark, SF_SMALL, "events")
    ours = sliding_aggregate(ev, "ts", length_s, slide_s, ["value"], list(series))
    ref = native_windows(ev, length_s, slide_s).groupBy(*series, "window_start", "window_end").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("value_sum"),
        F.min("value").alias("value_min"), F.max("value").alias("value_max"))
    cols = [*series, "window_start", "window_end", "n_rows", "value_min", "value_max"]
    assert sorted(ours.select(*cols).collect()) == sorted(ref.select(*cols).collect())
    a = {tuple(r[:-1]): r[-1] for r in ours.select(*series, "window_start", "value_sum").collect()}
    b = {tuple(r[:-1]): r[-1] for r in ref.select(*series, "window_start", "value_sum").collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k] == pytest.approx(b[k], rel=1e-12)


@pytest.mark.parametrize("length_s,slide_s,n", [(3600, 600, 3), (7200, 1800, 5), (1500, 600, 2)])
def test_window_latest_n_matches_brute_force(spark, length_s, slide_s, n):
    ev = table(spark, SF_SMALL, "events")
    ours = window_latest_n(ev, "ts", length_s, slide_s, n, "event_id", "event_type")
    w = Window.partitionBy("event_type", "window_start").orderBy(F.desc("event_id"))
    ref = (native_windows(ev, length_s, slide_s)
           .withColumn("rank", (F.row_number().over(w) - 1).cast("long")).filter(F.col("rank") < n))
    cols = ["event_type", "window_start", "window_end", "event_id", "rank"]
    assert sorted(ours.select(*cols).collect()) == sorted(ref.select(*cols).collect())


def test_window_threshold_counts(spark):
    ev = table(spark, SF_SMALL, "events")
    out = window_threshold(ev, "MA", "ts", 3600, 600, ["value"], "event_id", 4)
    assert out.agg(F.max("n_rows")).first()[0] <= 4
    assert set(out.columns) == {"window_start", "window_end", "n_rows", "dt_value"}


@pytest.mark.parametrize("length_s,slide_s,n,series", [
    (6000, 60, 5, ("event_type",)), (3600, 120, 3, ()), (1200, 60, 2, ("event_type",))])
def test_blocked_window_latest_n_matches_brute_force(spark, length_s, slide_s, n, series):
    ev = table(spark, SF_SMALL, "events")
    ours = window_latest_n(ev, "ts", length_s, slide_s, n, "event_id", list(series), method="blocked")
    w = Window.partitionBy(*series, "window_start").orderBy(F.desc("event_id"))
    ref = (native_windows(ev, length_s, slide_s)
           .withColumn("rank", (F.row_number().over(w) - 1).cast("long")).filter(F.col("rank") < n))
    cols = [*series, "window_start", "window_end", "event_id", "rank"]
    assert sorted(ours.select(*cols).collect()) == sorted(ref.select(*cols).collect())


def test_blocked_on_zoned_timestamps_in_a_dst_zone(spark):
    # shifted by 80 days the events span 2024-03-31, when Berlin moves its clocks
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    ev = table(spark, SF_SMALL, "events").withColumn(
        "ts", (F.col("ts") + F.make_dt_interval(days=F.lit(80))).cast("timestamp"))
    assert ev.filter(F.col("ts").cast("string").startswith("2024-03-31")).count() > 0
    try:
        ours = window_latest_n(ev, "ts", 1200, 60, 3, "event_id", ["event_type"], method="blocked")
        w = Window.partitionBy("event_type", "window_start").orderBy(F.desc("event_id"))
        ref = (native_windows(ev, 1200, 60)
               .withColumn("rank", (F.row_number().over(w) - 1).cast("long")).filter(F.col("rank") < 3))
        cols = ["event_type", "window_start", "window_end", "event_id", "rank"]
        assert sorted(ours.select(*cols).collect()) == sorted(ref.select(*cols).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_window_threshold_methods_agree(spark):
    ev = table(spark, SF_SMALL, "events")
    cols = ["event_type", "window_start", "window_end", "n_rows", "dt_value"]
    a = window_threshold(ev, "WMA", "ts", 3600, 180, ["value"], "event_id", 4, "event_type", method="blocked")
    b = window_threshold(ev, "WMA", "ts", 3600, 180, ["value"], "event_id", 4, "event_type", method="expand")
    ra = sorted((r[0], r[1], r[2], r[3], round(r[4], 9)) for r in a.select(*cols).collect())
    rb = sorted((r[0], r[1], r[2], r[3], round(r[4], 9)) for r in b.select(*cols).collect())
    assert ra == rb


def rows_of(df, digits=9):
    fix = lambda x: round(x, digits) if isinstance(x, float) else x
    return sorted(repr(tuple(fix(r[c]) for c in sorted(df.columns))) for r in df.collect())


@pytest.mark.parametrize("model", ["MA", "WMA", "WMA_FLAT", "EWMA"])
@pytest.mark.parametrize("series", [[], ["at"], ["dec"], ["f"], ["name"]])
def test_models_of_both_methods_agree_for_any_series_type(spark, model, series):
    """Series a microsecond apart, decimals, floats with NaN, nulls; orders with ties; metrics of several types."""
    ev = table(spark, SF_SMALL, "events").limit(300)
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("event_id") % 2) / F.lit(1e6))
    df = ev.select(
        "ts", "event_id", (F.col("event_id") % 4).alias("tied"), "value",
        F.when(F.col("event_id") % 5 > 0, at).alias("at"), (F.col("event_id") % 3).cast("decimal(9,2)").alias("dec"),
        F.when(F.col("event_id") % 3 > 0, F.lit(float("nan"))).otherwise(F.lit(-0.0)).cast("float").alias("f"),
        F.concat(F.lit("s"), F.col("event_id") % 2).alias("name"),
        F.when(F.col("event_id") % 4 > 0, F.col("value").cast("decimal(10,2)")).alias("m_dec"),
        F.col("event_id").cast("int").alias("m_int"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("label"))
    out = [rows_of(window_threshold(df, model, "ts", 86400, 3600, ["value", "m_dec", "m_int"], "tied", 5, series,
                                    label_col="label", method=m), 6) for m in ("expand", "blocked")]
    assert out[0] == out[1] and out[0]


def test_blocked_reads_its_input_once(spark, capsys):
    ev = table(spark, SF_SMALL, "events")
    plan = window_threshold(ev, "MA", "ts", 6000, 60, ["value"], "event_id", 20)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and "Python" not in plan and "Pandas" not in plan


def test_blocked_refuses_maps_and_auto_takes_them(spark):
    ev = table(spark, SF_SMALL, "events").withColumn("tags", F.create_map(F.lit("a"), F.col("event_id")))
    with pytest.raises(ValueError):
        window_latest_n(ev, "ts", 1200, 60, 3, "event_id", method="blocked")
    assert window_latest_n(ev, "ts", 1200, 60, 3, "event_id").count() > 0


@pytest.mark.parametrize("length_s,slide_s", [(3600, 600), (1500, 600), (7200, 7200)])
def test_sliding_moments_match_native_aggregates(spark, length_s, slide_s):
    ev = table(spark, SF_SMALL, "events").withColumn("value", F.when(F.col("event_id") % 7 > 0, F.col("value")))
    ev = ev.withColumn("grp", F.nullif(F.col("event_id") % 3, F.lit(0))).withColumn("big", F.col("value") + F.lit(1e9))
    got = sliding_summary(ev, "ts", length_s, slide_s, ["value", "big"], "grp")
    ref = native_windows(ev, length_s, slide_s).groupBy("grp", "window_start", "window_end").agg(
        *[f(m).cast("double").alias(f"{s}__{m}") for m in ("value", "big")
          for s, f in {"count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}.items()])
    want = {(r["grp"], r["window_start"], r["window_end"]): r for r in ref.collect()}
    rows = got.collect()
    assert len(rows) == 5 * len(want)
    for r in rows:
        for m in ("value", "big"):
            x, y = r[m], want[r["grp"], r["window_start"], r["window_end"]][f"{r['metric']}__{m}"]
            assert (x is None) == (y is None) and (x is None or x == pytest.approx(y, rel=1e-6, abs=1e-6))


def test_moments_are_stable_for_a_large_mean(spark):
    df = spark.range(4000).select(F.timestamp_seconds(F.col("id") * 3).alias("ts"), (F.lit(1e9) + (F.col("id") % 2) * 2 - 1).alias("v"))
    out = sliding_limits(df, "ts", 600, 60, ["v"]).where("window_start >= '1970-01-01' AND window_end <= '1970-01-01 03:00:00'")
    got = out.agg(F.min("stddev"), F.max("stddev")).first()
    assert got[0] == pytest.approx((200 / 199) ** 0.5, rel=1e-6) and got[1] == pytest.approx(got[0], rel=1e-6)
