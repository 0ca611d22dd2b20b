"""Property tests: Spark models vs a pure-Python brute force on random series."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.functions.weights import band_weight_of, denominator
from tidemark.operators.models import moving_average, weighted_moving_average
from tidemark.operators.recent import latest_n
from tidemark.sources.tables import table

series_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(-1000, 1000)),
    min_size=0, max_size=40)


def brute(rows, n):
    """rows: list of (key, cents) in offset order -> {key: (ma, wma)}."""
    out = {}
    for key in {k for k, _ in rows}:
        vals = [v / 100 for k, v in rows if k == key][::-1][:n]   # newest first
        ma = sum(vals) / len(vals)
        d = denominator(n)
        wma = None if d == 0 else sum(band_weight_of(r, n) * x for r, x in enumerate(vals)) / d
        out[key] = (ma, wma)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=series_strategy, n=st.integers(1, 13))
def test_models_match_brute_force(spark, rows, n):
    df = spark.createDataFrame([(k, i, v / 100) for i, (k, v) in enumerate(rows)],
                               "k string, o long, x double")
    want = brute(rows, n)
    ma = {r["k"]: r["dt_x"] for r in moving_average(df, ["x"], "o", n, "k").collect()}
    wma = {r["k"]: r["dt_x"] for r in weighted_moving_average(df, ["x"], "o", n, "k").collect()}
    assert ma.keys() == wma.keys() == want.keys()
    for key, (m, w) in want.items():
        assert ma[key] == pytest.approx(m, abs=1e-9)
        assert (wma[key] is None) if w is None else wma[key] == pytest.approx(w, abs=1e-9)


@pytest.mark.parametrize("salt", [0, 8])
def test_hot_series_latest_n(spark, salt):
    # one user holds a third of all rows
    ev = table(spark, SF_SMALL, "events").select(
        F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")).alias("user_id"),
        "event_id", "value").repartition(6)
    got = latest_n(ev, 15, "event_id", "user_id", salt_buckets=salt)
    w = Window.partitionBy("user_id").orderBy(F.desc("event_id"))
    want = ev.withColumn("rank", (F.row_number().over(w) - 1).cast("long")).filter("rank < 15")
    assert sorted(got.collect()) == sorted(want.collect())


def test_large_n_switches_to_salted_plan(spark):
    ev = table(spark, SF_SMALL, "events").select(
        F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")).alias("user_id"),
        "event_id")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5")
    try:
        got = latest_n(ev, 10, "event_id", "user_id")
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "__salt" in plan
        w = Window.partitionBy("user_id").orderBy(F.desc("event_id"))
        want = ev.withColumn("rank", (F.row_number().over(w) - 1).cast("long")).filter("rank < 10")
        assert sorted(got.collect()) == sorted(want.collect())
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 5000)), min_size=1, max_size=60),
       slide=st.sampled_from([60, 120, 300]), k=st.integers(1, 30), n=st.integers(1, 5))
def test_blocked_and_expanded_window_latest_n_agree(spark, rows, slide, k, n):
    import datetime as dt
    from tidemark.operators.windows import window_latest_n
    t0 = dt.datetime(2024, 1, 1)
    data = [(key, i, t0 + dt.timedelta(seconds=sec)) for i, (key, sec) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, o long, ts timestamp_ntz")
    cols = ["k", "window_start", "window_end", "o", "rank"]
    a = window_latest_n(df, "ts", slide * k, slide, n, "o", ["k"], method="blocked").select(*cols)
    b = window_latest_n(df, "ts", slide * k, slide, n, "o", ["k"], method="expand").select(*cols)
    assert sorted(a.collect()) == sorted(b.collect())


def test_newest_keys_strings_and_nulls(spark):
    from tidemark.operators.recent import newest_keys, restrict_to_newest_keys
    rows = [("b", 1), ("a", 2), (None, 3), ("c", 4), ("c", 5), ("a", 6)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(3)
    assert [r[0] for r in newest_keys(df, 2, "k").collect()] == ["c", "b"]
    # fewer than n non-null keys: the null group sorts last and is kept
    assert [r[0] for r in newest_keys(df, 5, "k").collect()] == ["c", "b", "a", None]
    kept = sorted(r["v"] for r in restrict_to_newest_keys(df, 5, "k").collect())
    assert kept == [1, 2, 3, 4, 5, 6]
    assert sorted(r["v"] for r in restrict_to_newest_keys(df, 1, "k").collect()) == [4, 5]
