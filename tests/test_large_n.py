"""Distributed selection, models at every record, and messages set aside."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.weights import band_weight_of, denominator
from tidemark.operators.recent import latest_n
from tidemark.operators.rolling import rolling_threshold
from tidemark.operators.selection import newest_rows, nth_largest
from tidemark.sources.records import BAD_REASONS, classify_records
from tidemark.streaming.jobs import file_stream
from tidemark.streaming.quarantine import read_decoded, read_quarantine, start_record_split_stream, write_split

T0 = dt.datetime(2024, 1, 1)
DRAW = random.Random(3)
KEYS = {
    "long": [DRAW.choice([None, -(2**62), 2**62, DRAW.randrange(40), DRAW.randrange(10**12)]) for _ in range(700)],
    "double": [DRAW.choice([None, math.nan, math.inf, -math.inf, 0.5, DRAW.random()]) for _ in range(700)],
    "timestamp_ntz": [None if DRAW.random() < 0.1 else T0 + dt.timedelta(microseconds=DRAW.randrange(400)) for _ in range(700)],
    "date": [(T0 + dt.timedelta(days=DRAW.randrange(5))).date() for _ in range(700)],
}


@pytest.mark.parametrize("kind", KEYS)
def test_newest_rows_equal_latest_n(spark, kind):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(KEYS[kind])], f"k {kind}, id long").repartition(5)
    for n in (0, 1, 37, 350, 690, 700, 900):
        got = newest_rows(df, n, ["k", "id"], finish_rows=10)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, latest_n(df, n, ["k", "id"]).collect())), n


def test_newest_rows_settles_ties_and_equal_rows(spark):
    df = spark.createDataFrame([(1, "a")] * 50 + [(1, "b")] * 50 + [(2, "c")], "k long, v string").repartition(4)
    for n in (1, 30, 60, 101):
        runs = [sorted((r.k, r.v) for r in newest_rows(df, n, "k", None, finish_rows=5).collect()) for _ in range(2)]
        assert runs[0] == runs[1] and len(runs[0]) == n and (2, "c") in runs[0]
    ranks = [r["rank"] for r in newest_rows(df, 60, "k", finish_rows=5).collect()]
    assert sorted(ranks) == list(range(60))
    assert newest_rows(df.where("k > 9"), 5, "k").count() == 0
    with pytest.raises(TypeError):
        newest_rows(df, 5, "v")


def test_newest_rows_are_never_in_one_task(spark):
    df = spark.range(400_000).repartition(8)
    _, above, equal = nth_largest(df, F.col("id"), 40_000, finish_rows=100)
    assert (above, equal) == (39_999, 1)
    kept = newest_rows(df, 40_000, "id", None)
    sizes = [r["count"] for r in kept.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    assert "Limit" not in kept._jdf.queryExecution().executedPlan().toString()


def brute(values, n, model, upto):
    newest = [values[i] for i in range(upto, max(-1, upto - n), -1)]
    known = [(r, x) for r, x in enumerate(newest) if x is not None]
    if not known:
        return None
    if model == "MA":
        return sum(x for _, x in known) / len(known)
    d = denominator(n)
    weigh = (lambda r: 0.1) if model == "WMA_FLAT" else (lambda r: band_weight_of(r, n))
    return sum(x * weigh(r) for r, x in known) / d if d else None


@pytest.mark.parametrize("model", ["MA", "WMA", "WMA_FLAT"])
@pytest.mark.parametrize("n", [1, 3, 4, 7, 20, 50])
def test_rolling_models_equal_brute_force(spark, model, n):
    series = {None: 40, 1: 260, 2: 3}
    data = {s: [None if DRAW.random() < 0.15 else DRAW.random() * 100 for _ in range(k)] for s, k in series.items()}
    df = spark.createDataFrame([(s, i, v) for s, vs in data.items() for i, v in enumerate(vs)], "s int, id long, v double")
    got = {(r.s, r.id): r.dt_v for r in rolling_threshold(df.repartition(6), model, ["v"], "id", n, "s", block_rows=16).collect()}
    assert len(got) == sum(series.values())
    for (s, i), x in got.items():
        want = brute(data[s], n, model, i)
        assert (x is None and want is None) or x == pytest.approx(want, rel=1e-12, abs=1e-12), (s, i)


def test_a_huge_or_infinite_value_stays_in_its_windows(spark):
    values = [0.1] * 100
    values[30], values[60] = 1e300, math.inf
    df = spark.createDataFrame(list(enumerate(values)), "id long, v double")
    got = {r.id: r.dt_v for r in rolling_threshold(df, "MA", ["v"], "id", 8, block_rows=16).collect()}
    for i, x in got.items():
        if 30 <= i < 38:
            assert x > 1e298
        elif 60 <= i < 68:
            assert x == math.inf
        else:
            assert x == pytest.approx(0.1, rel=1e-12)


def test_a_hot_series_is_cut_into_blocks(spark):
    df = spark.range(200_000).select(F.col("id"), F.lit(1.0).alias("v"))
    out = rolling_threshold(df, "WMA", ["v"], "id", 20)
    assert out.count() == 200_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = out.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 4 and max(sizes) < 100_000
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("hashpartitioning(__block") == 1
    for bad in ({"model": "EWMA"}, {"n": 0}):
        with pytest.raises(ValueError):
            rolling_threshold(df, **({"model": "MA", "metrics": ["v"], "order_by": "id", "n": 2} | bad))


MESSAGES = [("k", "1, 2", 1), (None, "1,2", 2), ("k", None, 3), ("k", "1", 4), ("k", "1,x", 5), ("k", "", 6), ("k", "3,\t4", 7),
            (None, None, 8), ("k", "1,2,3", 9), ("k", "1,", 10)]
MESSAGE = "key string, value string, offset long"


def test_bad_records_are_told_apart(spark, scratch):
    df = spark.createDataFrame(MESSAGES, MESSAGE)
    rows = {r.offset: r for r in classify_records(df, ["a", "b"], "label").collect()}
    null_key, null_value, arity, number = BAD_REASONS
    assert {i: r.reason for i, r in rows.items()} == {
        1: None, 2: null_key, 3: null_value, 4: arity, 5: number, 6: arity, 7: None, 8: null_key, 9: arity, 10: number}
    assert (rows[7].a, rows[7].b, rows[7].value) == (3.0, 4.0, None) and (rows[5].a, rows[5].value) == (None, "1,x")
    path = scratch("split")
    for _ in range(2):  # a replay replaces the batch
        assert write_split(classify_records(df, ["a", "b"], "label"), path, 0) == {
            "decoded": 2, null_key: 2, null_value: 1, arity: 3, number: 2}
    assert read_decoded(spark, path).count() == 2 and read_quarantine(spark, path, ["a", "b"]).count() == 8
    empty = classify_records(spark.createDataFrame([], MESSAGE), ["a", "b"], "label")
    assert set(write_split(empty, scratch("none"), 0).values()) == {0}


def test_a_stream_is_split_once_per_batch(spark, scratch):
    root, counts = scratch("split-stream"), {}
    for i in range(3):
        spark.createDataFrame(MESSAGES[i * 3 : i * 3 + 4], MESSAGE).coalesce(1).write.mode("append").parquet(f"{root}/in")
    src = file_stream(spark, f"{root}/in", spark.createDataFrame([], MESSAGE).schema, max_files_per_trigger=1)
    start_record_split_stream(src, f"{root}/out", f"{root}/ckpt", ["a", "b"], "label", available_now=True,
                              on_counts=counts.__setitem__).awaitTermination()
    assert len(counts) == 3 and sum(sum(c.values()) for c in counts.values()) == 12
    assert read_decoded(spark, f"{root}/out").count() == sum(c["decoded"] for c in counts.values())
    assert read_quarantine(spark, f"{root}/out", ["a", "b"]).count() == 12 - read_decoded(spark, f"{root}/out").count()
