import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators.models import describe_summary
from tidemark.operators.recent import latest_n
from tidemark.operators.reshape import (
    business_day_index,
    chunk_blocks,
    mean_stddev_rows,
    row_positions,
    summary_to_long,
    transpose,
)
from tidemark.sources.tables import table


def test_business_day_index_two_day_step(spark):
    starts = spark.createDataFrame([(dt.datetime(1990, 4, 10),)], "start timestamp_ntz")
    days = [r["day"] for r in business_day_index(starts, "start", 5, 2).orderBy("period").collect()]
    assert days == [dt.date(1990, 4, d) for d in (10, 12, 16, 18, 20)]


def test_business_day_index_weekend_start(spark):
    starts = spark.createDataFrame([(dt.datetime(2024, 1, 6),)], "start timestamp_ntz")  # Saturday
    days = [r["day"] for r in business_day_index(starts, "start", 3, 1).orderBy("period").collect()]
    assert days == [dt.date(2024, 1, 8), dt.date(2024, 1, 9), dt.date(2024, 1, 10)]


def test_row_positions_match_row_number(spark):
    ev = table(spark, SF_SMALL, "events").select("user_id", "event_id").repartition(7)
    ours = row_positions(ev, "event_id", "user_id", "pos")
    w = Window.partitionBy("user_id").orderBy("event_id")
    ref = ev.withColumn("pos", (F.row_number().over(w) - 1).cast("long"))
    assert sorted(ours.collect()) == sorted(ref.select("user_id", "event_id", "pos").collect())


def test_chunk_blocks_sizes(spark):
    rows = [(i, float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "pos long, x double")
    out = {r["block"]: (r["n_rows"], r["x"]) for r in chunk_blocks(df, ["x"], "pos", 4).collect()}
    assert out == {0: (4, [0.0, 1.0, 2.0, 3.0]), 1: (4, [4.0, 5.0, 6.0, 7.0]), 2: (2, [8.0, 9.0])}


def test_transpose(spark):
    ev = table(spark, SF_SMALL, "events")
    top = latest_n(ev.select("event_type", "event_id", "value"), 3, "event_id", "event_type")
    t = transpose(top, ["value"], "rank", 3, "event_type")
    got = {r["event_type"]: [r["p0"], r["p1"], r["p2"]] for r in t.collect()}
    for r in top.collect():
        assert got[r["event_type"]][r["rank"]] == r["value"]


def test_summary_long_and_filter(spark):
    ev = table(spark, SF_SMALL, "events")
    long = summary_to_long(describe_summary(ev, ["value", "user_id"]), ["value", "user_id"])
    assert long.count() == 10
    ms = mean_stddev_rows(long)
    assert sorted({r["metric"] for r in ms.collect()}) == ["mean", "stddev"]
    assert ms.count() == 4


def test_row_positions_with_a_hot_series(spark):
    # a third of all rows in one series: it must spread over several range tasks
    ev = table(spark, SF_SMALL, "events").select(
        F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")).alias("user_id"),
        "event_id")
    ours = row_positions(ev, "event_id", "user_id", "pos")
    w = Window.partitionBy("user_id").orderBy("event_id")
    ref = ev.withColumn("pos", (F.row_number().over(w) - 1).cast("long"))
    assert sorted(ours.collect()) == sorted(ref.select("user_id", "event_id", "pos").collect())
