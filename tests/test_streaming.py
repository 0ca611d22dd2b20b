"""Stream = batch, replay safety and bounded state of the streaming processors."""

import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.operators.models import moving_average
from tidemark.operators.windows import window_threshold
from tidemark.sources.kafka import kafka_options, tail_start_offset
from tidemark.sources.tables import table
from tidemark.streaming.jobs import (
    file_stream,
    start_daily_stream,
    start_dynamic_threshold_job,
    start_threshold_stream,
    start_window_count_stream,
)
from tidemark.streaming.processors import LatestNProcessor
from tidemark.streaming.sinks import read_latest
from tidemark.operators.windows import window_count


def committed(spark, path, batch_id):
    """The manifest that batch ``batch_id`` committed."""
    return json.loads(spark.read.text(f"{path}_meta/slot={batch_id % 2}", wholetext=True).first()[0])


def stored(spark, path, batch_id):
    """All state rows as of batch ``batch_id``."""
    out = None
    for bucket, batch in committed(spark, path, batch_id)["buckets"].items():
        rows = spark.read.parquet(f"{path}/batch={batch}").where(f"__bucket = {bucket}").drop("__bucket")
        out = rows if out is None else out.unionByName(rows)
    return out


def test_a_batch_rewrites_only_the_buckets_it_touches(spark, scratch):
    root = scratch("buckets")
    schema = "s int, id long, v double"
    proc = LatestNProcessor(spark.createDataFrame([], schema).schema, f"{root}/state", f"{root}/out", ["v"], "id", 3,
                            ["s"])
    proc(spark.createDataFrame([(s, i, 1.0) for s in range(60) for i in range(5)], schema), 0)
    before = committed(spark, f"{root}/state", 0)["buckets"]
    proc(spark.createDataFrame([(7, 99, 2.0)], schema), 1)
    after = committed(spark, f"{root}/state", 1)["buckets"]
    assert len(before) > 8 and set(before.values()) == {0}
    assert sorted(after.values()) == [0] * (len(before) - 1) + [1]
    rewritten = spark.read.parquet(f"{root}/state/batch=1")
    assert rewritten.select("__bucket").distinct().count() == 1
    rows = stored(spark, f"{root}/state", 1)
    assert rows.count() == 180 and rows.where("s = 7 AND id = 99").count() == 1
    for b in range(2, 5):  # folders that no bucket needs any more are deleted
        proc(spark.createDataFrame([(s, 100 + b, 1.0) for s in range(60)], schema), b)
    names = {r[0] for r in spark.read.parquet(f"{root}/state").select("batch").distinct().collect()}
    assert names == {3, 4}


def split_in_time_order(spark, path, n_files=6):
    """Events in n time-range files whose modification times follow time order."""
    ev = table(spark, SF_SMALL, "events")
    ev.repartitionByRange(n_files, "ts").write.parquet(path)
    files = sorted(glob.glob(f"{path}/part-*.parquet"))
    base = time.time() - 1000
    for i, f in enumerate(files):
        os.utime(f, (base + 10 * i, base + 10 * i))
    return ev


def rows(df, cols):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                  for r in df.select(*cols).collect())


def test_windowed_stream_equals_batch_with_watermark(spark, scratch):
    root = scratch("win")
    ev = split_in_time_order(spark, f"{root}/in")
    src = file_stream(spark, f"{root}/in", ev.schema, max_files_per_trigger=1)
    q = start_threshold_stream(src, "WMA", ["value"], "event_id", 8, f"{root}/out", f"{root}/ck",
                               ["event_type"], window=(21600, 3600), time_col="ts", delay_s=3600,
                               label_col="ts", available_now=True)
    q.awaitTermination()
    assert q.lastProgress["batchId"] >= 5          # one micro-batch per file
    got = read_latest(spark, f"{root}/out", ["event_type", "window_start", "window_end"])
    want = window_threshold(ev, "WMA", "ts", 21600, 3600, ["value"], "event_id", 8, ["event_type"],
                            label_col="ts")
    cols = ["event_type", "window_start", "window_end", "n_rows", "dt_value", "create_date"]
    assert rows(got, cols) == rows(want, cols)
    # bounded state: panes older than the watermark were evicted
    last = stored(spark, f"{root}/ck/state", q.lastProgress["batchId"])
    assert last.count() < ev.count()
    assert last.groupBy("event_type", "__pane").count().agg(F.max("count")).first()[0] <= 8


def test_latest_n_stream_equals_batch(spark, scratch):
    root = scratch("latest")
    ev = split_in_time_order(spark, f"{root}/in", 4)
    src = file_stream(spark, f"{root}/in", ev.schema, max_files_per_trigger=1)
    q = start_threshold_stream(src, "MA", ["value"], "event_id", 10, f"{root}/out", f"{root}/ck",
                               ["user_id"], label_col="ts", available_now=True)
    q.awaitTermination()
    got = read_latest(spark, f"{root}/out", ["user_id"])
    want = moving_average(ev, ["value"], "event_id", 10, "user_id", label_col="ts")
    assert rows(got, want.columns) == rows(want, want.columns)


def test_replayed_batch_is_idempotent(spark, scratch):
    root = scratch("replay")
    ev = table(spark, SF_SMALL, "events")
    halves = [ev.filter(F.col("event_id") < 500), ev.filter(F.col("event_id") >= 500)]
    proc = LatestNProcessor(ev.schema, f"{root}/state", f"{root}/out", ["value"], "event_id", 5,
                            ["event_type"], model="WMA")
    proc(halves[0], 0)
    proc(halves[1], 1)
    first = sorted(spark.read.parquet(f"{root}/out").collect())
    proc(halves[1], 1)            # replay after a failure before the commit
    assert sorted(spark.read.parquet(f"{root}/out").collect()) == first
    state = stored(spark, f"{root}/state", 1)
    assert state.count() == 25     # 5 rows x 5 event types


def test_sliding_count_stream_equals_batch(spark, scratch):
    root = scratch("count")
    ev = split_in_time_order(spark, f"{root}/in", 3)
    src = file_stream(spark, f"{root}/in", ev.schema, max_files_per_trigger=1)
    q = start_window_count_stream(src, "ts", 1200, 300, f"{root}/out", f"{root}/ck", delay_s=600,
                                  available_now=True)
    q.awaitTermination()
    got = read_latest(spark, f"{root}/out", ["window_start", "window_end"])
    want = window_count(ev, "ts", 1200, 300)
    assert rows(got, want.columns) == rows(want, want.columns)


def test_daily_stream_partitions(spark, scratch):
    root = scratch("daily")
    ev = split_in_time_order(spark, f"{root}/in", 2)
    src = file_stream(spark, f"{root}/in", ev.schema, max_files_per_trigger=1)
    q = start_daily_stream(src, f"{root}/out", f"{root}/ck", time_col="ts", available_now=True)
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    assert out.count() == ev.count()
    days = {r["index_name"] for r in out.select("index_name").distinct().collect()}
    want = {r[0] for r in ev.select(F.concat(F.lit("poc_os_metric_dt_"),
                                             F.date_format("ts", "yyyy_MM_dd"))).distinct().collect()}
    assert days == want


def test_kafka_options():
    assert tail_start_offset(100, 10) == 90
    assert tail_start_offset(5, 10) == 0
    opts = kafka_options("b:9092", "metrics", 0, 90)
    assert opts["assign"] == '{"metrics": [0]}'
    assert opts["startingOffsets"] == '{"metrics": {"0": 90}}'
    assert kafka_options("b:9092", "metrics")["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        tail_start_offset(5, -1)


def _write_records(spark, path, rows):
    df = spark.createDataFrame(rows, "key string, value string, offset long, timestamp timestamp_ntz")
    df.coalesce(1).write.parquet(path)
    return df


def test_job_decodes_only_the_newest_n(spark, scratch):
    import datetime as dt
    root = scratch("job")
    t0 = dt.datetime(2024, 1, 1, 0, 0, 30)
    rows = [("2024-01-01 00:00:30", "not-a-number", 0, t0)]           # oldest, outside the newest 4
    rows += [(f"2024-01-01 00:00:3{i}", f"{i}.0", i, t0 + dt.timedelta(seconds=i)) for i in range(1, 5)]
    recs = _write_records(spark, f"{root}/in", rows)
    src = file_stream(spark, f"{root}/in", recs.schema)
    q = start_dynamic_threshold_job(src, f"{root}/out", f"{root}/ck", model="MA", n=4, metrics=["value"],
                                    available_now=True, daily_time_col="window_end", emit="update")
    q.awaitTermination()
    out = read_latest(spark, f"{root}/out", ["window_start", "window_end"]).collect()
    assert out and all(r["dt_value"] == pytest.approx(2.5) for r in out)
    assert all(r["index_name"] == "poc_os_metric_dt_2024_01_01" for r in out)


@pytest.mark.parametrize("emit,delay_s", [("update", 3600), ("closed", 0)])
def test_job_fails_on_bad_record_inside_newest_n(spark, scratch, emit, delay_s):
    import datetime as dt
    root = scratch("jobbad")
    t0 = dt.datetime(2024, 1, 1, 0, 0, 30)
    rows = [(f"k{i}", "1.0" if i else "oops", i, t0 + dt.timedelta(seconds=i)) for i in range(3)]
    recs = _write_records(spark, f"{root}/in", rows)
    src = file_stream(spark, f"{root}/in", recs.schema)
    q = start_dynamic_threshold_job(src, f"{root}/out", f"{root}/ck", model="WMA", n=4, metrics=["value"],
                                    available_now=True, emit=emit, delay_s=delay_s)
    with pytest.raises(Exception):
        q.awaitTermination()


def test_memory_sink_prints_window_counts(spark, scratch):
    from tidemark.streaming.sinks import memory
    root = scratch("mem")
    ev = split_in_time_order(spark, f"{root}/in", 2)
    src = file_stream(spark, f"{root}/in", ev.schema)
    counts = src.select(F.col("ts").cast("timestamp").alias("t")).withWatermark("t", "1 hour") \
        .groupBy(F.window("t", "1 day")).count()
    q = memory(counts, "tidemark_daily_counts", output_mode="complete")
    q.awaitTermination()
    assert spark.sql("select sum(count) from tidemark_daily_counts").first()[0] == ev.count()


def test_ewma_stream_equals_batch(spark, scratch):
    from tidemark.operators.models import ewma_limits
    root = scratch("ewma")
    ev = split_in_time_order(spark, f"{root}/in", 3)
    src = file_stream(spark, f"{root}/in", ev.schema, max_files_per_trigger=1)
    q = start_threshold_stream(src, "EWMA", ["value"], "event_id", 30, f"{root}/out", f"{root}/ck",
                               ["event_type"], available_now=True)
    q.awaitTermination()
    got = read_latest(spark, f"{root}/out", ["event_type", "field"])
    want = ewma_limits(ev, ["value"], "event_id", 30, "event_type")
    assert rows(got, want.columns) == rows(want, want.columns)


def test_job_adds_processing_stamp(spark, scratch):
    import datetime as dt
    root = scratch("stamp")
    t0 = dt.datetime(2024, 1, 1, 0, 0, 30)
    recs = _write_records(spark, f"{root}/in", [("k", "1.0", 1, t0)])
    src = file_stream(spark, f"{root}/in", recs.schema)
    q = start_dynamic_threshold_job(src, f"{root}/out", f"{root}/ck", n=4, metrics=["value"],
                                    available_now=True, emit="update")
    q.awaitTermination()
    r = spark.read.parquet(f"{root}/out").first()
    assert r["@timestamp"] is not None and r["index_name"].startswith("poc_os_metric_dt_")


def test_files_arriving_newest_first(spark, scratch):
    """Two and more micro-batches out of time order: allowed lateness covers them."""
    root = scratch("reverse")
    ev = table(spark, SF_SMALL, "events")
    ev.repartitionByRange(4, "ts").write.parquet(f"{root}/in")
    files = sorted(glob.glob(f"{root}/in/part-*.parquet"))
    base = time.time() - 1000
    for i, f in enumerate(reversed(files)):          # newest file first
        os.utime(f, (base + 10 * i, base + 10 * i))
    src = file_stream(spark, f"{root}/in", ev.schema, max_files_per_trigger=1)
    q = start_threshold_stream(src, "MA", ["value"], "event_id", 6, f"{root}/out", f"{root}/ck",
                               ["event_type"], window=(43200, 21600), time_col="ts",
                               delay_s=40 * 86400, label_col="ts", available_now=True)
    q.awaitTermination()
    got = read_latest(spark, f"{root}/out", ["event_type", "window_start", "window_end"])
    want = window_threshold(ev, "MA", "ts", 43200, 21600, ["value"], "event_id", 6, ["event_type"],
                            label_col="ts")
    cols = ["event_type", "window_start", "window_end", "n_rows", "dt_value", "create_date"]
    assert rows(got, cols) == rows(want, cols)


def test_job_arrival_time_windows(spark, scratch):
    import datetime as dt
    root = scratch("arrival")
    t0 = dt.datetime(2024, 1, 1, 0, 0, 30)
    rows = [(f"k{i}", f"{i}.0", i, t0) for i in range(10)]
    recs = _write_records(spark, f"{root}/in", rows)
    src = file_stream(spark, f"{root}/in", recs.schema)
    q = start_dynamic_threshold_job(src, f"{root}/out", f"{root}/ck", n=4, metrics=["value"],
                                    time_col=None, available_now=True, processing_stamp=False,
                                    emit="update")
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out").collect()
    assert len(out) == 4                                  # 4-minute windows sliding by 1 minute
    assert all(r["n_rows"] == 4 and r["dt_value"] == pytest.approx(7.5) for r in out)


@pytest.mark.parametrize("model", ["MA", "WMA_FLAT"])
def test_keyed_state_stream_equals_batch(spark, scratch, model):
    from tidemark.operators.models import threshold
    from tidemark.streaming.keyed import start_keyed_latest_n_stream
    root = scratch("keyed")
    ev = split_in_time_order(spark, f"{root}/in", 4)
    src = file_stream(spark, f"{root}/in", ev.schema, max_files_per_trigger=1)
    q = start_keyed_latest_n_stream(src, model, ["value"], "event_id", 7, ["event_type"], f"{root}/out",
                                    f"{root}/ck", label_col="ts", available_now=True)
    q.awaitTermination()
    assert q.lastProgress["batchId"] >= 3
    got = read_latest(spark, f"{root}/out", ["event_type"])
    want = threshold(ev, model, ["value"], "event_id", 7, ["event_type"], label_col="ts")
    assert rows(got, want.columns) == rows(want, want.columns)


def test_closed_windows_emitted_once_and_equal_batch(spark, scratch):
    root = scratch("closed")
    ev = split_in_time_order(spark, f"{root}/in", 6)
    src = file_stream(spark, f"{root}/in", ev.schema, max_files_per_trigger=1)
    q = start_threshold_stream(src, "WMA", ["value"], "event_id", 8, f"{root}/out", f"{root}/ck",
                               ["event_type"], window=(21600, 3600), time_col="ts", delay_s=7200,
                               label_col="ts", available_now=True, emit="closed")
    q.awaitTermination()
    last = q.lastProgress["batchId"]
    emitted_to = committed(spark, f"{root}/ck/state", last)["emitted_to"]
    out = spark.read.parquet(f"{root}/out")
    keys = ["event_type", "window_start", "window_end"]
    assert out.groupBy(*keys).count().filter("count > 1").count() == 0      # each window once
    assert out.select("batch_id").distinct().count() > 1                   # spread over batches
    want = window_threshold(ev, "WMA", "ts", 21600, 3600, ["value"], "event_id", 8, ["event_type"],
                            label_col="ts").filter(F.col("window_end") <= F.lit(emitted_to).cast("timestamp_ntz"))
    cols = ["event_type", "window_start", "window_end", "n_rows", "dt_value", "create_date"]
    assert rows(out, cols) == rows(want, cols)


def test_closed_mode_replay_is_idempotent(spark, scratch):
    from tidemark.streaming.processors import WindowedLatestNProcessor
    root = scratch("closedreplay")
    ev = table(spark, SF_SMALL, "events")
    parts = [ev.filter(F.col("ts") < "2024-01-10"), ev.filter(F.col("ts") >= "2024-01-10")]
    proc = WindowedLatestNProcessor(ev.schema, f"{root}/state", f"{root}/out", "ts", 21600, 3600,
                                    ["value"], "event_id", 5, ["event_type"], "WMA", delay_s=3600,
                                    emit="closed")
    proc(parts[0], 0)
    proc(parts[1], 1)
    first = sorted(spark.read.parquet(f"{root}/out").collect())
    marker = committed(spark, f"{root}/state", 1)
    proc(parts[1], 1)                       # replay of batch 1
    assert sorted(spark.read.parquet(f"{root}/out").collect()) == first
    assert committed(spark, f"{root}/state", 1) == marker


def test_processing_time_trigger_runs_until_stopped(spark, scratch):
    root = scratch("trigger")
    ev = split_in_time_order(spark, f"{root}/in", 2)
    src = file_stream(spark, f"{root}/in", ev.schema)
    q = start_threshold_stream(src, "MA", ["value"], "event_id", 5, f"{root}/out", f"{root}/ck",
                               ["event_type"], trigger_seconds=60)
    try:
        q.processAllAvailable()          # the first trigger fires at once
        assert q.isActive                 # and the query keeps running until stopped
        assert spark.read.parquet(f"{root}/out").count() == 5
    finally:
        q.stop()
    assert not q.isActive


def test_keyed_state_with_a_hot_series(spark, scratch):
    from tidemark.operators.models import weighted_moving_average
    from tidemark.streaming.keyed import start_keyed_latest_n_stream
    root = scratch("keyedhot")
    ev = table(spark, SF_SMALL, "events").withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    ev.repartitionByRange(3, "ts").write.parquet(f"{root}/in")
    src = file_stream(spark, f"{root}/in", ev.schema, max_files_per_trigger=1)
    q = start_keyed_latest_n_stream(src, "WMA", ["value"], "event_id", 12, ["user_id"], f"{root}/out",
                                    f"{root}/ck", available_now=True)
    q.awaitTermination()
    got = read_latest(spark, f"{root}/out", ["user_id"])
    want = weighted_moving_average(ev, ["value"], "event_id", 12, "user_id")
    assert rows(got, want.columns) == rows(want, want.columns)



def test_sliding_count_stream_in_a_half_hour_zone(spark, scratch):
    root = scratch("zone")
    ev = split_in_time_order(spark, f"{root}/in", 3)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        src = file_stream(spark, f"{root}/in", ev.schema, max_files_per_trigger=1)
        q = start_window_count_stream(src, "ts", 21600, 3600, f"{root}/out", f"{root}/ck",
                                      delay_s=40 * 86400, available_now=True)
        q.awaitTermination()
        got = read_latest(spark, f"{root}/out", ["window_start", "window_end"])
        want = window_count(ev, "ts", 21600, 3600)
        assert rows(got, want.columns) == rows(want, want.columns)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")



def test_job_with_a_series_column(spark, scratch):
    import datetime as dt
    root = scratch("jobseries")
    t0 = dt.datetime(2024, 1, 1, 0, 0, 30)
    rows = [(h, f"k{i}", f"{i}.0", i, t0 + dt.timedelta(seconds=i)) for i in range(8) for h in ("h1", "h2")]
    rows = [(h, k, v if h == "h1" else str(2 * float(v)), o, t) for h, k, v, o, t in rows]
    df = spark.createDataFrame(rows, "host string, key string, value string, offset long, timestamp timestamp_ntz")
    df.coalesce(1).write.parquet(f"{root}/in")
    src = file_stream(spark, f"{root}/in", df.schema)
    q = start_dynamic_threshold_job(src, f"{root}/out", f"{root}/ck", model="MA", n=4, metrics=["value"],
                                    available_now=True, emit="update", processing_stamp=False,
                                    series_cols=["host"])
    q.awaitTermination()
    out = {(r["host"], r["window_start"]): r["dt_value"]
           for r in read_latest(spark, f"{root}/out", ["host", "window_start", "window_end"]).collect()}
    assert {h for h, _ in out} == {"h1", "h2"}
    for (h, ws), v in out.items():
        assert v == pytest.approx((5.5 if h == "h1" else 11.0))   # newest 4 of 0..7 (x2 for h2)
