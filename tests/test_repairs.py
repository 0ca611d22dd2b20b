"""Inputs that the driver tables lack: null series, late rows, null and NaN metrics, odd order columns, zones."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions.schema import label_to_utc
from tidemark.operators.models import threshold, weighted_moving_average
from tidemark.operators.recent import restrict_to_newest_keys
from tidemark.operators.reshape import chunk_blocks, row_positions, transpose
from tidemark.operators.windows import window_latest_n
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.kafka import kafka_options
from tidemark.streaming.jobs import file_stream, start_dynamic_threshold_job, start_threshold_stream
from tidemark.streaming.keyed import start_keyed_latest_n_stream
from tidemark.streaming.processors import WindowedLatestNProcessor
from tidemark.streaming.sinks import console, read_latest, write_batch

T0 = dt.datetime(2024, 1, 1)
MINUTE = dt.timedelta(minutes=1)


def window_rows(spark):
    rows = []
    for i in range(240):
        at = T0 + i * 0.7 * MINUTE
        rows.append((i % 3 if i % 7 else None, at, i, f"k{(i * 37) % 240:03d}", decimal.Decimal(i % 50) / 10,
                     None if i % 11 == 0 else float("nan") if i % 13 == 0 else i / 7, None if i % 5 else 2**60 + i))
    return spark.createDataFrame(rows, "grp int, ts timestamp_ntz, id long, name string, dec decimal(10,2), "
                                       "value double, big long")


@pytest.mark.parametrize("order", [["ts"], ["name"], ["dec", "id"], ["value", "id"], ["big", "id"]])
@pytest.mark.parametrize("series", [[], ["grp"]])
def test_both_window_methods_agree(spark, order, series):
    df = window_rows(spark)
    rows = {}
    for method in ("expand", "blocked"):
        out = window_latest_n(df, "ts", 1200, 60, 5, order, series, method=method)
        rows[method] = sorted(map(repr, out.select(*sorted(out.columns)).collect()))
    assert rows["expand"] == rows["blocked"] and rows["expand"]


def test_positions_and_blocks_keep_a_null_series(spark):
    df = spark.createDataFrame([(None if i % 2 else 1, i) for i in range(10)], "s int, v long")
    pos = row_positions(df, "v", "s")
    assert pos.count() == 10
    got = {r["s"]: r["v"] for r in chunk_blocks(pos, ["v"], "pos", 8, "s").collect()}
    assert got == {None: [1, 3, 5, 7, 9], 1: [0, 2, 4, 6, 8]}


def test_transpose_refuses_positions_it_has_no_column_for(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 3.0)], "pos int, v double")
    assert transpose(df, ["v"], "pos", 3).first()["p2"] == 3.0
    with pytest.raises(Exception, match="got position 2"):
        transpose(df, ["v"], "pos", 2).collect()


def test_newest_keys_with_nulls(spark):
    df = spark.createDataFrame([(k,) for k in [5, 5, 3, None, 1, None]], "k int")
    assert sorted(r["k"] for r in restrict_to_newest_keys(df, 2, "k").collect()) == [3, 5, 5]
    assert restrict_to_newest_keys(df, 4, "k").count() == 6
    assert restrict_to_newest_keys(df, 3, "k").where("k is null").count() == 0


def feed(spark, path, batches, schema):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return file_stream(spark, path, spark.createDataFrame([], schema).schema, max_files_per_trigger=1)


EVENTS = "s int, ts timestamp_ntz, id long, v double"


def processor(spark, scratch, **kw):
    root = scratch("late")
    schema = spark.createDataFrame([], EVENTS).schema
    proc = WindowedLatestNProcessor(schema, f"{root}/state", f"{root}/out", "ts", 600, 300, ["v"], "id", 50, **kw)
    return proc, f"{root}/out"


@pytest.mark.parametrize("series", [(), ("s",)])
def test_a_late_row_never_changes_a_closed_window(spark, scratch, series):
    proc, out = processor(spark, scratch, series_cols=series, delay_s=300, emit="update")
    keys = [*series, "window_start", "window_end"]
    frame = lambda rows: spark.createDataFrame(rows, EVENTS)
    proc(frame([(None, T0 + i * MINUTE, i, float(i)) for i in range(10)]), 0)
    proc(frame([(None, T0 + 14 * MINUTE, 20, 20.0)]), 1)
    before = {tuple(r[k] for k in keys): r for r in read_latest(spark, out, keys).collect()}
    # the pane of minutes 5 to 9 still belongs to the open window 5-15, but 0-10 has closed
    proc(frame([(None, T0 + 9 * MINUTE, 21, 1000.0)]), 2)
    after = {tuple(r[k] for k in keys): r for r in read_latest(spark, out, keys).collect()}
    closed = [k for k in before if k[-1] <= T0 + 10 * MINUTE]
    assert closed and all(after[k] == before[k] for k in closed)
    assert any(after[k]["n_rows"] > before[k]["n_rows"] for k in before if k not in closed)


def test_null_series_stay_in_streams(spark, scratch):
    root = scratch("null-series")
    src = feed(spark, f"{root}/in", [[(None, T0, i, 2.0), (1, T0, i + 50, 4.0)] for i in range(3)], EVENTS)
    start_threshold_stream(src, "MA", ["v"], "id", 2, f"{root}/out", f"{root}/ckpt", ["s"],
                           available_now=True).awaitTermination()
    assert {r["s"]: r["dt_v"] for r in read_latest(spark, f"{root}/out", ["s"]).collect()} == {None: 2.0, 1: 4.0}


@pytest.mark.parametrize("window", [None, (600, 60)])
def test_no_cached_batch_stays_behind(spark, scratch, window):
    root = scratch("cache")
    kept = lambda: len(spark.sparkContext._jsc.getPersistentRDDs())
    before = kept()
    src = feed(spark, f"{root}/in", [[(1, T0 + i * MINUTE, i, 1.0)] for i in range(8)], EVENTS)
    start_threshold_stream(src, "MA", ["v"], "id", 2, f"{root}/out", f"{root}/ckpt", ["s"], window=window,
                           time_col="ts", delay_s=0, available_now=True).awaitTermination()
    assert kept() == before


def test_keyed_models_of_only_nulls_are_null(spark, scratch):
    root = scratch("keyed-nulls")
    src = feed(spark, f"{root}/in", [[(1, T0, 1, None), (2, T0, 2, 3.0), (2, T0, 3, None)]], EVENTS)
    for model in ("MA", "WMA"):
        start_keyed_latest_n_stream(src, model, ["v"], "id", 4, ["s"], f"{root}/{model}", f"{root}/ckpt-{model}",
                                    available_now=True).awaitTermination()
        got = {r["s"]: r["dt_v"] for r in read_latest(spark, f"{root}/{model}", ["s"]).collect()}
        assert got[1] is None and got[2] is not None


def test_zone_suffixes_are_honoured(spark):
    labels = ["2024-01-01T00:00:00+09:00", "2024-01-01T00:00:00Z", "2024-01-01 00:00:00", "2024-01-01", "x",
              "2024-01-01 00:00:00 Europe/Paris", "2024-01-01T00:00:00-0130", "2024-01-01 00:00:00 UTC"]
    want = [T0 - 9 * 60 * MINUTE, T0, T0, T0, None, T0 - 60 * MINUTE, T0 + 90 * MINUTE, T0]
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame(list(enumerate(labels)), "i int, label string")
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            got = {r["i"]: r["t"] for r in df.select("i", label_to_utc("label").alias("t")).collect()}
            assert [got[i] for i in range(len(labels))][:6] == want[:6] and got[7] == want[7]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    mixed = spark.createDataFrame([("2024-01-01T05:00:00+09:00", 1, 1.0), ("2024-01-01T00:00:00Z", 2, 1.0)],
                                  "label string, id int, v double")
    got = weighted_moving_average(mixed, ["v"], "id", 4, label_col="label").first()
    assert got["create_date"] == T0


def test_a_replay_on_another_day_replaces_the_first_attempt(spark, scratch):
    root = scratch("replay")
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for day in ("d1", "d2"):
            write_batch(spark.createDataFrame([(1, day)], "v int, index_name string"), root, 0, ["index_name"])
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    assert [r["index_name"] for r in spark.read.parquet(root).collect()] == ["d2"]


def test_kafka_options_for_several_partitions():
    one = kafka_options("b:1", "t", 2, 7)
    assert one["assign"] == '{"t": [2]}' and one["startingOffsets"] == '{"t": {"2": 7}}'
    assert "failOnDataLoss" not in one
    two = kafka_options("b:1", "t", [0, 1], {0: 5})
    assert two["assign"] == '{"t": [0, 1]}' and two["startingOffsets"] == '{"t": {"0": 5, "1": -1}}'
    every = kafka_options("b:1", "t", None)
    assert every["subscribe"] == "t" and "assign" not in every and every["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        kafka_options("b:1", "t", [0, 1], 5)


def test_ewma_refuses_options_it_does_not_take(spark):
    df = spark.createDataFrame([(1, 1.0)], "id int, v double")
    with pytest.raises(ValueError):
        threshold(df, "EWMA", ["v"], "id", 4, rename={"v": "x"})


def test_arrival_time_has_no_lateness(spark, scratch, monkeypatch):
    seen = {}
    import tidemark.streaming.jobs as jobs
    monkeypatch.setattr(jobs, "_start", lambda df, proc, *a: seen.update(delay=proc.delay_s))
    recs = spark.createDataFrame([], "key string, value string, offset long, timestamp timestamp_ntz")
    start_dynamic_threshold_job(recs, "o", scratch("c"), time_col=None)
    assert seen["delay"] == 0
    start_dynamic_threshold_job(recs, "o", scratch("c"))
    assert seen["delay"] == 3600


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, *a):
            return None

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(Conf)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Cluster())


def test_console_prints_a_batch(spark, scratch):
    root = scratch("console")
    src = feed(spark, f"{root}/in", [[(1, T0, 1, 1.0)]], EVENTS).groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    q = console(src, trigger_seconds=1)
    try:
        q.processAllAvailable()
        assert q.lastProgress["numInputRows"] >= 0 and q.exception() is None
    finally:
        q.stop()


def test_a_typo_is_refused_when_strict(spark):
    from tidemark.operators.models import aggregate_ranked
    df = spark.createDataFrame([(0, 1.0)], "__rank long, v double")
    with pytest.raises(ValueError):
        aggregate_ranked(df, "WAM", ["v"], 4, [], strict=True)
    assert aggregate_ranked(df, "WAM", ["v"], 4, []).first()["dt_v"] == 1.0


def test_several_partitions_are_ordered_by_time(spark, scratch):
    from tidemark.sources.kafka import MESSAGE_ORDER
    from tidemark.sources.records import project_record
    root = scratch("partitions")
    schema = "key string, value string, offset long, timestamp timestamp_ntz, partition int"
    # partition 1 has the larger offsets, partition 0 the newer messages
    rows = [(str(T0), str(i), 100 + i, T0 + i * MINUTE / 60, 1) for i in range(5)]
    rows += [(str(T0), str(50 + i), i, T0 + (10 + i) * MINUTE / 60, 0) for i in range(5)]
    rows += [(str(T0), "0", 999, T0 + 10 * MINUTE, 1)]  # moves the watermark
    src = project_record(feed(spark, f"{root}/in", [rows], schema), extra=("timestamp", "partition"))
    start_dynamic_threshold_job(src, f"{root}/out", f"{root}/ckpt", n=4, metrics=["v"], delay_s=0, available_now=True,
                                processing_stamp=False, order_by=MESSAGE_ORDER).awaitTermination()
    first = spark.read.parquet(f"{root}/out").where(F.col("window_end") == T0 + MINUTE).first()
    assert (first["n_rows"], first["dt_v"]) == (4, 52.5)
