"""Costs that must not follow the number of series or the rows of a task."""

from pyspark.sql import DataFrameWriter

from tidemark.operators.models import weighted_moving_average
from tidemark.sources.records import classify_records
from tidemark.streaming.jobs import file_stream
from tidemark.streaming.keyed import start_keyed_latest_n_stream
from tidemark.streaming.quarantine import read_decoded, read_quarantine, write_split
from tidemark.streaming.sinks import OPEN_FILES, read_latest


def test_keyed_state_holds_many_series_in_a_bucket(spark, scratch):
    root, big = scratch("keyed-buckets"), 2**60
    rows = [(None if i % 100 == 0 else big + i % 100, None if i < 100 else big + i, None if i % 7 == 0 else float(i))
            for i in range(1200)]
    for k in range(2):
        spark.createDataFrame(rows[k::2], "s long, id long, v double").coalesce(1).write.mode("append").parquet(f"{root}/in")
    src = file_stream(spark, f"{root}/in", "s long, id long, v double", max_files_per_trigger=1)
    q = start_keyed_latest_n_stream(src, "WMA", ["v"], "id", 5, ["s"], f"{root}/out", f"{root}/ck",
                                    label_col="id", available_now=True, state_buckets=3)
    q.awaitTermination()
    assert all(p["stateOperators"][0]["numRowsTotal"] <= 3 for p in q.recentProgress if p["stateOperators"])
    got = read_latest(spark, f"{root}/out", ["s"])
    want = weighted_moving_average(spark.createDataFrame(rows, "s long, id long, v double"), ["v"], "id", 5, "s",
                                   label_col="id")
    plain = lambda df: sorted(((r["s"] or 0, r["create_date"], round(r["dt_v"], 9)) for r in df.collect()))
    assert plain(got) == plain(want) and got.count() == 100


def test_split_is_written_without_a_sort(spark, scratch, monkeypatch):
    path, held, write = scratch("split"), [], DataFrameWriter.parquet

    def parquet(self, *args, **kwargs):
        held.append(self._spark.conf.get(OPEN_FILES, None))
        return write(self, *args, **kwargs)

    rows = [("k", "1,2", i) if i % 2 else (None, "1,2", i) for i in range(100)]
    messages = spark.createDataFrame(rows, "key string, value string, offset long").coalesce(1)
    before = spark.conf.get(OPEN_FILES, None)
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    counts = write_split(classify_records(messages, ["a", "b"]), path, 0)
    assert held == ["2"] and spark.conf.get(OPEN_FILES, None) == before
    assert counts["decoded"] == counts["null key"] == 50
    assert {r["offset"] for r in read_decoded(spark, path).collect()} == set(range(1, 100, 2))
    assert {r["offset"] for r in read_quarantine(spark, path, ["a", "b"]).collect()} == set(range(0, 100, 2))
