import pytest

from tidemark.sources.records import decode_records, decode_vector, encode_records, project_record


def recs(spark, rows):
    return spark.createDataFrame(rows, "key string, value string, offset long")


def test_padded_numbers(spark):
    df = decode_records(recs(spark, [("k", " 1.5,\t2 , 3,4,5,6,\t7 ", 0)]))
    r = df.first()
    assert [r[c] for c in df.columns[1:8]] == [1.5, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0]
    assert r["create_date"] == "k" and r["offset"] == 0


def test_malformed_number_fails_by_default(spark):
    with pytest.raises(Exception):
        decode_records(recs(spark, [("k", "1,2,x,4,5,6,7", 0)])).collect()


def test_malformed_number_null_mode(spark):
    r = decode_records(recs(spark, [("k", "1,2,x,4,5,6,7", 0)]), on_error="null").first()
    assert r["memory_actual_used_pct"] is None and r["cpu_total_pct"] == 1.0


@pytest.mark.parametrize("value", ["1,2,3,4,5,6", "1,2,3,4,5,6,7,8"])
def test_wrong_arity_fails(spark, value):
    with pytest.raises(Exception, match="fields"):
        decode_records(recs(spark, [("k", value, 0)])).collect()


def test_null_key_fails(spark):
    with pytest.raises(Exception, match="null key"):
        decode_records(recs(spark, [(None, "1,2,3,4,5,6,7", 0)])).collect()


def test_round_trip(spark):
    df = spark.createDataFrame([(1, 0.1, 123456.78, 1e-7)], "o long, a double, b double, c double")
    enc = encode_records(df, ["a", "b", "c"], "o", "o", sep=",\t ")
    dec = decode_records(enc, ["a", "b", "c"])
    r = dec.first()
    assert (r["a"], r["b"], r["c"]) == (0.1, 123456.78, 1e-7)


def test_project_record_casts_binary(spark):
    df = spark.createDataFrame([(bytearray(b"k"), bytearray(b"1,2"), 5)], "key binary, value binary, offset int")
    r = project_record(df).first()
    assert (r["key"], r["value"], r["offset"]) == ("k", "1,2", 5)


def test_decode_vector_is_jvm_side(spark):
    df = recs(spark, [("k", "1,2", 0)]).select(decode_vector("value").alias("v"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_malformed_number_fails_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not a number"):
            decode_records(recs(spark, [("k", "1,2,x,4,5,6,7", 0)])).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_null_value_fails(spark):
    with pytest.raises(Exception, match="null value"):
        decode_records(recs(spark, [("k", None, 0)])).collect()


def test_decode_after_latest_n_only_sees_kept_rows(spark):
    from tidemark.operators.recent import latest_n
    rows = [("k0", "oops", 0)] + [(f"k{i}", ",".join([str(float(i))] * 7), i) for i in range(1, 6)]
    top = latest_n(recs(spark, rows), 3, "offset", rank_col=None)
    dec = decode_records(top)
    assert sorted(r["offset"] for r in dec.collect()) == [3, 4, 5]
    plan = dec._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
