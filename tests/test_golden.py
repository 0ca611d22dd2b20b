"""Golden values for the three sample inputs (FIXTURES.md section 2)."""

import re

import pytest

from tests.samples import TEST2_LINES, TEST3_LINES, TEST_LINES
from tidemark.functions.schema import METRIC_COLS, OUTPUT_NAMES
from tidemark.operators.models import ewma_limits, moving_average, weighted_moving_average
from tidemark.sources.records import decode_records

LABEL = "2018-08-29T05:40:20.927Z"


def records(spark, lines, key=LABEL):
    rows = [(key, line, i) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "key string, value string, offset long")


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def close(a, b):
    if b is None:
        return a is None
    return a == pytest.approx(b, rel=1e-9, abs=1e-9)


TEST2 = {  # n -> (MA, WMA, WMA flat, mean, stddev, UCL, LCL)
    20: (50.465, 50.186, 20.186, 50.465, 1.969043316, 52.946490926, 47.983509074),
    10: (50.81, 70.315, 25.405, 50.81, 2.033852393, 53.373166699, 48.246833301),
    8: (51.3625, 50.875, 20.545, 51.3625, 1.813392637, 53.647831835, 49.077168165),
    3: (52.7, None, None, 52.7, 0.793725393, 53.700294074, 51.699705926),
}


@pytest.mark.parametrize("n", sorted(TEST2))
def test_test2_every_column(spark, n):
    df = decode_records(records(spark, TEST2_LINES))
    ma, wma, flat, mean, sd, ucl, lcl = TEST2[n]
    r_ma = one(moving_average(df, METRIC_COLS, "offset", n, label_col="create_date"))
    r_wma = one(weighted_moving_average(df, METRIC_COLS, "offset", n, label_col="create_date"))
    r_flat = one(weighted_moving_average(df, METRIC_COLS, "offset", n, weighting="flat"))
    limits = {r["field"]: r for r in ewma_limits(df, METRIC_COLS, "offset", n).collect()}
    for m in METRIC_COLS:
        out = OUTPUT_NAMES[m]
        assert close(r_ma[out], ma)
        assert close(r_wma[out], wma)
        assert close(r_flat[out], flat)
        lim = limits[m]
        assert close(lim["mean"], mean)
        assert lim["stddev"] == pytest.approx(sd, rel=1e-8)
        assert lim["ucl"] == pytest.approx(ucl, rel=1e-9, abs=1e-9)
        assert lim["lcl"] == pytest.approx(lcl, rel=1e-9, abs=1e-9)
    assert r_ma["create_date"] == LABEL          # MA keeps the label as text
    assert r_wma["create_date"] is not None      # WMA casts it to a timestamp


TEST_N20 = {  # column -> (MA, WMA, WMA flat, stddev, UCL, LCL)
    "cpu_total_pct": (0.3145, 0.31572, 0.1258, 0.052752151, 0.380981008, 0.248018992),
    "cpu_user_pct": (0.2096, 0.21088, 0.08384, 0.044797086, 0.266055621, 0.153144379),
    "memory_actual_used_pct": (55219636.6, 55219374.24, 22087854.64, 1541.037804789,
                               55221578.696092, 55217694.503908),
    "memory_swap_total": (383442522.0, 383432812.28, 153377008.8, 63905.605327002,
                          383523059.171757, 383361984.828243),
    "diskio_read_time": (0.3153, 0.31538, 0.12612, 0.000801315, 0.316309859, 0.314290141),
    "diskio_write_time": (0.076, 0.076, 0.0304, 0.0, 0.076, 0.076),
    "filesystem_used_pct": (0.592, 0.592, 0.2368, 0.0, 0.592, 0.592),
}


def _check_test_sample(spark, df):
    r_ma = one(moving_average(df, METRIC_COLS, "offset", 20))
    r_wma = one(weighted_moving_average(df, METRIC_COLS, "offset", 20))
    r_flat = one(weighted_moving_average(df, METRIC_COLS, "offset", 20, weighting="flat"))
    limits = {r["field"]: r for r in ewma_limits(df, METRIC_COLS, "offset", 20).collect()}
    for m, (ma, wma, flat, sd, ucl, lcl) in TEST_N20.items():
        out = OUTPUT_NAMES[m]
        assert close(r_ma[out], ma), m
        assert close(r_wma[out], wma), m
        assert close(r_flat[out], flat), m
        assert limits[m]["stddev"] == pytest.approx(sd, rel=1e-6, abs=1e-9), m
        assert limits[m]["ucl"] == pytest.approx(ucl, rel=1e-9, abs=1e-9), m
        assert limits[m]["lcl"] == pytest.approx(lcl, rel=1e-9, abs=1e-9), m


def test_test_sample_padded_values(spark):
    _check_test_sample(spark, decode_records(records(spark, TEST_LINES)))


def test_test_sample_remainder_bias(spark):
    df = decode_records(records(spark, TEST_LINES))
    r = one(weighted_moving_average(df, METRIC_COLS, "offset", 10))
    expected = [0.43985, 0.29885, 77306654.15, 536787290.1, 0.4418, 0.1064, 0.8288]
    for m, e in zip(METRIC_COLS, expected):
        assert close(r[OUTPUT_NAMES[m]], e), m


def test_test3_as_labelled_file(spark, tmp_path):
    path = tmp_path / "test3"
    path.write_text("\n".join(TEST3_LINES) + "\n")
    from tidemark.sources.records import read_metric_file
    df = read_metric_file(spark, str(path), label="create_date")
    assert df.count() == 20
    _check_test_sample(spark, df)
    r = one(weighted_moving_average(df, METRIC_COLS, "offset", 20, label_col="create_date"))
    assert r["create_date"] is not None


def test_test3_line_is_rejected_as_message_value(spark):
    df = decode_records(records(spark, TEST3_LINES))
    with pytest.raises(Exception):
        df.collect()


def test_processing_stamp_pattern(spark):
    df = decode_records(records(spark, TEST2_LINES))
    r = one(moving_average(df, METRIC_COLS, "offset", 20, processing_stamp=True))
    assert re.fullmatch(r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}[+-]\d{4}", r["@timestamp"])
