"""Registered queries: one Spark plan per operator, each with a DuckDB oracle.

Every query reads the driver tables (``events``, ``lineitem``) at full size.
Double outputs are rounded to 6 decimals in both the Spark plan and the
oracle SQL, so the last-bit differences of two engines summing in different
orders cannot change the comparison.  The rounding is spelled out as
``floor(x * 1e6 + 0.5) / 1e6``: the same three IEEE operations in both
engines, so exact decimal ties (``1125.51 / 32 = 35.1721875``) round the same
way too (the engines' own ``round`` functions break such ties differently).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.schema import (
    METRIC_COLS,
    OUTPUT_NAMES,
    PROCESSING_TS_COL,
    PROCESSING_TS_PATTERN,
    daily_index_name,
    day_bucket,
)
from tidemark.functions.weights import DEFAULT_WEIGHTS, band_bounds, band_weight_sql, denominator, ewma_k
from tidemark.operators.models import (
    aggregate_ranked,
    describe_summary,
    ewma_limits,
    model_table,
    moving_average,
    weighted_moving_average,
)
from tidemark.operators.recent import latest_n
from tidemark.operators.reshape import (
    business_day_index,
    chunk_blocks,
    mean_stddev_rows,
    row_positions,
    summary_to_long,
    transpose,
)
from tidemark.operators.rolling import rolling_threshold
from tidemark.operators.selection import newest_rows
from tidemark.operators.tiles import transpose_fields, transpose_matrix
from tidemark.operators.windows import (
    sliding_aggregate,
    sliding_limits,
    sliding_summary,
    window_count,
    window_threshold,
)
from tidemark.sources.records import classify_records, decode_records, encode_records, project_record
from tidemark.sources.tables import ORDER_METRICS_SQL, order_metrics, table

ROUND_DIGITS = 6


@dataclass
class Query:
    """A registered query: its SURVEY operator ids, the Spark plan and the oracle SQL."""
    name: str
    ops: tuple[str, ...]
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def round_half_up(c, digits: int = ROUND_DIGITS):
    scale = float(10 ** digits)
    return F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def rounded(df: DataFrame, digits: int = ROUND_DIGITS) -> DataFrame:
    """Round every double column (top level) to ``digits`` decimals."""
    return df.select(*[
        round_half_up(F.col(f"`{f.name}`"), digits).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def round_half_up_sql(expr: str, digits: int = ROUND_DIGITS) -> str:
    scale = f"CAST({float(10 ** digits)!r} AS DOUBLE)"
    return f"CAST(floor({expr} * {scale} + CAST(0.5 AS DOUBLE)) AS DOUBLE) / {scale}"


def rounded_sql(inner: str, double_cols: list[str], digits: int = ROUND_DIGITS) -> str:
    if not double_cols:
        return inner
    rep = ", ".join(f'{round_half_up_sql(chr(34) + c + chr(34), digits)} AS "{c}"' for c in double_cols)
    return f"SELECT * REPLACE ({rep}) FROM ({inner}) AS q"


def _d(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def _bw(rank: str, n: int) -> str:
    return band_weight_sql(rank, n, DEFAULT_WEIGHTS)


EV_COLS = "event_id, ts, user_id, event_type, value"
OM_DT = [OUTPUT_NAMES[m] for m in METRIC_COLS]


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events")


# ------------------------------------------------------------------ latest-N

def q_latest_n(spark, sf):
    ev = _events(spark, sf).select("event_id", "ts", "user_id", "event_type", "value")
    return rounded(latest_n(ev, 20, "event_id"))


SQL_LATEST_N = rounded_sql(f"""
SELECT {EV_COLS}, row_number() OVER (ORDER BY event_id DESC) - 1 AS rank
FROM events ORDER BY event_id DESC LIMIT 20""", ["value"])


def q_latest_n_per_series(spark, sf):
    ev = _events(spark, sf).select("event_id", "ts", "user_id", "event_type", "value")
    return rounded(latest_n(ev, 20, "event_id", "user_id"))


SQL_LATEST_N_PER_SERIES = rounded_sql(f"""
SELECT {EV_COLS}, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) - 1 AS rank
FROM events QUALIFY rank < 20""", ["value"])


# ------------------------------------------------------------------ MA

def q_ma_global(spark, sf):
    return rounded(moving_average(_events(spark, sf), ["value"], "event_id", 20, label_col="ts"))


SQL_MA_GLOBAL = rounded_sql("""
SELECT avg(value) AS dt_value, max(ts) AS create_date
FROM (SELECT value, ts FROM events ORDER BY event_id DESC LIMIT 20) t""", ["dt_value"])


def q_ma_per_series(spark, sf):
    return rounded(moving_average(_events(spark, sf), ["value"], "event_id", 20, "user_id", label_col="ts"))


def _per_user_ranked(n: int) -> str:
    return (f"SELECT user_id, value, ts, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) - 1 AS rk "
            f"FROM events QUALIFY rk < {n}")


SQL_MA_PER_SERIES = rounded_sql(f"""
SELECT user_id, avg(value) AS dt_value, max(ts) AS create_date
FROM ({_per_user_ranked(20)}) t GROUP BY user_id""", ["dt_value"])


def q_ma_multi_metric(spark, sf):
    om = order_metrics(spark, sf, newest=20)
    return rounded(moving_average(om, METRIC_COLS, "offset", 20, label_col="create_date"))


SQL_MA_MULTI_METRIC = rounded_sql(
    "SELECT " + ", ".join(f"avg({m}) AS {OUTPUT_NAMES[m]}" for m in METRIC_COLS)
    + f", max(create_date) AS create_date FROM (SELECT * FROM ({ORDER_METRICS_SQL}) o "
      "ORDER BY \"offset\" DESC LIMIT 20) t", OM_DT)


# ------------------------------------------------------------------ WMA

def _wma_sql_per_user(n: int, flat: bool = False, col: str = "dt_value") -> str:
    d = denominator(n, DEFAULT_WEIGHTS)
    w = _d(DEFAULT_WEIGHTS[0]) if flat else _bw("rk", n)
    return rounded_sql(f"""
SELECT user_id, sum(value * {w}) / NULLIF({_d(d)}, 0) AS {col}, max(ts) AS create_date
FROM ({_per_user_ranked(n)}) t GROUP BY user_id""", [col])


def q_wma_global(spark, sf):
    return rounded(weighted_moving_average(_events(spark, sf), ["value"], "event_id", 20, label_col="ts"))


SQL_WMA_GLOBAL = rounded_sql(f"""
SELECT sum(value * {_bw('rk', 20)}) / NULLIF({_d(denominator(20))}, 0) AS dt_value, max(ts) AS create_date
FROM (SELECT value, ts, row_number() OVER (ORDER BY event_id DESC) - 1 AS rk
      FROM events ORDER BY event_id DESC LIMIT 20) t""", ["dt_value"])


def _wma_user(n: int, weighting: str = "banded"):
    def build(spark, sf):
        return rounded(weighted_moving_average(_events(spark, sf), ["value"], "event_id", n, "user_id",
                                               weighting=weighting, label_col="ts"))
    return build


def q_wma_multi_metric(spark, sf):
    om = order_metrics(spark, sf, newest=20)
    return rounded(weighted_moving_average(om, METRIC_COLS, "offset", 20, label_col="create_date"))


def _wma_multi_sql(n: int) -> str:
    d = _d(denominator(n))
    sums = ", ".join(f"sum({m} * {_bw('rk', n)}) / NULLIF({d}, 0) AS {OUTPUT_NAMES[m]}" for m in METRIC_COLS)
    return rounded_sql(
        f"SELECT {sums}, max(TRY_CAST(create_date AS TIMESTAMP)) AS create_date FROM ("
        f"SELECT *, row_number() OVER (ORDER BY \"offset\" DESC) - 1 AS rk FROM ({ORDER_METRICS_SQL}) o "
        f"ORDER BY \"offset\" DESC LIMIT {n}) t", OM_DT)


# ------------------------------------------------------------------ record decode path

PAD_SEP = ",\t "


def _records_from_order_metrics(spark, sf) -> DataFrame:
    """One message per order, for every order."""
    om = order_metrics(spark, sf)
    return project_record(encode_records(om, METRIC_COLS, "create_date", "offset", sep=PAD_SEP))


def q_decode_vector(spark, sf):
    li = table(spark, sf, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_partkey", "l_suppkey"]
    recs = encode_records(li, cols, F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(0), sep=PAD_SEP)
    return rounded(decode_records(recs, METRIC_COLS, keep=()))


SQL_DECODE_VECTOR = rounded_sql(
    "SELECT strftime(l_shipdate, '%Y-%m-%d') AS create_date, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {m}" for c, m in zip(
        ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_partkey", "l_suppkey"],
        METRIC_COLS))
    + " FROM lineitem", list(METRIC_COLS))


def q_metric_file_read(spark, sf):
    """Metric records written as padded delimited text (label first), read back as a metric file."""
    from tidemark.session import scratch_path
    from tidemark.sources.records import read_metric_file
    path = scratch_path(spark, "metric-file")
    om = order_metrics(spark, sf)
    line = F.concat_ws(PAD_SEP, F.col("create_date"), *[F.col(m).cast("string") for m in METRIC_COLS])
    om.select(line.alias("line")).write.text(path)
    df = read_metric_file(spark, path, label="create_date")
    return rounded(df.select("create_date", *METRIC_COLS))


SQL_METRIC_FILE_READ = rounded_sql(
    f"SELECT create_date, {', '.join(METRIC_COLS)} FROM ({ORDER_METRICS_SQL}) o", list(METRIC_COLS))


def q_record_wma(spark, sf):
    """Message rows -> newest 20 by offset -> decode -> banded WMA (the job's WMA path)."""
    recs = _records_from_order_metrics(spark, sf)
    top = latest_n(recs, 20, "offset", rank_col="rank")
    return rounded(aggregate_ranked(decode_records(top, keep=("rank",)), "WMA", METRIC_COLS, 20, [],
                                    "rank", label_col="create_date"))


def q_record_ma(spark, sf):
    """Message rows -> newest 20 by offset -> decode -> MA (the job's default path)."""
    recs = _records_from_order_metrics(spark, sf)
    top = latest_n(recs, 20, "offset", rank_col="rank")
    return rounded(aggregate_ranked(decode_records(top, keep=("rank",)), "MA", METRIC_COLS, 20, [],
                                    "rank", label_col="create_date"))


# ------------------------------------------------------------------ summary / EWMA

def q_summary_long(spark, sf):
    om = order_metrics(spark, sf, newest=100)
    return rounded(summary_to_long(describe_summary(om, METRIC_COLS, "offset", 100), METRIC_COLS))


def _summary_sql(src: str, keys: list[str], n: int, order: str, fields: list[str]) -> str:
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    k = "".join(f"{c}, " for c in keys)
    ranked = (f"SELECT * FROM (SELECT *, row_number() OVER ({part}ORDER BY {order} DESC) AS rn FROM ({src}) s) "
              f"r WHERE rn <= {n}")
    stats = {
        "count": "CAST(count({f}) AS DOUBLE)",
        "mean": "avg({f})",
        "stddev": "stddev_samp({f})",
        "min": "CAST(min({f}) AS DOUBLE)",
        "max": "CAST(max({f}) AS DOUBLE)",
    }
    selects = []
    for f in fields:
        for s, tmpl in stats.items():
            selects.append(f"SELECT {k}'{s}' AS metric, '{f}' AS field, {tmpl.format(f=f)} AS value "
                           f"FROM ({ranked}) x" + (f" GROUP BY {', '.join(keys)}" if keys else ""))
    return rounded_sql(" UNION ALL ".join(selects), ["value"])


SQL_SUMMARY_LONG = _summary_sql(ORDER_METRICS_SQL, [], 100, '"offset"', list(METRIC_COLS))


def q_summary_mean_stddev(spark, sf):
    om = order_metrics(spark, sf, newest=100)
    return rounded(mean_stddev_rows(summary_to_long(describe_summary(om, METRIC_COLS, "offset", 100),
                                                    METRIC_COLS)))


SQL_SUMMARY_MEAN_STDDEV = (f"SELECT * FROM ({SQL_SUMMARY_LONG}) z WHERE metric IN ('mean', 'stddev')")


def q_summary_per_series(spark, sf):
    ev = _events(spark, sf)
    return rounded(summary_to_long(describe_summary(ev, ["value"], "event_id", 100, "event_type"),
                                   ["value"], ["event_type", "metric"]))


SQL_SUMMARY_PER_SERIES = _summary_sql("SELECT * FROM events", ["event_type"], 100, "event_id", ["value"])


def q_summary_whole_table(spark, sf):
    ev = _events(spark, sf)
    return rounded(summary_to_long(describe_summary(ev, ["value", "user_id"]), ["value", "user_id"]))


def _summary_all_sql(src: str, fields: list[str]) -> str:
    stats = {
        "count": "CAST(count({f}) AS DOUBLE)",
        "mean": "avg({f})",
        "stddev": "stddev_samp({f})",
        "min": "CAST(min({f}) AS DOUBLE)",
        "max": "CAST(max({f}) AS DOUBLE)",
    }
    parts = [f"SELECT '{s}' AS metric, '{f}' AS field, {t.format(f=f)} AS value FROM {src}"
             for f in fields for s, t in stats.items()]
    return rounded_sql(" UNION ALL ".join(parts), ["value"])


SQL_SUMMARY_WHOLE_TABLE = _summary_all_sql("events", ["value", "user_id"])


def _ewma_sql(src: str, keys: list[str], n: int, order: str, fields: list[str], lam: float = 0.3) -> str:
    c = _d(3 * ewma_k(lam))
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    k = "".join(f"{x}, " for x in keys)
    ranked = (f"SELECT * FROM (SELECT *, row_number() OVER ({part}ORDER BY {order} DESC) AS rn FROM ({src}) s) "
              f"r WHERE rn <= {n}")
    parts = []
    for f in fields:
        parts.append(f"SELECT {k}'{f}' AS field, avg({f}) AS mean, stddev_samp({f}) AS stddev FROM ({ranked}) x"
                     + (f" GROUP BY {', '.join(keys)}" if keys else ""))
    inner = (f"SELECT *, mean + {c} * stddev AS ucl, mean - {c} * stddev AS lcl "
             f"FROM ({' UNION ALL '.join(parts)}) u")
    return rounded_sql(inner, ["mean", "stddev", "ucl", "lcl"])


def q_ewma_limits(spark, sf):
    om = order_metrics(spark, sf, newest=100)
    return rounded(ewma_limits(om, METRIC_COLS, "offset", 100))


SQL_EWMA_LIMITS = _ewma_sql(ORDER_METRICS_SQL, [], 100, '"offset"', list(METRIC_COLS))


def q_ewma_limits_per_series(spark, sf):
    return rounded(ewma_limits(_events(spark, sf), ["value"], "event_id", 100, "event_type"))


SQL_EWMA_LIMITS_PER_SERIES = _ewma_sql("SELECT * FROM events", ["event_type"], 100, "event_id", ["value"])


def q_model_dispatch(spark, sf):
    ev = _events(spark, sf)
    return rounded(model_table(ev, ("MA", "WMA", "WMA_FLAT"), ["value"], "event_id", 20, "user_id"))


SQL_MODEL_DISPATCH = rounded_sql(f"""
SELECT 'MA' AS model, user_id, avg(value) AS dt_value FROM ({_per_user_ranked(20)}) a GROUP BY user_id
UNION ALL
SELECT 'WMA', user_id, sum(value * {_bw('rk', 20)}) / NULLIF({_d(denominator(20))}, 0)
FROM ({_per_user_ranked(20)}) b GROUP BY user_id
UNION ALL
SELECT 'WMA_FLAT', user_id, sum(value * {_d(DEFAULT_WEIGHTS[0])}) / NULLIF({_d(denominator(20))}, 0)
FROM ({_per_user_ranked(20)}) c GROUP BY user_id""", ["dt_value"])


# ------------------------------------------------------------------ labels and days

def q_label_cast(spark, sf):
    from tidemark.functions.schema import label_to_timestamp
    ev = _events(spark, sf).select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
                                   .alias("create_date"))
    return ev.select("event_id", "create_date", label_to_timestamp("create_date", ntz=True).alias("label_ts"))


SQL_LABEL_CAST = """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS create_date, ts AS label_ts FROM events"""


def q_day_bucket(spark, sf):
    ev = _events(spark, sf)
    return ev.groupBy(day_bucket("ts").alias("day"), daily_index_name("ts").alias("index_name")).agg(
        F.count(F.lit(1)).alias("n_rows"))


SQL_DAY_BUCKET = """
SELECT strftime(ts, '%Y_%m_%d') AS day, 'poc_os_metric_dt_' || strftime(ts, '%Y_%m_%d') AS index_name,
       count(*) AS n_rows
FROM events GROUP BY 1, 2"""


# ------------------------------------------------------------------ sliding windows

def _win_expand_sql(length_s: int, slide_s: int, cols: str, src: str = "events") -> str:
    k = length_s // slide_s
    return (f"SELECT {cols}, time_bucket(INTERVAL '{slide_s} seconds', ts, TIMESTAMP '1970-01-01') "
            f"- to_seconds(i * {slide_s}) AS window_start FROM {src} CROSS JOIN range(0, {k}) r(i)")


def q_sliding_count(spark, sf):
    return window_count(_events(spark, sf), "ts", 1200, 60)


SQL_SLIDING_COUNT = f"""
SELECT window_start, window_start + INTERVAL '1200 seconds' AS window_end, count(*) AS n_rows
FROM ({_win_expand_sql(1200, 60, 'ts')}) w GROUP BY window_start"""


def q_sliding_avg(spark, sf):
    # The metric is the value in integer cents: window sums are then exact in
    # any summation order, and the average is a single division in both
    # engines.  (With the raw doubles, averages such as 1125.51 / 32 fall on
    # an exact decimal tie at the 7th digit, where summation-order noise alone
    # decides the rounding.)
    ev = _events(spark, sf).withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    return rounded(sliding_aggregate(ev, "ts", 3600, 600, ["cents"], "event_type"))


SQL_SLIDING_AVG = rounded_sql(f"""
SELECT event_type, window_start, window_start + INTERVAL '3600 seconds' AS window_end, count(*) AS n_rows,
       CAST(sum(cents) AS BIGINT) AS cents_sum, sum(cents) / count(cents) AS cents_avg, min(cents) AS cents_min,
       max(cents) AS cents_max
FROM ({_win_expand_sql(3600, 600, 'event_type, CAST(round(value * 100) AS BIGINT) AS cents, ts')}) w
GROUP BY event_type, window_start""", ["cents_avg"])


def _window_model(model: str, length_s: int, slide_s: int, n: int, series: list[str]):
    def build(spark, sf):
        return rounded(window_threshold(_events(spark, sf), model, "ts", length_s, slide_s, ["value"],
                                        "event_id", n, series, label_col="ts"))
    return build


def _window_model_sql(model: str, length_s: int, slide_s: int, n: int, series: list[str],
                      order: str = "event_id DESC") -> str:
    keys = "".join(f"{c}, " for c in series)
    exp = _win_expand_sql(length_s, slide_s, f"{keys}event_id, value, ts")
    ranked = (f"SELECT *, row_number() OVER (PARTITION BY {keys}window_start ORDER BY {order}) - 1 AS rk "
              f"FROM ({exp}) e QUALIFY rk < {n}")
    if model == "MA":
        val = "avg(value)"
    else:
        val = f"sum(value * {_bw('rk', n)}) / NULLIF({_d(denominator(n))}, 0)"
    return rounded_sql(
        f"SELECT {keys}window_start, window_start + INTERVAL '{length_s} seconds' AS window_end, "
        f"count(*) AS n_rows, {val} AS dt_value, max(ts) AS create_date FROM ({ranked}) r "
        f"GROUP BY {keys}window_start", ["dt_value"])


# ------------------------------------------------------------------ reshape

def q_transpose(spark, sf):
    ev = _events(spark, sf)
    top = latest_n(ev.select("user_id", "event_id", "value"), 8, "event_id", "user_id")
    top = top.withColumn("event_id", F.col("event_id").cast("double"))
    return rounded(transpose(top, ["value", "event_id"], "rank", 8, "user_id"))


def _transpose_sql() -> str:
    ranked = ("SELECT user_id, value, CAST(event_id AS DOUBLE) AS event_id, "
              "row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) - 1 AS rk FROM events QUALIFY rk < 8")
    parts = []
    for f in ("value", "event_id"):
        cols = ", ".join(f"max(CASE WHEN rk = {i} THEN {f} END) AS p{i}" for i in range(8))
        parts.append(f"SELECT user_id, '{f}' AS field, {cols} FROM ({ranked}) r GROUP BY user_id")
    return rounded_sql(" UNION ALL ".join(parts), [f"p{i}" for i in range(8)])


def q_transpose_series(spark, sf):
    """Every instant of every series, turned: blocks of 1,024 positions per field."""
    ev = _events(spark, sf).select("event_type", "event_id", "value", "user_id")
    pos = row_positions(ev, "event_id", "event_type", "pos")
    out = transpose_fields(pos, ["value", "user_id"], "pos", "event_type", size=1024)
    return out.withColumn("values", F.transform("values", lambda x: round_half_up(x)))


def _transpose_series_sql() -> str:
    fields = " UNION ALL ".join(
        f"SELECT event_type, '{f}' AS field, event_id, CAST({f} AS DOUBLE) AS x FROM events" for f in ("value", "user_id"))
    return f"""
SELECT event_type, field, block, block * 1024 AS start, list({round_half_up_sql("x")} ORDER BY pos) AS values
FROM (SELECT *, pos // 1024 AS block
      FROM (SELECT *, row_number() OVER (PARTITION BY event_type, field ORDER BY event_id) - 1 AS pos FROM ({fields}) f) n) p
GROUP BY event_type, field, block"""


def q_transpose_matrix(spark, sf):
    """The embedding matrix, turned: each dimension over all vectors in order of ``vec_id``."""
    pos = row_positions(table(spark, sf, "embeddings").select("vec_id", "embedding"), "vec_id", position_col="pos")
    out = transpose_matrix(pos, "pos", "embedding", tile_rows=512, tile_cols=16)
    return out.withColumn("values", F.transform("values", lambda x: round_half_up(x.cast("double"))))


SQL_TRANSPOSE_MATRIX = """
SELECT "column", block, block * 512 AS start, list(""" + round_half_up_sql("CAST(x AS DOUBLE)") + """ ORDER BY pos) AS values
FROM (SELECT pos, pos // 512 AS block, unnest(embedding) AS x, unnest(range(len(embedding))) AS "column"
      FROM (SELECT embedding, row_number() OVER (ORDER BY vec_id) - 1 AS pos FROM embeddings) n) p
GROUP BY "column", block"""


def q_chunk_blocks(spark, sf):
    ev = _events(spark, sf).select("user_id", "event_id", "value")
    pos = row_positions(ev, "event_id", "user_id", "pos")
    out = chunk_blocks(pos, ["value"], "pos", 16, "user_id")
    return out.select("user_id", "block", "n_rows",
                      F.transform("value", lambda x: round_half_up(x)).alias("value"))


SQL_CHUNK_BLOCKS = """
SELECT user_id, block, count(*) AS n_rows, list(""" + round_half_up_sql("value") + """ ORDER BY pos) AS value
FROM (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos,
             (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 16 AS block
      FROM events) p
GROUP BY user_id, block"""


def q_chunk_blocks_null_series(spark, sf):
    """Blocks of a series column that holds nulls: they are one more series."""
    ev = _events(spark, sf).select(F.nullif(F.col("user_id") % 5, F.lit(0)).alias("grp"), "event_id", "value")
    out = chunk_blocks(row_positions(ev, "event_id", "grp", "pos"), ["value"], "pos", 64, "grp")
    return out.select("grp", "block", "n_rows", F.transform("value", lambda x: round_half_up(x)).alias("value"))


SQL_CHUNK_BLOCKS_NULL_SERIES = """
SELECT grp, block, count(*) AS n_rows, list(""" + round_half_up_sql("value") + """ ORDER BY pos) AS value
FROM (SELECT grp, value, row_number() OVER (PARTITION BY grp ORDER BY event_id) - 1 AS pos,
             (row_number() OVER (PARTITION BY grp ORDER BY event_id) - 1) // 64 AS block
      FROM (SELECT *, NULLIF(user_id % 5, 0) AS grp FROM events) e) p
GROUP BY grp, block"""


def q_latest_n_per_series_large(spark, sf):
    ev = _events(spark, sf).select("event_id", "ts", "user_id", "event_type", "value")
    return rounded(latest_n(ev, 1500, "event_id", "event_type"))


SQL_LATEST_N_PER_SERIES_LARGE = rounded_sql(f"""
SELECT {EV_COLS}, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) - 1 AS rank
FROM events QUALIFY rank < 1500""", ["value"])


def q_wma_label_zone(spark, sf):
    """Labels of mixed zones: the same instants, written as UTC or nine hours ahead."""
    text = F.when(F.col("event_id") % 2 == 0, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
    ahead = F.col("ts") + F.expr("INTERVAL 9 HOURS")
    text = text.otherwise(F.concat(F.date_format(ahead, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+09:00")))
    ev = _events(spark, sf).select("user_id", "event_id", "value", text.alias("label"))
    return rounded(weighted_moving_average(ev, ["value"], "event_id", 20, "user_id", label_col="label"))


def q_processing_stamp(spark, sf):
    """Thresholds with their run stamp: how many, and how many stamps parse and lie within the run."""
    ev = _events(spark, sf)
    out = moving_average(ev, ["value"], "event_id", 20, "user_id", processing_stamp=True)
    at = F.try_to_timestamp(F.col(PROCESSING_TS_COL), F.lit(PROCESSING_TS_PATTERN))
    now = F.current_timestamp()
    good = (at >= now - F.expr("INTERVAL 1 HOUR")) & (at <= now + F.expr("INTERVAL 1 SECOND"))
    return out.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(good.cast("long")).alias("n_stamped"))


SQL_WINDOW_LATEST_N_EWMA = _ewma_sql(
    f"SELECT *, window_start + INTERVAL '21600 seconds' AS window_end "
    f"FROM ({_win_expand_sql(21600, 3600, 'event_type, event_id, value, ts')}) w",
    ["event_type", "window_start", "window_end"], 20, "event_id", ["value"])


def q_window_latest_n_ewma(spark, sf):
    """Control limits inside every sliding window of each event type."""
    return rounded(window_threshold(_events(spark, sf), "EWMA", "ts", 21600, 3600, ["value"], "event_id", 20,
                                    ["event_type"]))


def q_window_latest_n_ts_order(spark, sf):
    """The default window settings, newest by two columns (time, then id)."""
    ev = _events(spark, sf)
    return rounded(window_threshold(ev, "MA", "ts", 6000, 60, ["value"], ["ts", "event_id"], 100, label_col="ts"))


def q_window_latest_n_ts_series(spark, sf):
    """Newest rows per window of timestamp series, some a microsecond apart, with a null series; one-column order."""
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        secs=(F.col("user_id") % 5).cast("decimal(18,6)") / F.lit(1000000))
    ev = _events(spark, sf).withColumn("series", F.when(F.col("user_id") % 5 > 0, at))
    return rounded(window_threshold(ev, "MA", "ts", 72000, 3600, ["value"], "event_id", 20, ["series"], label_col="ts"))


SQL_TS_SERIES = ("(SELECT *, CASE WHEN user_id % 5 > 0 THEN TIMESTAMP '2024-01-01 00:00:00' "
                 "+ to_microseconds(user_id % 5) END AS series FROM events) s")
SQL_WINDOW_LATEST_N_TS_SERIES = _window_model_sql("MA", 72000, 3600, 20, ["series"]).replace("FROM events", f"FROM {SQL_TS_SERIES}")


def q_sliding_summary(spark, sf):
    """Count, mean, stddev, least and largest value of every sliding window, from merged panes."""
    return rounded(sliding_summary(_events(spark, sf), "ts", 21600, 3600, ["value"], ["event_type"]))


def _sliding_stats_sql(length_s: int, slide_s: int) -> str:
    return (f"SELECT event_type, window_start, window_start + INTERVAL '{length_s} seconds' AS window_end, "
            f"CAST(count(value) AS DOUBLE) AS c, avg(value) AS mean, stddev_samp(value) AS stddev, min(value) AS lo, "
            f"max(value) AS hi FROM ({_win_expand_sql(length_s, slide_s, 'event_type, value, ts')}) w "
            f"GROUP BY event_type, window_start")


SQL_SLIDING_SUMMARY = rounded_sql(" UNION ALL ".join(
    f"SELECT event_type, window_start, window_end, '{metric}' AS metric, {column} AS value "
    f"FROM ({_sliding_stats_sql(21600, 3600)}) s"
    for metric, column in (("count", "c"), ("mean", "mean"), ("stddev", "stddev"), ("min", "lo"), ("max", "hi"))),
    ["value"])


def q_sliding_limits(spark, sf):
    """Control limits over all rows of every 100-minute window, sliding by one minute."""
    return rounded(sliding_limits(_events(spark, sf), "ts", 6000, 60, ["value"], ["event_type"]))


SQL_SLIDING_LIMITS = rounded_sql(
    f"SELECT event_type, window_start, window_end, 'value' AS field, mean, stddev, mean + {_d(3 * ewma_k(0.3))} * stddev AS ucl, "
    f"mean - {_d(3 * ewma_k(0.3))} * stddev AS lcl FROM ({_sliding_stats_sql(6000, 60)}) s",
    ["mean", "stddev", "ucl", "lcl"])


def q_business_day_index(spark, sf):
    starts = _events(spark, sf).groupBy("event_type").agg(F.min("ts").alias("start"))
    return business_day_index(starts, "start", 5, 2).select("event_type", "period", "day")


SQL_BUSINESS_DAY_INDEX = """
SELECT event_type, CAST((rn - 1) // 2 AS INTEGER) AS period, day
FROM (SELECT event_type, CAST(d AS DATE) AS day,
             row_number() OVER (PARTITION BY event_type ORDER BY d) AS rn
      FROM (SELECT event_type, CAST(min(ts) AS DATE) AS start FROM events GROUP BY event_type) s,
           generate_series(start, start + INTERVAL 21 DAY, INTERVAL 1 DAY) g(d)
      WHERE isodow(d) < 6) b
WHERE (rn - 1) % 2 = 0 AND rn <= 9"""


# ------------------------------------------------------------------ large N, every record, bad records

def q_latest_n_tenth(spark, sf):
    """The newest tenth of all events, ranked: an N that grows with the table."""
    ev = _events(spark, sf).select("event_id", "ts", "user_id", "event_type", "value")
    return rounded(newest_rows(ev, ev.count() // 10, ["ts", "event_id"]))


SQL_LATEST_N_TENTH = rounded_sql(f"""
SELECT {EV_COLS}, row_number() OVER (ORDER BY ts DESC, event_id DESC) - 1 AS rank
FROM events QUALIFY rank < (SELECT count(*) // 10 FROM events)""", ["value"])


def _rolling(model: str, n: int, series: list[str]):
    def build(spark, sf):
        """The model at every event, over the newest n up to it."""
        return rounded(rolling_threshold(_events(spark, sf), model, ["value"], "event_id", n, series))
    return build


def q_rolling_ma(spark, sf):
    """Mean of the newest 64 whole cents at every event (whole numbers: averages over 32 or 64 rows are often decimal ties)."""
    ev = _events(spark, sf).withColumn("value", F.floor(F.col("value") * 100 + 0.5).cast("double"))
    return rounded(rolling_threshold(ev, "MA", ["value"], "event_id", 64, "event_type"))


def _rolling_sql(model: str, n: int, series: list[str]) -> str:
    over = f"OVER ({f'PARTITION BY {chr(44).join(series)} ' if series else ''}ORDER BY event_id ROWS BETWEEN"
    if model == "MA":
        expr = f"avg(value) {over} {n - 1} PRECEDING AND CURRENT ROW)"
    elif model == "WMA_FLAT":
        expr = f"sum(value) {over} {n - 1} PRECEDING AND CURRENT ROW) * {_d(DEFAULT_WEIGHTS[0])} / {_d(denominator(n))}"
    else:
        bounds = [0, *band_bounds(n)]
        bands = [f"coalesce(sum(value) {over} {b - 1} PRECEDING AND {a} PRECEDING) * {_d(w)}, 0)"
                 for a, b, w in zip(bounds, bounds[1:], DEFAULT_WEIGHTS, strict=False)]
        expr = f"({' + '.join(bands)}) / {_d(denominator(n))}"
    keys = "".join(f"{c}, " for c in series)
    return rounded_sql(f"SELECT {keys}event_id, {expr} AS dt_value FROM events", ["dt_value"])


RECORD_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "l_partkey", "l_suppkey"]


def line_messages(spark, sf) -> DataFrame:
    """One message per line item; lines 1 to 4 have no key, no value, a text field or a field less."""
    li, line = table(spark, sf, "lineitem"), F.col("l_linenumber")
    fields = [F.col(c).cast("string") for c in RECORD_COLS]
    value = (F.when(line == 2, F.lit(None)).when(line == 3, F.concat_ws(PAD_SEP, *fields[:-1], "l_returnflag"))
             .when(line == 4, F.concat_ws(PAD_SEP, *fields[:-1])).otherwise(F.concat_ws(PAD_SEP, *fields)))
    return li.select(F.when(line != 1, F.date_format("l_shipdate", "yyyy-MM-dd")).alias("key"), value.alias("value"),
                     F.col("l_orderkey").alias("offset"))


def q_record_split(spark, sf):
    """Every message, decoded or with the reason why not."""
    return rounded(classify_records(line_messages(spark, sf)).drop("value"))


SQL_RECORD_SPLIT = rounded_sql(
    "SELECT CASE WHEN l_linenumber <> 1 THEN strftime(l_shipdate, '%Y-%m-%d') END AS create_date, "
    + ", ".join(f"CASE WHEN l_linenumber > 4 THEN CAST({c} AS DOUBLE) END AS {m}" for c, m in zip(RECORD_COLS, METRIC_COLS, strict=True))
    + ", l_orderkey AS \"offset\", CASE l_linenumber WHEN 1 THEN 'null key' WHEN 2 THEN 'null value' "
      "WHEN 3 THEN 'not a number' WHEN 4 THEN 'wrong number of fields' END AS reason FROM lineitem", list(METRIC_COLS))


# ------------------------------------------------------------------ registry

def _q(name, ops, build, sql=None):
    return Query(name, tuple(ops), build, sql)


QUERIES: list[Query] = [
    _q("latest_n", ["T1", "T3"], q_latest_n, SQL_LATEST_N),
    _q("latest_n_per_series", ["T2", "T3"], q_latest_n_per_series, SQL_LATEST_N_PER_SERIES),
    _q("ma_global", ["T1", "A1", "A6"], q_ma_global, SQL_MA_GLOBAL),
    _q("ma_per_series", ["T2", "A1", "A6"], q_ma_per_series, SQL_MA_PER_SERIES),
    _q("ma_multi_metric", ["T1", "A1", "A6", "E1", "S6"], q_ma_multi_metric, SQL_MA_MULTI_METRIC),
    _q("wma_global", ["T1", "T3", "M1", "M2", "M3", "M4", "A2", "E4"], q_wma_global, SQL_WMA_GLOBAL),
    _q("wma_per_series", ["T2", "T3", "M1", "M2", "M3", "A2", "E4"], _wma_user(20), _wma_sql_per_user(20)),
    _q("wma_remainder", ["A2", "M1", "M3"], _wma_user(10), _wma_sql_per_user(10)),
    _q("wma_small_n", ["A2", "M3"], _wma_user(3), _wma_sql_per_user(3)),
    _q("wma_partial_window", ["A2", "T2"], _wma_user(80), _wma_sql_per_user(80)),
    _q("wma_flat", ["A3"], _wma_user(20, "flat"), _wma_sql_per_user(20, flat=True)),
    _q("wma_multi_metric", ["A2", "E1", "E3", "S6"], q_wma_multi_metric, _wma_multi_sql(20)),
    _q("decode_vector", ["S3", "S4", "S5"], q_decode_vector, SQL_DECODE_VECTOR),
    _q("metric_file_read", ["S7", "S6"], q_metric_file_read, SQL_METRIC_FILE_READ),
    _q("record_wma", ["S3", "S4", "S5", "T1", "A2", "E3"], q_record_wma, _wma_multi_sql(20)),
    _q("record_ma", ["S3", "S4", "S5", "T1", "A1"], q_record_ma, SQL_MA_MULTI_METRIC),
    _q("summary_long", ["A4", "R1"], q_summary_long, SQL_SUMMARY_LONG),
    _q("summary_mean_stddev", ["A4", "R1", "E5"], q_summary_mean_stddev, SQL_SUMMARY_MEAN_STDDEV),
    _q("summary_per_series", ["A4", "R1", "T2"], q_summary_per_series, SQL_SUMMARY_PER_SERIES),
    _q("summary_whole_table", ["A4", "R1"], q_summary_whole_table, SQL_SUMMARY_WHOLE_TABLE),
    _q("ewma_limits", ["M5", "M6", "E6", "E8"], q_ewma_limits, SQL_EWMA_LIMITS),
    _q("ewma_limits_per_series", ["M5", "M6", "E6", "E8", "T2"], q_ewma_limits_per_series,
       SQL_EWMA_LIMITS_PER_SERIES),
    _q("model_dispatch", ["M7"], q_model_dispatch, SQL_MODEL_DISPATCH),
    _q("label_cast", ["E3"], q_label_cast, SQL_LABEL_CAST),
    _q("day_bucket", ["E7", "K1"], q_day_bucket, SQL_DAY_BUCKET),
    _q("sliding_count", ["A5", "W2"], q_sliding_count, SQL_SLIDING_COUNT),
    _q("sliding_avg", ["W2"], q_sliding_avg, SQL_SLIDING_AVG),
    _q("window_latest_n_ma", ["W2", "W5", "A1"], _window_model("MA", 3600, 600, 10, []),
       _window_model_sql("MA", 3600, 600, 10, [])),
    _q("window_latest_n_wma", ["W2", "W5", "A2"], _window_model("WMA", 21600, 3600, 20, ["event_type"]),
       _window_model_sql("WMA", 21600, 3600, 20, ["event_type"])),
    _q("window_latest_n_default", ["W2", "W5", "A2", "M1", "M3"], _window_model("WMA", 6000, 60, 100, []),
       _window_model_sql("WMA", 6000, 60, 100, [])),
    _q("transpose", ["R2"], q_transpose, _transpose_sql()),
    _q("transpose_series", ["R2"], q_transpose_series, _transpose_series_sql()),
    _q("transpose_matrix", ["R2"], q_transpose_matrix, SQL_TRANSPOSE_MATRIX),
    _q("chunk_blocks", ["R3"], q_chunk_blocks, SQL_CHUNK_BLOCKS),
    _q("chunk_blocks_null_series", ["R3"], q_chunk_blocks_null_series, SQL_CHUNK_BLOCKS_NULL_SERIES),
    _q("latest_n_per_series_large", ["T2", "T3"], q_latest_n_per_series_large, SQL_LATEST_N_PER_SERIES_LARGE),
    _q("wma_label_zone", ["A2", "A6", "E3"], q_wma_label_zone, _wma_sql_per_user(20)),
    _q("processing_stamp", ["E2"], q_processing_stamp,
       "SELECT count(DISTINCT user_id) AS n_rows, count(DISTINCT user_id) AS n_stamped FROM events"),
    _q("window_latest_n_ewma", ["W2", "W5", "M5", "M6"], q_window_latest_n_ewma, SQL_WINDOW_LATEST_N_EWMA),
    _q("window_latest_n_ts_order", ["W2", "W5", "A1"], q_window_latest_n_ts_order,
       _window_model_sql("MA", 6000, 60, 100, [], "ts DESC, event_id DESC")),
    _q("window_latest_n_ts_series", ["W2", "W5", "A1"], q_window_latest_n_ts_series, SQL_WINDOW_LATEST_N_TS_SERIES),
    _q("sliding_summary", ["A4", "W2"], q_sliding_summary, SQL_SLIDING_SUMMARY),
    _q("sliding_limits", ["M5", "W2", "E8"], q_sliding_limits, SQL_SLIDING_LIMITS),
    _q("business_day_index", ["R4"], q_business_day_index, SQL_BUSINESS_DAY_INDEX),
    _q("latest_n_tenth", ["T1", "T3"], q_latest_n_tenth, SQL_LATEST_N_TENTH),
    _q("rolling_wma", ["A2", "M1", "M3"], _rolling("WMA", 20, ["user_id"]), _rolling_sql("WMA", 20, ["user_id"])),
    _q("rolling_wma_one_series", ["A2", "M1", "M3"], _rolling("WMA", 22, []), _rolling_sql("WMA", 22, [])),
    _q("rolling_wma_flat", ["A3"], _rolling("WMA_FLAT", 20, ["event_type"]), _rolling_sql("WMA_FLAT", 20, ["event_type"])),
    _q("rolling_ma", ["A1"], q_rolling_ma, _rolling_sql("MA", 64, ["event_type"]).replace(
        "FROM events", "FROM (SELECT event_type, event_id, CAST(floor(value * 100 + 0.5) AS DOUBLE) AS value FROM events) e")),
    _q("record_split", ["S3", "S4", "S5", "W4"], q_record_split, SQL_RECORD_SPLIT),
]


def registry() -> dict[str, Query]:
    from tidemark.streaming.queries import STREAM_QUERIES
    return {q.name: q for q in [*QUERIES, *STREAM_QUERIES]}
