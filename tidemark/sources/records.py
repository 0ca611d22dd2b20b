"""Metric records: ``(key, value, offset)`` messages and delimited metric files.

A message value is the metric vector as comma-separated numbers (padding with
spaces or tabs is allowed); the key is the record label.  Decoding is pure
Catalyst: ``split`` + ``transform`` + ``cast``, no Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.schema import LABEL_COL, METRIC_COLS, metric_schema
from tidemark.operators.panes import barrier

OFFSET_COL = "offset"


def project_record(df: DataFrame, key: str = "key", value: str = "value",
                   offset: str = "offset", extra: Sequence[str] = ()) -> DataFrame:
    """``(key, value, offset)`` as ``STRING, STRING, LONG`` (binary Kafka columns
    included), plus any ``extra`` columns unchanged (e.g. the message ``timestamp``)."""
    return df.select(F.col(key).cast("string").alias("key"),
                     F.col(value).cast("string").alias("value"),
                     F.col(offset).cast("long").alias(OFFSET_COL), *extra)


def decode_vector(value: Column | str, on_error: str = "fail") -> Column:
    """``"1.0,\\t2 , 3"`` -> ``array<double>``.

    ``on_error="fail"`` raises on any field that is not a number (whatever the
    session's ANSI setting); ``"null"`` turns such fields into nulls.
    """
    if on_error not in ("fail", "null"):
        raise ValueError("on_error must be 'fail' or 'null'")
    v = F.col(value) if isinstance(value, str) else value
    vec = F.transform(F.split(v, ","), lambda x: F.trim(x).try_cast("double"))
    if on_error == "null":
        return vec
    bad = F.exists(vec, lambda x: x.isNull())
    return F.when(bad, F.raise_error(F.concat(F.lit("metric record has a field that is not a number: "),
                                              v))).otherwise(vec)


def decode_records(
    df: DataFrame,
    metrics: Sequence[str] = METRIC_COLS,
    label: str = LABEL_COL,
    on_error: str = "fail",
    keep: Sequence[str] = (OFFSET_COL,),
) -> DataFrame:
    """Message rows -> ``label, metrics.., keep..`` with one double per metric.

    ``on_error="fail"`` (default) stops the job on a non-number, a wrong
    number of fields, a null value or a null key, as the streaming job does;
    ``"null"`` yields nulls for bad or missing numbers instead.  Fields are
    taken from one split by position, so decoding stays in generated code.
    The message, its split and its numbers are evaluated once per row; the
    checks filter on their results and hold whatever columns are read later.
    """
    if on_error not in ("fail", "null"):
        raise ValueError("on_error must be 'fail' or 'null'")
    if on_error == "null":
        parts = F.split("value", ",")
        fields = [F.trim(F.get(parts, F.lit(i))).try_cast("double") for i in range(len(metrics))]
        return df.select(F.col("key").alias(label), *[x.alias(m) for x, m in zip(fields, metrics, strict=True)], *keep)
    own = ["key", "value", *[c for c in keep if c not in ("key", "value")]]
    split = barrier(df, *own, __parts=F.split("value", ","))
    named = [f"__f{i}" for i in range(len(metrics))]
    read = barrier(split, *own, __n=F.size("__parts"), **{
        f: F.trim(F.get("__parts", F.lit(i))).try_cast("double") for i, f in enumerate(named)})
    return read.where(_checked(named)).select(
        F.col("key").alias(label), *[F.col(f).alias(m) for f, m in zip(named, metrics, strict=True)], *keep)


def _checked(fields: Sequence[str]) -> Column:
    """True for a well-formed record; otherwise the query fails with what is wrong."""
    missing = F.lit(False)
    for x in fields:
        missing = missing | F.col(x).isNull()
    return (F.when(F.col("key").isNull(), F.raise_error(F.lit("metric record has a null key")))
            .when(F.col("value").isNull(), F.raise_error(F.lit("metric record has a null value")))
            .when(F.col("__n") != F.lit(len(fields)),
                  F.raise_error(F.concat(F.lit(f"metric record needs {len(fields)} fields, got "),
                                         F.col("__n").cast("string"))))
            .when(missing, F.raise_error(F.concat(F.lit("metric record has a field that is not a number: "),
                                                  F.col("value"))))
            .otherwise(F.lit(True)).cast("boolean"))


#: Why a message is no metric record, the first that holds.
BAD_REASONS = ("null key", "null value", "wrong number of fields", "not a number")


def classify_records(df: DataFrame, metrics: Sequence[str] = METRIC_COLS, label: str = LABEL_COL,
                     keep: Sequence[str] = (OFFSET_COL,)) -> DataFrame:
    """Message rows -> ``label, metrics.., keep.., value, reason``, every row.

    ``reason`` is null for a well-formed record, else one of :data:`BAD_REASONS`;
    the metrics of a bad record are null and ``value`` is its message (null for
    a good one).  The message is split and read once per row.
    """
    own = ["key", "value", *[c for c in keep if c not in ("key", "value")]]
    split = barrier(df, *own, __parts=F.split("value", ","))
    named = [f"__f{i}" for i in range(len(metrics))]
    read = barrier(split, *own, __n=F.size("__parts"), **{
        f: F.trim(F.get("__parts", F.lit(i))).try_cast("double") for i, f in enumerate(named)})
    missing = F.lit(False)
    for f in named:
        missing = missing | F.col(f).isNull()
    tests = (F.col("key").isNull(), F.col("value").isNull(), F.col("__n") != F.lit(len(metrics)), missing)
    reason = F.coalesce(*[F.when(t, F.lit(r)) for t, r in zip(tests, BAD_REASONS, strict=True)])
    known = read.withColumn("__reason", reason)
    good = F.col("__reason").isNull()
    return known.select(F.col("key").alias(label),
                        *[F.when(good, F.col(f)).alias(m) for f, m in zip(named, metrics, strict=True)], *keep,
                        F.when(~good, F.col("value")).alias("value"), F.col("__reason").alias("reason"))


def encode_records(df: DataFrame, metrics: Sequence[str], key: Column | str,
                   offset: Column | str, sep: str = ",") -> DataFrame:
    """Inverse of :func:`decode_records`: pack metric columns into a message value."""
    k = F.col(key) if isinstance(key, str) else key
    o = F.col(offset) if isinstance(offset, str) else offset
    value = F.concat_ws(sep, *[F.col(m).cast("string") for m in metrics])
    return df.select(k.cast("string").alias("key"), value.alias("value"), o.cast("long").alias(OFFSET_COL))


def read_metric_file(
    spark: SparkSession,
    path: str | Sequence[str],
    metrics: Sequence[str] = METRIC_COLS,
    label: str | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Delimited metric files (7 numbers per line, optionally a leading label).

    Adds ``file_path`` and ``offset`` (increasing with the line position
    inside each file), so the newest row of a file is its last line; order by
    ``("file_path", "offset")`` when several files are read together.
    """
    schema = metric_schema(metrics, label)
    df = (spark.read.schema(schema)
          .option("ignoreLeadingWhiteSpace", True)
          .option("ignoreTrailingWhiteSpace", True)
          .option("mode", mode)
          .csv(path))
    return df.select("*", F.col("_metadata.file_path").alias("file_path"),
                     F.monotonically_increasing_id().alias(OFFSET_COL))


def record_schema() -> T.StructType:
    return T.StructType([
        T.StructField("key", T.StringType(), True),
        T.StructField("value", T.StringType(), True),
        T.StructField(OFFSET_COL, T.LongType(), True),
    ])
