"""Transposes of any size by exchanged tiles."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.reshape import transpose
from tidemark.operators.tiles import transpose_fields, transpose_matrix

DRAW = random.Random(8)


def brute(rows, tile_rows, tile_cols):
    """{(series, column, block): values} of (series, position, array) rows."""
    tiles = {}
    for s, p, a in rows:
        for c in range(0, len(a or []), tile_cols):
            tiles.setdefault((s, p // tile_rows, c), {})[p % tile_rows] = a[c : c + tile_cols]
    out = {}
    for (s, b, c), parts in tiles.items():
        for i in range(max(map(len, parts.values()))):
            out[s, c + i, b] = [parts[k][i] if k in parts and i < len(parts[k]) else None for k in range(max(parts) + 1)]
    return out


def turned(df, *args, **kw):
    return {(r["s"], r["column"], r["block"]): r["values"] for r in transpose_matrix(df, "p", "a", "s", *args, **kw).collect()}


@pytest.mark.parametrize("tile_rows,tile_cols", [(1, 1), (7, 3), (64, 64)])
def test_transpose_matrix_with_holes(spark, tile_rows, tile_cols):
    rows = []
    for s in (None, "a", "b"):
        for p in DRAW.sample(range(90), 50):
            values = [DRAW.choice([None, DRAW.random()]) for _ in range(DRAW.choice([0, 1, 5, 17]))]
            rows.append((s, p, DRAW.choice([None, values, values, values])))
    df = spark.createDataFrame(rows, "s string, p int, a array<double>").repartition(6)
    assert turned(df, tile_rows, tile_cols) == brute(rows, tile_rows, tile_cols)
    assert turned(df.where("p < 0"), tile_rows, tile_cols) == {}


def test_transpose_matrix_twice_is_the_matrix(spark):
    n, m = 3000, 700
    df = spark.range(n).select(F.lit(0).alias("s"), F.col("id").alias("p"), F.transform(
        F.sequence(F.lit(0), F.lit(m - 1)), lambda c: F.col("id") * 1000 + c).alias("a"))
    once = transpose_matrix(df, "p", "a", "s", 4096, 64)
    assert once.count() == m
    back = transpose_matrix(once.select("s", F.col("column").alias("p"), F.col("values").alias("a")), "p", "a", "s", 4096, 256)
    assert back.count() == n
    assert back.select("s", F.col("column").alias("p"), F.col("values").alias("a")).exceptAll(df).count() == 0


def test_transpose_of_a_hundred_thousand_positions(spark):
    df = spark.range(100_000).select(F.lit(1).alias("__s0"), F.col("id").alias("pos"), (F.col("id") / 2).alias("x"), F.lit(7).alias("y"))
    got = transpose_fields(df, ["x", "y"], "pos", "__s0", size=1024)
    assert len(got.columns) == 5
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and len(plan) < 20_000
    seen = {(r["field"], r["start"]): r["values"] for r in got.collect()}
    assert sum(len(v) for v in seen.values()) == 200_000
    assert seen["x", 99_328] == [i / 2 for i in range(99_328, 100_000)] and set(seen["y", 0]) == {7.0}


def test_transpose_fields_agrees_with_the_wide_form(spark):
    rows = [(k, p, DRAW.random(), p) for k in "ab" for p in range(6) if (k, p) != ("a", 2)]
    df = spark.createDataFrame(rows, "k string, pos int, x double, y int")
    wide = {(r["k"], r["field"]): [r[f"p{i}"] for i in range(6)] for r in transpose(df, ["x", "y"], "pos", 6, "k").collect()}
    tall = {(r["k"], r["field"]): r["values"] for r in transpose_fields(df, ["x", "y"], "pos", "k", size=100).collect()}
    assert wide == tall


@pytest.mark.parametrize("positions", [[0, 1, 1], [0, -1], [0, None]])
def test_unsound_positions_fail(spark, positions):
    df = spark.createDataFrame([(0, p, [1.0]) for p in positions], "s int, p int, a array<double>")
    with pytest.raises(Exception, match="transpose"):
        turned(df)
