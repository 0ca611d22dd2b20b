"""Operator 11: exact sums and polynomials, roots and components against numpy and rational arithmetic."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_CHECK
from tidemark.llm import whitening as W
from tidemark.llm.common import read_table
from tidemark.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def check(frame, ids, x, components=32):
    """``frame`` (pandas) against exact deviations and numpy's eigenvectors of the integers ``x``."""
    n, d = x.shape
    k = min(components, d)
    assert len(frame) == n * k and (frame["n"] == n).all()
    sums = [sum(int(v) for v in x[:, j]) for j in range(d)]
    want = {i: sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for i, row in zip(ids, x, strict=True)}
    assert dict(zip(frame["vec_id"], frame["deviation"], strict=True)) == want
    centred = (x - x[0]).astype(float)
    values, axes = np.linalg.eigh(np.cov(centred.T, bias=True).reshape(d, d))
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    white = frame.pivot(index="vec_id", columns="component", values="whitened").loc[list(ids)].to_numpy()
    other = (centred - centred.mean(0)) @ axes / np.sqrt(values)
    signs = np.sign((white * other).sum(0))
    assert np.abs(white - other * signs).max() < 1e-7
    assert np.abs(np.cov(white.T, bias=True).reshape(k, k) - np.eye(k)).max() < 1e-9
    shares = frame.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(shares, values / values.sum() * (shares.sum() if k < d else 1), rtol=1e-9)
    assert frame["identity_error"].nunique() == 1 and frame["identity_error"].iloc[0] < 1e-9


def test_query_against_numpy(spark):
    rows = read_table(spark, SF_CHECK, "embeddings").toPandas()
    v = np.array([np.asarray(x, np.float64) for x in rows["embedding"]])
    frame = QUERIES["op11_whitening"](spark, SF_CHECK).toPandas()
    x = np.floor(64 * v).astype(np.int64) + 1_000_000
    check(frame, rows["vec_id"], x)
    trace = np.trace(np.cov(x.T - 1_000_000.0, bias=True))
    top = np.linalg.eigvalsh(np.cov(x.T - 1_000_000.0, bias=True))[::-1][0]
    assert np.isclose(frame["explained"].max(), top / trace, rtol=1e-10)
    again = QUERIES["op11_whitening"](spark, SF_CHECK).toPandas()
    assert frame.sort_values(["vec_id", "component"]).reset_index(drop=True).equals(
        again.sort_values(["vec_id", "component"]).reset_index(drop=True))


def test_rows_left_out_and_odd_columns(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(200, 5)) * [1, 2, 3, 4, 5]
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    odd = [(900, None), (901, [1.0, None, 1, 1, 1]), (902, [float("nan")] * 5), (903, [float("inf"), 0, 0, 0, 0]),
           (904, [1e300, 0, 0, 0, 0]), (905, [])]
    df = vectors(spark, rows + [(i, None if x is None else [None if c is None else float(c) for c in x]) for i, x in odd])
    df = df.withColumn("n", F.lit("clash")).withColumn("component", F.lit("clash")).withColumn("v", F.lit(1))
    check(W.whiten(df.repartition(3)).toPandas(), range(200), np.floor(64 * v).astype(np.int64))
    assert W.whiten(df.where("vec_id >= 900")).count() == 0
    assert W.whiten(vectors(spark, [])).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained",
                                                    "identity_error"]


def test_lengths_are_fitted_apart_and_repeats_count(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(60, 3)), rng.normal(size=(80, 4))
    rows = [(i, x.tolist()) for i, x in enumerate([*a, *b])]
    frame = W.whiten(vectors(spark, rows)).toPandas()
    check(frame[frame["vec_id"] < 60], range(60), np.floor(64 * a).astype(np.int64))
    check(frame[frame["vec_id"] >= 60], range(60, 140), np.floor(64 * b).astype(np.int64))
    twice = W.whiten(vectors(spark, rows[:60] * 2 + [(None, [0.0, 0.0, 0.0])])).toPandas()
    assert (twice["n"] == 121).all() and len(twice) == 121 * 3 and twice["vec_id"].isna().sum() == 3


def test_without_variance(spark):
    rows = [(i, [float(i % 7), 2.0, float(i % 7), 0.5]) for i in range(50)]
    frame = W.whiten(vectors(spark, rows)).toPandas()
    white = frame.pivot(index="vec_id", columns="component", values="whitened")
    assert white[[2, 3, 4]].isna().all().all() and np.isclose(white[1].var(ddof=0), 1)
    assert np.allclose(frame.groupby("component")["explained"].first(), [1, 0, 0, 0])
    assert frame["identity_error"].max() < 1e-12
    single = W.whiten(vectors(spark, [(1, [3.0, 4.0])])).toPandas()
    assert len(single) == 2 and (single["deviation"] == 0).all() and single["whitened"].isna().all()


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(2)
    v = np.floor(rng.normal(size=(40, 3)) * 2.0**40)
    frame = W.whiten(vectors(spark, [(i, x.tolist()) for i, x in enumerate(v)])).toPandas()
    assert frame["deviation"].isna().all()  # beyond a long
    products = W.exact_products(vectors(spark, [(i, x.tolist()) for i, x in enumerate(v)]).select(
        F.col("embedding").alias("v")).repartition(3))[3]
    x = [[1, *(int(c) * 64 for c in row)] for row in v]
    assert products == [[sum(r[i] * r[j] for r in x) for j in range(4)] for i in range(4)]


def test_products_in_any_order_of_size():
    rng = np.random.default_rng(3)
    for bits in (3, 19, 21, 40, 61):
        y = rng.integers(-(1 << bits), 1 << bits, (5000, 3))
        held = W.Products(3)
        held.add(y)
        got = sum(held.total[k].astype(object) << (2 * W.LIMB * k) for k in range(W.SUM_LIMBS))
        assert (got == y.astype(object).T @ y.astype(object)).all()


def rational_polynomial(m):
    """Faddeev-LeVerrier, in exact fractions; constant first."""
    d = len(m)
    c, k = [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for n in range(1, d + 1):
        k = [[sum(m[i][x] * k[x][j] for x in range(d)) + (c[-1] * m[i][j]) for j in range(d)] for i in range(d)]
        c.append(-sum(k[i][i] for i in range(d)) / n)
    return [int(x) for x in reversed(c)]


@pytest.mark.parametrize("case", ["full", "low rank", "blocks", "zero"])
def test_polynomial_roots_and_null_spaces(spark, case):
    rng = np.random.default_rng(5)
    y = {"full": rng.integers(-50, 50, (30, 6)), "low rank": rng.integers(-50, 50, (3, 6)),
         "blocks": np.kron(np.eye(3, dtype=int), [[2, 1], [1, 3]]), "zero": np.zeros((2, 6), int)}[case]
    m = [[int(x) for x in row] for row in y.T @ y]
    c = W.characteristic_polynomial(spark, m)
    assert c == rational_polynomial(m)
    trace = sum(m[i][i] for i in range(6))
    roots = W.largest_roots(c, 6, trace + 1)
    assert sum(k for _, k in roots) == 6
    values = np.linalg.eigvalsh(np.array(m, float))[::-1]
    flat = np.array([float(r) for r, k in roots for _ in range(k)])
    assert np.allclose(flat, values, atol=1e-6)
    vectors_ = np.array([v for r, k in roots for v in W.null_space(m, r, k)])
    assert np.abs(vectors_ @ vectors_.T - np.eye(6)).max() < 1e-12
    assert np.abs(np.array(m, float) @ vectors_.T - vectors_.T * flat).max() <= 1e-8 * max(1, trace)


def test_close_roots_are_told_apart(spark):
    m = [[10**12, 0, 0], [0, 10**12 + 1, 0], [0, 0, 5]]
    roots = W.largest_roots(W.characteristic_polynomial(spark, m), 3, sum(m[i][i] for i in range(3)) + 1)
    assert [(float(r), k) for r, k in roots] == [(10**12 + 1, 1), (10**12, 1), (5, 1)]
    assert np.allclose(np.abs(W.null_space(m, roots[0][0], 1)), [[0, 1, 0]], atol=1e-15)


def test_descartes_counts_and_primes():
    c = [-6, 11, -6, 1]  # (x - 1)(x - 2)(x - 3)
    assert [W.roots_beyond(c, a, 1) for a in (0, 1, 2, 3, 4, 5, 6)] == [3, 3, 2, 2, 1, 1, 0]
    small = [n for n in range(2, 200) if all(n % p for p in range(2, n))]
    assert [n for n in range(200) if W.is_prime(n)] == small
    assert W.primes_for(100)[0] == 2**31 - 1
    p = 10_007
    a = np.random.default_rng(6).integers(0, p, (5, 5))
    a[2:, 0] = 0
    h = W.hessenberg(a, p)
    assert all(h[i, j] == 0 for i in range(5) for j in range(i - 1))
    assert W.polynomial_mod(a, p)[4] == -np.trace(a) % p
