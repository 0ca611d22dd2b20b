"""Embedding whitening from an exact characteristic polynomial (operator 11).

1. Entries become integers.  Tasks add up the exact integer products of their
   rows (with a column of ones, so counts and sums come along); Spark sums them
   per index pair.  n times the products less the products of sums is the
   integer scatter matrix M, n^2 times the covariance, without rounding.
2. The characteristic polynomial of M modulo many primes, each by Hessenberg
   reduction in a task of its own; the Chinese remainder theorem gives its
   integer coefficients.
3. All roots are real, so Descartes' rule of signs counts the roots beyond a
   point exactly (with multiplicity).  Bisection isolates the largest roots and
   then refines each by the polynomial's exact sign.
4. A component spans the null space of M - root: inverse iteration in
   ``DIGITS``-digit decimals, one task per root.
5. Rows are projected where they are read.

The driver and the tasks of steps 2 to 4 see matrices of the vectors' length,
however many rows there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALE, COMPONENTS = 64, 32
#: Entries of this size or more (after scaling) have no integer here; their rows are left out like non-finite ones.
ENTRY_LIMIT = 2.0**62
#: Bits of a limb, rows multiplied at once (their products of limbs stay exact in a double), limbs of a sum.
LIMB, ROWS, SUM_LIMBS = 20, 4096, 5
#: Fraction bits of the grid that tells roots apart, and of a root.
GRID_BITS, ROOT_BITS = 64, 128
DIGITS = 100


# --- exact products --------------------------------------------------------

def limbs_of(y: np.ndarray) -> list[np.ndarray]:
    """``y`` (int64) as doubles of ``LIMB`` bits each, lowest first; the last is signed."""
    out = []
    while np.abs(y).max(initial=0) >= 1 << LIMB:
        out.append((y & ((1 << LIMB) - 1)).astype(np.float64))
        y = y >> LIMB
    return [*out, y.astype(np.float64)]


class Products:
    """Exact sum of the outer products of integer rows, in base 2^(2 * LIMB)."""

    def __init__(self, d: int):
        self.total = np.zeros((SUM_LIMBS, d, d), np.int64)

    def add(self, y: np.ndarray) -> None:
        for at in range(0, len(y), ROWS):
            limbs = limbs_of(y[at : at + ROWS])
            for i, a in enumerate(limbs):
                for j, b in enumerate(limbs):
                    product = (a.T @ b).astype(np.int64)
                    place, odd = divmod(i + j, 2)
                    if odd:  # between two places of the base
                        high = product >> LIMB
                        self.total[place + 1] += high
                        product = (product - (high << LIMB)) << LIMB
                    self.total[place] += product
            for k in range(SUM_LIMBS - 1):
                carry = self.total[k] >> (2 * LIMB)
                self.total[k] -= carry << (2 * LIMB)
                self.total[k + 1] += carry


def integers(column: pa.Array, d: int) -> np.ndarray:
    """Rows of ``d`` finite numbers as floor(SCALE * c)."""
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    return np.floor(SCALE * flat).astype(np.int64).reshape(-1, d)


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = np.diff(batch.column("v").offsets.to_numpy())
    for d in np.unique(sizes).tolist():
        yield d, batch.take(pa.array(np.flatnonzero(sizes == d)))


def exact_products(vectors: DataFrame) -> dict[int, list[list[int]]]:
    """For each length d of ``v``: the (d + 1) x (d + 1) products of rows (1, integers), exact.

    At most a row per index pair and length reaches the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, Products] = {}
        for batch in batches:
            for d, part in by_length(batch):
                y = integers(part.column("v"), d)
                sums.setdefault(d, Products(d + 1)).add(np.concatenate([np.ones((len(y), 1), np.int64), y], 1))
        for d, held in sums.items():
            i, j = np.triu_indices(d + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), d, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                 *(pa.array(limb[i, j]) for limb in held.total)],
                names=["d", "i", "j", *(f"g{k}" for k in range(SUM_LIMBS))])

    names = [f"g{k}" for k in range(SUM_LIMBS)]
    summed = (vectors.select("v").mapInArrow(run, "d int, i int, j int, " + ", ".join(f"{g} long" for g in names))
              .groupBy("d", "i", "j").agg(*[F.sum(g).alias(g) for g in names]))
    out: dict[int, list[list[int]]] = {}
    for d, i, j, *limbs in summed.collect():
        m = out.setdefault(d, [[0] * (d + 1) for _ in range(d + 1)])
        m[i][j] = m[j][i] = sum(int(x) << (2 * LIMB * k) for k, x in enumerate(limbs))
    return out


# --- characteristic polynomial ---------------------------------------------

def is_prime(n: int) -> bool:
    """Miller-Rabin; these bases decide for all n < 3 * 10^9."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    r = ((n - 1) & (1 - n)).bit_length() - 1
    for base in (2, 3, 5, 7):
        x = pow(base, (n - 1) >> r, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(r - 1)):
            return False
    return True


def primes_for(bits: int) -> list[int]:
    """Primes below 2^31, largest first, whose product has more than ``bits`` bits."""
    out, product, n = [], 1, (1 << 31) - 1
    while product.bit_length() <= bits:
        if is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to ``a`` modulo ``p`` with zeros below its subdiagonal."""
    a = a.copy()
    n = len(a)
    for k in range(n - 2):
        below = np.flatnonzero(a[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + below[0]
        if pivot != k + 1:
            a[[k + 1, pivot]] = a[[pivot, k + 1]]
            a[:, [k + 1, pivot]] = a[:, [pivot, k + 1]]
        u = a[k + 2 :, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2 :] = (a[k + 2 :] - u[:, None] * a[k + 1][None, :] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2 :] * u[None, :] % p).sum(1)) % p
    return a


def polynomial_mod(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - a) modulo ``p``, constant first."""
    h, n = hessenberg(a % p, p), len(a)
    polys = [np.array([1] + [0] * n, np.int64)]
    for k in range(n):
        new = np.roll(polys[k], 1)
        new = (new - int(h[k, k]) * polys[k] % p) % p
        chain = 1
        for i in range(k - 1, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            if not chain:
                break
            new = (new - chain * int(h[i, k]) % p * polys[i] % p) % p
        polys.append(new)
    return polys[n]


def characteristic_polynomial(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """Integer coefficients of det(x - m), constant first, of a symmetric matrix without negative eigenvalues."""
    d = len(m)
    mean = sum(m[i][i] for i in range(d)) // d + 1
    # The k-th elementary symmetric function of the eigenvalues is at most binomial(d, k) * mean^k.
    primes = primes_for(((1 + mean) ** d).bit_length() + 1)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for i in frame["id"]:
                p = primes[i]
                residues = np.array([[x % p for x in row] for row in m], np.int64)
                rows.append((p, polynomial_mod(residues, p).tolist()))
            yield pd.DataFrame(rows, columns=["p", "c"])

    found = spark.range(0, len(primes), 1, min(len(primes), 32)).mapInPandas(run, "p long, c array<long>").collect()
    product = 1
    for p in primes:
        product *= p
    out = [0] * (d + 1)
    for p, coefficients in found:
        rest = product // p
        weight = rest * pow(rest % p, -1, p)
        for k, c in enumerate(coefficients):
            out[k] += c * weight
    out = [c % product for c in out]
    return [c - product if 2 * c > product else c for c in out]


# --- roots -----------------------------------------------------------------

def roots_beyond(c: list[int], a: int, bits: int) -> int:
    """How many roots (with multiplicity) of a real-rooted polynomial exceed a / 2^bits: Descartes' rule, here exact."""
    d = len(c) - 1
    c = [x << (bits * (d - k)) for k, x in enumerate(c)]  # roots times 2^bits
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += a * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def sign_at(c: list[int], a: int, bits: int) -> int:
    value = 0
    for k, x in enumerate(reversed(c)):
        value = value * a + (x << (bits * k))
    return (value > 0) - (value < 0)


def largest_roots(c: list[int], wanted: int, top: int) -> list[tuple[Fraction, int]]:
    """The largest roots and their multiplicities (``wanted`` in all at least), falling; all lie in [0, ``top``].

    Roots closer than 2^-GRID_BITS count as one; a root is right to 2^-ROOT_BITS, or exact.
    """
    total = len(c) - 1
    out: list[tuple[Fraction, int]] = []
    # Intervals (low, high] of the grid with the numbers of roots beyond their ends, largest on top.
    todo = [(-1, top << GRID_BITS, total, 0)]
    have = 0
    while todo and have < wanted:
        low, high, beyond_low, beyond_high = todo.pop()
        n = beyond_low - beyond_high
        if not n:
            continue
        if n > 1 and high - low > 1:
            mid = (low + high) // 2
            beyond = roots_beyond(c, mid, GRID_BITS)
            todo += [(low, mid, beyond_low, beyond), (mid, high, beyond, beyond_high)]
            continue
        if n == 1:
            low, high = (x << (ROOT_BITS - GRID_BITS) for x in (low, high))
            right = -1 if beyond_high % 2 else 1  # sign just beyond the root
            while high - low > 1:
                mid = (low + high) // 2
                sign = sign_at(c, mid, ROOT_BITS)
                if sign in (0, right):
                    high = mid
                    if not sign:
                        break
                else:
                    low = mid
            out.append((Fraction(high, 1 << ROOT_BITS), 1))
        else:
            out.append((Fraction(max(high, 0), 1 << GRID_BITS), n))
        have += n
    return out


# --- components ------------------------------------------------------------

def null_space(m: list[list[int]], root: Fraction, count: int) -> list[list[float]]:
    """``count`` orthonormal vectors of the null space of ``m`` - ``root`` (its dimension is at least that)."""
    d = len(m)
    with localcontext() as context:
        context.prec = DIGITS
        shift = Decimal(root.numerator) / Decimal(root.denominator)
        size = max([Decimal(1), *(abs(Decimal(m[i][i])) for i in range(d))])
        tiny = size.scaleb(-(2 * DIGITS) // 3)
        a = np.array([[Decimal(x) for x in row] for row in m], object).reshape(d, d)
        for i in range(d):
            a[i, i] -= shift
        order = np.arange(d)
        for k in range(d):  # LU with row exchanges, in place
            pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
            if pivot != k:
                a[[k, pivot]] = a[[pivot, k]]
                order[[k, pivot]] = order[[pivot, k]]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            if k + 1 < d:
                a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
                a[k + 1 :, k + 1 :] -= a[k + 1 :, k][:, None] * a[k, k + 1 :][None, :]

        def solve(b: np.ndarray) -> np.ndarray:
            x = b[order].copy()
            for k in range(d):
                x[k] -= a[k, :k] @ x[:k] if k else 0
            for k in range(d - 1, -1, -1):
                x[k] = (x[k] - (a[k, k + 1 :] @ x[k + 1 :] if k + 1 < d else 0)) / a[k, k]
            return x

        def orthonormal(vectors: list[np.ndarray]) -> list[np.ndarray]:
            out: list[np.ndarray] = []
            for v in vectors:
                for _ in range(2):
                    for u in out:
                        v = v - (u @ v) * u
                    v = v / (v @ v).sqrt()
                out.append(v)
            return out

        rng = np.random.default_rng(0)
        vectors = [np.array([Decimal(int(x)) for x in rng.integers(1, 1000, d)], object) for _ in range(count)]
        for _ in range(3):
            vectors = orthonormal([solve(v) for v in vectors])
        out = []
        for v in vectors:
            v = np.array([float(x) for x in v])
            out.append((v * (1 if v[np.abs(v).argmax()] > 0 else -1)).tolist())
        return out


class Whitening:
    """What rows of one length need: n, sums, components (columns), roots of the scatter matrix, shares, error."""

    def __init__(self, spark: SparkSession, products: list[list[int]], components: int):
        d = len(products) - 1
        self.n, self.sums = products[0][0], products[0][1:]
        n, s = self.n, self.sums
        m = [[n * products[i + 1][j + 1] - s[i] * s[j] for j in range(d)] for i in range(d)]
        trace = sum(m[i][i] for i in range(d))
        wanted = min(components, d)
        roots = largest_roots(characteristic_polynomial(spark, m), wanted, trace + 1)
        left, tasks = wanted, []
        for root, count in roots:
            tasks.append((root, min(count, left)))
            left -= tasks[-1][1]

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                yield pd.DataFrame([(i, null_space(m, *tasks[i])) for i in frame["id"]], columns=["i", "v"])

        found = dict(map(tuple, spark.range(0, len(tasks), 1, len(tasks)).mapInPandas(
            run, "i long, v array<array<double>>").collect()))
        self.roots = np.array([float(root) for i, (root, _) in enumerate(tasks) for _ in found[i]])
        self.components = np.array([v for i in range(len(tasks)) for v in found[i]]).reshape(-1, d).T
        self.explained = np.array([float(root / trace) if trace else 0.0 for i, (root, _) in enumerate(tasks)
                                   for _ in found[i]])
        # Covariance of the projections, from the exact scatter matrix and the components as they are used.
        use = self.roots > 0
        scale = max(1, max((abs(x) for row in m for x in row), default=1).bit_length() - 60)
        exact = np.array([[float(Fraction(x, 1 << scale)) for x in row] for row in m]).reshape(d, d)
        c = self.components[:, use]
        root = np.sqrt(np.array([float(Fraction(x) / (1 << scale)) for x in self.roots[use]]))
        covariance = (c.T @ exact @ c) / root[:, None] / root[None, :]
        self.error = float(np.abs(covariance - np.eye(use.sum())).max(initial=0.0))

    def rows(self, y: np.ndarray) -> tuple[list[int | None], np.ndarray]:
        """Squared deviations (times n^2, exact; none beyond a long) and whitened values (NaN for an empty component)."""
        most = int(np.abs(y).max(initial=0))
        span = self.n * most + max(map(abs, self.sums), default=0)
        if span < 1 << 62:
            deviation = self.n * y - np.array(self.sums, np.int64)
        else:
            deviation = y.astype(object) * self.n - np.array(self.sums, object)
        if span * span * max(1, y.shape[1]) < 1 << 62:
            squares = (deviation * deviation).sum(1).tolist()
        else:
            squares = [int(x) for x in (deviation.astype(object) ** 2).sum(1)]
        with np.errstate(divide="ignore", invalid="ignore"):
            white = (deviation.astype(np.float64) @ self.components) / np.sqrt(self.roots)
        white[:, self.roots <= 0] = np.nan
        return [x if x < 1 << 63 else None for x in squares], white


def usable(v: Column) -> Column:
    """True for vectors without null, non-finite or oversized entries (null: not true)."""
    return v.isNotNull() & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < ENTRY_LIMIT / SCALE))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """``id_col``, component, n, deviation, whitened, explained and identity_error per row and component.

    Rows whose vector is null, or holds null or non-finite entries (or entries
    of 2^56 or more), are left out.  Vectors of different lengths are fitted
    apart, each length over its own rows; empty vectors have no component.
    Components are numbered from 1 by falling eigenvalue; their entry of largest
    size is positive.  An eigenvalue 0 gives a null ``whitened``; eigenvalues
    that are equal get any orthonormal vectors of their space.  ``deviation`` is
    null where it exceeds a long.  ``explained`` is 0 where there is no
    variance.  Repeated rows count as often as they come; null ids are kept;
    other columns are not read.
    """
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    rows = rows.where(F.coalesce(usable(F.col("v")), F.lit(False)) & (F.size("v") > 0))
    spark = vectors.sparkSession
    fitted = {d: Whitening(spark, products, components) for d, products in sorted(exact_products(rows).items())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, part in by_length(batch):
                fit = fitted[d]
                squares, white = fit.rows(integers(part.column("v"), d))
                n, k = white.shape
                each = pa.array(np.repeat(np.arange(n), k))
                flat = white.ravel()
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                     pa.array(np.full(n * k, fit.n)), pa.array(squares, pa.int64()).take(each),
                     pa.array(flat, mask=np.isnan(flat)), pa.array(np.tile(fit.explained, n)),
                     pa.array(np.full(n * k, fit.error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    out = T.StructType([rows.schema["id"], *T.StructType.fromDDL(
        "component int, n long, deviation long, whitened double, explained double, identity_error double")])
    return rows.mapInArrow(run, out).withColumnRenamed("id", id_col)
