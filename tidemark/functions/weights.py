"""Band weights for the banded weighted moving average.

The newest N rows are split into four rank bands (rank 0 = newest).  Each band
has one weight; the result is ``sum(weight(rank) * x) / D``.  The band sizes
and the denominator follow the threshold job exactly, including two
behaviours that look like slips but define its numbers:

* the division remainder ``N mod 4`` goes to the last (oldest) band, while the
  denominator counts every band as ``N div 4`` rows: ``D = sum(w_i * (N div 4))``;
* the newest rows get the *first* (by default smallest) weight.

All of this is driver-side constants; the per-row work is one ``CASE`` chain.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: default band weights (newest band first)
DEFAULT_WEIGHTS = (0.1, 0.2, 0.3, 0.4)
# --- end of fixed values

N_BANDS = 4


def parse_weights(spec: str | Sequence[float] = DEFAULT_WEIGHTS) -> tuple[float, ...]:
    """Weights from ``"0.1,0.2,0.3,0.4"`` or a sequence; exactly four are required."""
    if isinstance(spec, str):
        parts = [p.strip() for p in spec.split(",")]
        try:
            weights = tuple(float(p) for p in parts)
        except ValueError as exc:
            raise ValueError(f"weights must be numbers, got {spec!r}") from exc
    else:
        weights = tuple(float(w) for w in spec)
    if len(weights) != N_BANDS:
        raise ValueError(f"need {N_BANDS} band weights, got {len(weights)}: {spec!r}")
    return weights


def band_bounds(n: int) -> tuple[int, int, int, int]:
    """Exclusive upper rank of each band: ``d, 2d, 3d, 4d + r``."""
    if n < 0:
        raise ValueError("n must be >= 0")
    d, r = divmod(n, N_BANDS)
    return (d, 2 * d, 3 * d, 4 * d + r)


def denominator(n: int, weights: Sequence[float] = DEFAULT_WEIGHTS) -> float:
    """``D``: every weight times the first band's size, summed in weight order."""
    d = band_bounds(n)[0]
    total = 0.0
    for w in parse_weights(weights):
        total = total + w * d
    return total


def band_weight_of(rank: int, n: int, weights: Sequence[float] = DEFAULT_WEIGHTS) -> float:
    """Python form of the lookup (used by tests as the brute-force check)."""
    w = parse_weights(weights)
    b = band_bounds(n)
    for i in range(N_BANDS - 1):
        if rank < b[i]:
            return w[i]
    return w[N_BANDS - 1]


def band_weight(rank: Column | str, n: int, weights: Sequence[float] = DEFAULT_WEIGHTS) -> Column:
    """Column form of :func:`band_weight_of`: a ``CASE WHEN`` chain on the rank."""
    r = F.col(rank) if isinstance(rank, str) else rank
    w = parse_weights(weights)
    b = band_bounds(n)
    expr = F.when(r < F.lit(b[0]), F.lit(w[0]))
    for i in (1, 2):
        expr = expr.when(r < F.lit(b[i]), F.lit(w[i]))
    return expr.otherwise(F.lit(w[3]))


def band_weight_sql(rank: str, n: int, weights: Sequence[float] = DEFAULT_WEIGHTS) -> str:
    """SQL text of the same ``CASE`` chain (for oracle queries), weights as doubles."""
    w = [f"CAST({x!r} AS DOUBLE)" for x in parse_weights(weights)]
    b = band_bounds(n)
    return (
        f"CASE WHEN {rank} < {b[0]} THEN {w[0]} WHEN {rank} < {b[1]} THEN {w[1]} "
        f"WHEN {rank} < {b[2]} THEN {w[2]} ELSE {w[3]} END"
    )


def ewma_k(lam: float) -> float:
    """Control-limit factor ``sqrt(lambda / (2 - lambda))``."""
    if not 0.0 < lam <= 1.0:
        raise ValueError("lambda must be in (0, 1]")
    return math.sqrt(lam / (2.0 - lam))
