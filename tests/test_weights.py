import math

import pytest

from tidemark.functions.weights import (
    band_bounds,
    band_weight_of,
    denominator,
    ewma_k,
    parse_weights,
)


@pytest.mark.parametrize("n,bounds,d", [
    (20, (5, 10, 15, 20), 5.0),
    (10, (2, 4, 6, 10), 2.0),
    (8, (2, 4, 6, 8), 2.0),
    (3, (0, 0, 0, 3), 0.0),
])
def test_bands_and_denominator(n, bounds, d):
    assert band_bounds(n) == bounds
    assert denominator(n) == pytest.approx(d, abs=1e-12)


@pytest.mark.parametrize("n", range(1, 14))
def test_band_lookup_matches_brute_force(n):
    d, r = divmod(n, 4)
    sizes = [d, d, d, d + r]
    expected = []
    for band, size in enumerate(sizes):
        expected += [(0.1, 0.2, 0.3, 0.4)[band]] * size
    assert [band_weight_of(rank, n) for rank in range(n)] == expected


def test_applied_weight_vs_denominator_bias():
    # N = 10: applied weights sum to 2.8 while D = 2.0 (bias 1.4 on constant input)
    assert sum(band_weight_of(r, 10) for r in range(10)) == pytest.approx(2.8)
    assert denominator(10) == pytest.approx(2.0)


def test_parse_weights():
    assert parse_weights("0.1, 0.2,0.3 ,0.4") == (0.1, 0.2, 0.3, 0.4)
    with pytest.raises(ValueError):
        parse_weights("0.3")
    with pytest.raises(ValueError):
        parse_weights("a,b,c,d")


def test_ewma_k():
    assert ewma_k(1.0) == 1.0
    assert ewma_k(0.3) == pytest.approx(math.sqrt(0.3 / 1.7))
    with pytest.raises(ValueError):
        ewma_k(0.0)
