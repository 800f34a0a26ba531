"""Hard negatives and whitening against brute force, products and polynomials against plain loops."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldbook.llm import hardnegatives as hn
from fieldbook.llm import whitening as wh

KIND = "vec_id bigint, embedding array<float>, label int"


# -- hard negatives -------------------------------------------------------------

@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 64, 300), (130, 65, 129), (256, 96, 200), (0, 3, 2), (3, 200, 1)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(sum(shape))
    for high in (1 << 8, 1 << 29, 1 << 62):
        a, b = rng.integers(-high, high, shape[:2]), rng.integers(-high, high, shape[1:])
        assert (hn.strassen(a, b) == a @ b).all()  # modulo 2**64 both


def test_recursion_goes_on_to_the_leaf():
    assert [hn.halvings(n, n, n) for n in (1, 63, 64, 126, 127, 128, 1000)] == [0, 0, 1, 1, 2, 2, 4]  # 127 pads to 4 * 32


def test_heaps_merge():
    rng = np.random.default_rng(1)
    scores, ids = rng.integers(0, 6, (4, 50)), rng.permutation(50)
    allowed = rng.random((4, 50)) < 0.7
    heaps = hn.Heaps(5)
    for j in range(0, 50, 8):
        heaps.offer(np.arange(4), scores[:, j:j + 8], ids[j:j + 8], allowed[:, j:j + 8])
    want = [sorted((-scores[i, j], ids[j]) for j in range(50) if allowed[i, j])[:5] for i in range(4)]
    got = [[(-s, k) for o, s, k in zip(heaps.owner, heaps.score, heaps.id) if o == i] for i in range(4)]
    assert got == want


def brute_negatives(rows, scale=256):
    fine = [(i, [math.floor(scale * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    fine = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in fine]
    out = []
    for a, (i, v, label) in enumerate(fine):
        if i % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j, other) for b, (j, w, other) in enumerate(fine) if b != a and len(w) == len(v)]
        for p, j, _ in sorted(s for s in scored if s[2] == label)[:5]:
            near = sorted((n, k) for n, k, other in scored if other != label and -80 * p <= -100 * n <= -100 * p)[:5]
            out += [(i, j, r + 1, k, -p, -n) for r, (n, k) in enumerate(near)]
    return sorted(out)


def mined(df, **kw):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(tuple(r) for r in hn.mine(df, F.col("id") % 100 == 0, label, **kw).collect())


def some_vectors(seed, n, dim=6):
    rng = np.random.default_rng(seed)
    rows = [(int(k) * 20, [float(x) for x in np.round(rng.normal(size=dim) + 1, 1)], int(rng.integers(0, 4))) for k in rng.permutation(n)]
    return rows + rows[:8] + [(100, rows[0][1], 0), (100, rows[0][1], 0), (4, None, 1), (5, [1.0] * dim, None), (None, [1.0] * dim, 1),
                              (200, [1.0, float("nan")] + [0.0] * (dim - 2), 1), (300, [None] + [1.0] * (dim - 1), 1),
                              (400, [float("inf")] * dim, 2), (500, [1.0, 2.0], 1), (40, [1.0, 2.0], 1), (60, [1.0, 1.5], 2), (600, [], 1)]


def test_negatives_against_brute_force(spark):
    rows = some_vectors(3, 90)
    df = spark.createDataFrame(rows, KIND).selectExpr("*", "1 AS row", "2 AS id", "3 AS dim", "4 AS score", "5 AS rank", "6 AS v", "7 AS ga")
    want = brute_negatives(rows)
    assert len(want) > 100
    assert mined(df) == want
    assert mined(df, anchors_per_cell=3, candidates_per_cell=7) == want  # many cells: heaps are merged


def test_negatives_with_equal_vectors_and_nothing(spark):
    rows = [(k * 10, [0.5, 0.25, 1.0], k % 3) for k in range(80)]  # all scores alike: ties go by id
    assert mined(spark.createDataFrame(rows, KIND), candidates_per_cell=9) == brute_negatives(rows)
    rows = [(k * 10, [-0.5 if k % 20 else 0.5, 0.25], 1 + k % 2) for k in range(60)]  # negative positive scores open no window
    assert mined(spark.createDataFrame(rows, KIND)) == brute_negatives(rows)
    df = spark.createDataFrame(rows, KIND)
    assert mined(df.limit(0)) == []
    assert mined(df.where("vec_id = 100")) == []


# -- whitening ------------------------------------------------------------------

def plain_polynomial(m):
    """Faddeev and LeVerrier's recurrence in whole numbers; coefficients from t**0 up."""
    d = len(m)
    coefficients, n = [1], np.zeros((d, d), object)
    for k in range(1, d + 1):
        n = m.dot(n) + coefficients[-1] * np.eye(d, dtype=int).astype(object)
        coefficients.append(-int(np.trace(m.dot(n))) // k)
    return coefficients[::-1]


def scatter_like(seed, d, rank, high=50):
    x = np.random.default_rng(seed).integers(-high, high, (rank, d)).astype(object)
    return x.T.dot(x)


@pytest.mark.parametrize("d,rank,high", [(1, 1, 9), (2, 2, 9), (5, 5, 1 << 40), (9, 4, 100), (12, 20, 1000), (3, 0, 2)])
def test_polynomial_is_exact(spark, d, rank, high):
    m = scatter_like(d, d, rank, high) if rank else np.zeros((d, d), int).astype(object)
    assert wh.characteristic_polynomial(spark, m) == plain_polynomial(m)


def test_hessenberg_modulo_a_prime():
    m = scatter_like(4, 8, 8).astype(np.int64) % 101
    h = wh.hessenberg(m, 101)
    assert not np.tril(h, -2).any()
    assert (wh.polynomial_modulo(h, 101) == wh.polynomial_modulo(m, 101)).all()
    assert wh.polynomial_modulo(m, 101).tolist() == [c % 101 for c in plain_polynomial(m.astype(object))]
    split = np.array([[1, 0, 0, 5], [0, 2, 0, 0], [0, 7, 3, 0], [4, 0, 0, 4]])  # zeros on the subdiagonal
    assert wh.polynomial_modulo(split, 101).tolist() == [c % 101 for c in plain_polynomial(split.astype(object))]


def polynomial_of(roots):
    out = [1]
    for r in roots:
        out = [a - r * b for a, b in zip([0, *out], [*out, 0])]
    return out


def test_roots_with_multiplicities():
    roots = [10**30, 77, 77, 77, 5, 4, 0, 0]
    found = wh.largest_roots(polynomial_of(roots), 8)
    assert [Fraction(n, 1 << b) for n, b in found] == roots
    assert [Fraction(n, 1 << b) for n, b in wh.largest_roots(polynomial_of(roots), 3)] == roots[:3]
    assert wh.largest_roots(polynomial_of([0, 0]), 2) == [(0, 0)] * 2
    assert [wh.roots_above(polynomial_of(roots), t) for t in (-1, 0, 4, 76, 77, 10**31)] == [8, 6, 5, 4, 1, 0]
    (n, b), (m, c) = wh.largest_roots([1, -6, 1], 2)  # 3 plus and minus the root of 8
    assert abs(float(Fraction(n, 1 << b)) - (3 + 8**0.5)) < 1e-15 and abs(float(Fraction(m, 1 << c)) - (3 - 8**0.5)) < 1e-15


def brute_whitening(vectors, components=8):
    """Doubles of a general eigenvalue routine, on exact deviations."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(0)
    centred = (x * n - s)
    v = centred.T.dot(centred)
    covariance = np.array([[float(Fraction(int(c), n**3)) for c in row] for row in v])
    e, u = np.linalg.eigh(covariance)
    order = np.argsort(-e)[:components]
    z = (centred / n).astype(float) @ u[:, order] / np.sqrt(e[order])
    return [int((row * row).sum()) for row in centred], z, e[order] / np.trace(covariance)


def test_whitening_against_a_general_routine(spark):
    rng = np.random.default_rng(8)
    vectors = (rng.normal(size=(150, 12)) @ rng.normal(size=(12, 12))).astype(np.float32)
    bad = [(900, None, 1), (901, [None] * 12, 1), (902, [float("nan")] * 12, 1), (903, [float("-inf")] * 12, 1), (904, [], 1), (905, [3e38] * 12, 1)]
    rows = [(k, [float(x) for x in v], 1) for k, v in enumerate(vectors)] + bad
    df = spark.createDataFrame(rows, KIND).repartition(5).selectExpr("*", "1 AS n", "2 AS v", "3 AS component", "4 AS id")
    out = wh.whiten(df).collect()
    deviation, z, share = brute_whitening(vectors)
    assert len(out) == 150 * 8
    got = np.zeros_like(z)
    for r in out:
        got[r.vec_id, r.component - 1] = r.whitened
        assert int(r.deviation) == deviation[r.vec_id] and r.n == 150
        assert abs(r.explained / share[r.component - 1] - 1) < 1e-9
        assert r.identity_error < 1e-9
    signs = np.sign((got * z).sum(0))
    assert np.abs(got - z * signs).max() < 1e-6
    covariance = np.cov(got.T, bias=True)
    assert np.abs(covariance - np.eye(8)).max() < 1e-9


def test_close_and_equal_variances(spark):
    """Variances that differ in the seventh digit, and equal ones, still give unit variance without correlation."""
    base = []
    for k in range(4):
        for sign in (1, -1):
            v = [0.0] * 4
            v[k] = sign * (1000.0 + (1 / 1024 if k == 1 else 0))
            base.append((len(base), v, 1))
    out = wh.whiten(spark.createDataFrame(base, KIND)).collect()
    z = np.zeros((8, 4))
    for r in out:
        z[r.vec_id, r.component - 1] = r.whitened
        assert r.identity_error < 1e-12
    assert np.abs(z.T @ z / 8 - np.eye(4)).max() < 1e-12
    assert np.flatnonzero(np.abs(z[:, 0]) > 1e-9).tolist() == [2, 3]  # the one longer pair is the first component


def test_few_and_equal_vectors(spark):
    one = wh.whiten(spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1)], KIND)).collect()
    assert len(one) == 3 and all(r.whitened is None and r.explained is None and r.deviation == 0 and r.identity_error == 0 for r in one)
    rows = [(1, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (None, [3.0, 4.0], 1), (4, [5.0], 1), (5, [7.0], 1), (6, [5.0], 1)]
    out = wh.whiten(spark.createDataFrame(rows, KIND)).collect()
    assert sorted((r.n, r.component) for r in out) == [(3, 1)] * 6 + [(3, 2)] * 3
    assert all((r.whitened is None) == (r.component == 2) for r in out)  # two points of a plane span a line
    assert all(r.identity_error < 1e-9 for r in out)
    assert wh.whiten(spark.createDataFrame(rows, KIND).limit(0)).count() == 0


def test_wide_numbers(spark):
    """Components far beyond what 64-bit sums hold."""
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(40, 3)) * [1e9, 1e5, 1.0]).astype(np.float32)
    out = wh.whiten(spark.createDataFrame([(k, [float(x) for x in v], 1) for k, v in enumerate(vectors)], KIND)).collect()
    deviation, _, share = brute_whitening(vectors)
    assert {r.vec_id: int(r.deviation) for r in out} == dict(enumerate(deviation))
    assert all(r.identity_error < 1e-9 for r in out)
    assert abs(next(r.explained for r in out if r.component == 1) - share[0]) < 1e-9
