"""Embedding whitening from the exact characteristic polynomial of an integer scatter.

* *Scatter.* Components become integers. Each partition adds up its vectors and their products exactly;
  sums are added up in two steps, a fixed number of tasks before the driver. With n vectors of sum S and
  products Q, the integer matrix ``M = n * Q - S * S'`` is n**2 times the covariance.
* *Characteristic polynomial.* Modulo a prime under 2**31, M is brought to Hessenberg form and its polynomial
  read off by the recurrence of the leading minors. Spark tasks share the primes. Chinese remaindering puts
  the residues together; their number follows from a bound on the coefficients, which for a matrix without
  negative eigenvalues is Maclaurin's on the elementary symmetric functions, so the polynomial is exact.
* *Roots.* All roots are real, so the sign changes of the polynomial's coefficients shifted by t count the
  roots above t exactly, multiplicities included. Bisection isolates the largest ones in integers and, with
  the polynomial scaled by powers of two, refines each to ``BITS`` bits. Roots that no bit tells apart are
  one root of that multiplicity; zero roots are read off the last coefficients.
* *Components.* For each root the near-singular matrix ``M - root`` is factored in fixed point of so many
  bits; inverse iteration from a fixed start gives its null vector, for a multiple root as many, made
  orthogonal. They are rounded to doubles in the end, with the sign that makes the largest entry positive.

Null vectors, vectors that hold null or non-finite components, or components that 62-bit integers cannot
hold, take no part, nor do empty vectors. Vectors of different lengths are fitted apart, each with its own
n. Repeated rows count each. Null ids are rows like others. Components of variance 0 have null ``whitened``
(and null ``explained`` where all have). An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, map_partitions
from .topk import usable

#: Tasks that add up partial sums before the driver; bits of a root; bits after the point in the factorisation.
MERGERS, BITS, POINT = 64, 128, 256


# -- exact sums ---------------------------------------------------------------

def integers(scale: float, embedding: str) -> Column:
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale))


def taking_part(vectors: DataFrame, scale: float, id_column: str, embedding: str) -> DataFrame:
    """(id, v): the integer vectors that take part."""
    fits = lambda x: F.abs(x.cast("double") * scale) < 2.0**62
    fine = F.coalesce(usable(embedding) & F.forall(embedding, fits), F.lit(False)) & (F.size(embedding) > 0)
    return vectors.where(fine).select(F.col(id_column).alias("id"), integers(scale, embedding).alias("v"))


def by_length(batch: pa.RecordBatch, column: str = "v") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of the rows of each length."""
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy())
    for dim in np.unique(sizes):
        at = np.flatnonzero(sizes == dim)
        some = lists.take(pa.array(at))
        yield at, some.flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)


def products(y: np.ndarray) -> np.ndarray:
    """Y'Y in Python integers, by doubles or 64-bit integers where these hold every sum."""
    largest = max(int(y.max(initial=0)), -int(y.min(initial=0)))
    if largest * largest * len(y) < 1 << 53:
        return (y.T.astype("f8") @ y.astype("f8")).astype("i8").astype(object)
    if largest * largest * len(y) < 1 << 63:
        return (y.T @ y).astype(object)
    return y.T.astype(object).dot(y.astype(object))


def to_text(numbers: np.ndarray) -> str:
    return ",".join(map(str, numbers.ravel()))


def from_text(text: str) -> np.ndarray:
    return np.array([int(x) for x in text.split(",")], object)


SUMS = "dim int, n bigint, sums string, products string"


def _sums_batch(totals: dict) -> Iterator[pa.RecordBatch]:
    for dim, (n, s, q) in totals.items():
        yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([n], pa.int64()), pa.array([to_text(s)]),
                                          pa.array([to_text(q)])], ["dim", "n", "sums", "products"])


def _more(totals: dict, dim: int, n: int, s: np.ndarray, q: np.ndarray) -> None:
    if dim in totals:
        m, t, r = totals[dim]
        n, s, q = n + m, s + t, q + r
    totals[dim] = n, s, q


def scatter(rows: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """{length: (n, S, M)} of rows of (v), in Python integers."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict = {}
        for batch in batches:
            for _, y in by_length(batch):
                for k in range(0, len(y), 4096):
                    part = y[k:k + 4096]
                    _more(totals, y.shape[1], len(part), part.astype(object).sum(0), products(part).ravel())
        yield from _sums_batch(totals)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict = {}
        for batch in batches:
            for r in batch.to_pylist():
                _more(totals, r["dim"], r["n"], from_text(r["sums"]), from_text(r["products"]))
        yield from _sums_batch(totals)

    found = map_partitions(map_partitions(rows.select("v"), add, SUMS).repartition(MERGERS), merge, SUMS).collect()
    totals: dict = {}
    for r in found:
        _more(totals, r.dim, r.n, from_text(r.sums), from_text(r.products))
    return {dim: (n, s, n * q.reshape(dim, dim) - np.outer(s, s)) for dim, (n, s, q) in sorted(totals.items())}


# -- the characteristic polynomial --------------------------------------------

def is_prime(n: int) -> bool:
    """Miller-Rabin; these bases decide every n under 2**32."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for base in (2, 3, 5, 7):
        x = pow(base, d, n)
        if x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(s - 1)):
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """The largest primes under 2**31 whose product exceeds ``bound``."""
    found, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def hessenberg(m: np.ndarray, p: int) -> np.ndarray:
    """A matrix similar to m modulo p with zeros below the first subdiagonal."""
    h = m.copy()
    for k in range(len(h) - 2):
        below = np.flatnonzero(h[k + 1:, k])
        if not len(below):
            continue
        r = k + 1 + int(below[0])
        if r != k + 1:
            h[[r, k + 1]] = h[[k + 1, r]]
            h[:, [r, k + 1]] = h[:, [k + 1, r]]
        times = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:] = (h[k + 2:] - times[:, None] * h[k + 1][None, :] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * times % p).sum(1)) % p
    return h


def polynomial_modulo(m: np.ndarray, p: int) -> np.ndarray:
    """det(t - m) modulo p, coefficients from that of t**0 up."""
    h, d = hessenberg(m, p), len(m)
    minors = np.zeros((d + 1, d + 1), np.int64)
    minors[0, 0] = 1
    for k in range(1, d + 1):
        factors, product = [int(h[k - 1, k - 1])], 1
        for i in range(1, k):
            product = product * int(h[k - i, k - i - 1]) % p
            factors.append(int(h[k - i - 1, k - 1]) * product % p)
        lower = (np.array(factors)[:, None] * minors[k - 1::-1] % p).sum(0)
        minors[k, 1:] = minors[k - 1, :-1]
        minors[k] = (minors[k] - lower) % p
    return minors[d]


def characteristic_polynomial(spark: SparkSession, m: np.ndarray) -> list[int]:
    """det(t - m) of a symmetric integer matrix without negative eigenvalues, from the coefficient of t**0 up."""
    d, trace = len(m), int(np.trace(m))
    # e_k of d numbers that are not negative is at most C(d, k) * (their sum / d)**k
    bound, binomial = 1, 1
    for k in range(1, d + 1):
        binomial = binomial * (d - k + 1) // k
        bound = max(bound, binomial * trace**k // d**k + 1)
    primes = primes_for(bound)
    entries = [int(x) for x in m.ravel()]

    def residues(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = []
        for p in batch.column(0).to_pylist():
            there = np.array([x % p for x in entries], np.int64).reshape(d, d)
            found.append(polynomial_modulo(there, p).tolist())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["p", "residues"])

    asked = spark.createDataFrame([(p,) for p in primes], "p bigint").repartition(min(len(primes), spark.sparkContext.defaultParallelism))
    rows = map_batches(asked, residues, "p bigint, residues array<bigint>").collect()
    whole = 1
    for p in primes:
        whole *= p
    totals = [0] * (d + 1)
    for p, found in rows:
        others = whole // p
        unit = others * pow(others, -1, p)
        # (-1)**(d-k) times the coefficient of t**k is not negative, so its residue is itself
        totals = [t + unit * (r if (d - k) % 2 == 0 else p - r) for k, (t, r) in enumerate(zip(totals, found))]
    return [t % whole * (1 if (d - k) % 2 == 0 else -1) for k, t in enumerate(totals)]


# -- roots ----------------------------------------------------------------------

def roots_above(polynomial: list[int], t: int) -> int:
    """How many roots of a polynomial with real roots only are greater than t."""
    shifted = polynomial[::-1]
    for k in range(len(shifted) - 1):  # synthetic division: leaves the coefficients of p(t + x)
        for j in range(1, len(shifted) - k):
            shifted[j] += t * shifted[j - 1]
    signs = [x > 0 for x in shifted if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def scaled(polynomial: list[int], bits: int) -> list[int]:
    """The polynomial whose roots are 2**bits times as large."""
    d = len(polynomial) - 1
    return [c << bits * (d - k) for k, c in enumerate(polynomial)]


def value(polynomial: list[int], t: int) -> int:
    total = 0
    for c in reversed(polynomial):
        total = total * t + c
    return total


def largest_roots(polynomial: list[int], how_many: int) -> list[tuple[int, int]]:
    """The largest roots, falling, each once for its multiplicity: (m, bits) for m / 2**bits, within 2**-bits.

    A root has ``BITS`` bits and more, and a zero root is (0, 0).
    """
    d = len(polynomial) - 1
    zeros = next(k for k, c in enumerate(polynomial) if c)
    rest = polynomial[zeros:]  # roots above 0 only
    top = 1 << max(1, (-rest[-2]).bit_length()) if len(rest) > 1 else 1  # more than their sum
    found: list[tuple[int, int]] = []
    todo = [(0, top, 0)] if len(rest) > 1 else []  # (low, high, bits): roots in (low, high] / 2**bits
    known: dict[tuple[int, int], int] = {}
    levels: dict[int, list[int]] = {0: rest}

    def above(t: int, bits: int) -> int:
        while bits and t % 2 == 0:
            t, bits = t // 2, bits - 1
        if (t, bits) not in known:
            known[t, bits] = roots_above(levels.setdefault(bits, scaled(rest, bits)), t)
        return known[t, bits]

    while todo and len(found) < how_many:
        low, high, bits = todo.pop()
        inside = above(low, bits) - above(high, bits)
        if not inside:
            continue
        if inside == 1:
            found.append(refined(rest, low, high, bits))
        elif high.bit_length() > BITS and high - low == 1:
            found += [(high, bits)] * inside  # no bit tells them apart
        else:
            if high - low == 1:
                low, high, bits = low * 2, high * 2, bits + 1
            middle = (low + high) // 2
            todo += [(low, middle, bits), (middle, high, bits)]
    return (found + [(0, 0)] * (d - len(rest) + 1))[:how_many]


def refined(polynomial: list[int], low: int, high: int, bits: int) -> tuple[int, int]:
    """The one root in (low, high] / 2**bits, to ``BITS`` bits, by the polynomial's signs."""
    here = scaled(polynomial, bits)
    at_high = value(here, high)
    while True:
        if at_high == 0:
            more = max(0, BITS + 1 - high.bit_length())
            return high << more, bits + more
        while high - low > 1:
            middle = (low + high) // 2
            at = value(here, middle)
            if at == 0:
                high, at_high = middle, 0
                break
            if (at > 0) == (at_high > 0):
                high, at_high = middle, at
            else:
                low = middle
        if at_high and high.bit_length() > BITS:
            return high, bits
        if at_high:
            more = max(1, BITS + 1 - high.bit_length())
            low, high, bits = low << more, high << more, bits + more
            here = scaled(polynomial, bits)
            at_high = value(here, high)


# -- components -----------------------------------------------------------------

def factored(b: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Gaussian elimination in fixed point with row exchanges: (multipliers below, the rest above; exchanges)."""
    b, d, swaps = b.copy(), len(b), []
    for k in range(d):
        r = k + max(range(d - k), key=lambda i: abs(b[k + i, k]))
        swaps.append(r)
        if r != k:
            b[[r, k]] = b[[k, r]]
        if b[k, k] == 0:
            b[k, k] = 1  # singular to the last bit
        if k + 1 < d:
            times = (b[k + 1:, k] << POINT) // b[k, k]
            b[k + 1:, k + 1:] -= (times[:, None] * b[k, k + 1:][None, :]) >> POINT
            b[k + 1:, k] = times
    return b, swaps


def solved(factors: np.ndarray, swaps: list[int], right: np.ndarray) -> np.ndarray:
    x, d = right.copy(), len(right)
    for k, r in enumerate(swaps):
        if r != k:
            x[[r, k]] = x[[k, r]]
    for k in range(d):
        x[k + 1:] -= (factors[k + 1:, k] * x[k]) >> POINT
    for k in range(d - 1, -1, -1):
        x[k] = (x[k] << POINT) // factors[k, k]
        x[:k] -= (factors[:k, k] * x[k]) >> POINT
    return x


def unit(x: np.ndarray) -> np.ndarray:
    """x at length 1, in fixed point."""
    shift = max(0, 2 * POINT - max(abs(v) for v in x).bit_length())
    x = x << shift
    return (x << POINT) // isqrt(int((x * x).sum()))


def eigenvectors(m: np.ndarray, root: tuple[int, int], how_many: int) -> list[np.ndarray]:
    """Orthogonal unit null vectors of m - root, in fixed point, by inverse iteration."""
    d = len(m)
    number, bits = root
    shift = number << POINT - bits if bits <= POINT else number >> bits - POINT
    factors, swaps = factored((m << POINT) - shift * np.eye(d, dtype=np.int64).astype(object))
    found: list[np.ndarray] = []
    for k in range(how_many):
        start = np.random.default_rng(k).integers(1 << 20, 1 << 21, d) * np.random.default_rng(k + 99).choice([-1, 1], d)
        x = unit(start.astype(object))
        for _ in range(4):
            x = unit(solved(factors, swaps, x))
            for v in found:
                x = x - ((((x * v).sum() >> POINT) * v) >> POINT)
            x = unit(x)
        found.append(x)
    return found


@dataclass
class Model:
    """What whitening needs of one length: n, sums, components, variances, shares of the trace."""

    n: int
    sums: list[int]
    components: np.ndarray  # one a row
    variances: list[float]
    explained: list[float | None]

    @property
    def rank(self) -> int:
        return sum(e > 0 for e in self.variances)

    def deviations(self, y: np.ndarray) -> np.ndarray:
        """n * y - S, exact: 64-bit integers where these hold it, else Python integers."""
        largest = max(int(y.max(initial=0)), -int(y.min(initial=0))) * self.n + max(map(abs, self.sums))
        if largest < 1 << 62:
            return y * self.n - np.array(self.sums, np.int64)
        return y.astype(object) * self.n - np.array(self.sums, object)

    def squares(self, deviations: np.ndarray) -> list[int]:
        if deviations.dtype != object and deviations.shape[1] * float(np.abs(deviations).max(initial=0)) ** 2 < 2.0**62:
            return (deviations * deviations).sum(1).tolist()
        wide = deviations.astype(object)
        return [int(x) for x in (wide * wide).sum(1)]

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        """Projections at unit variance, of the components that vary."""
        centred = (deviations / self.n).astype(float)
        return centred @ self.components[:self.rank].T / np.sqrt(self.variances[:self.rank])


def fit(spark: SparkSession, n: int, sums: np.ndarray, m: np.ndarray, components: int) -> Model:
    """The leading eigenvectors of a scatter."""
    d, trace = len(m), int(np.trace(m))
    how_many = min(components, d)
    roots = largest_roots(characteristic_polynomial(spark, m), how_many)
    vectors: list[np.ndarray] = []
    for k, root in enumerate(roots):
        if root == (0, 0):
            vectors.append(np.zeros(d))
        elif not (k and root == roots[k - 1]):
            alike = roots[k:].count(root)
            vectors += [x for x in eigenvectors(m, root, alike)]
    rows = []
    for v in vectors:
        x = np.array([float(c / (1 << POINT)) if isinstance(c, int) else 0.0 for c in v])
        rows.append(-x if x[np.abs(x).argmax()] < 0 else x)
    variances = [number / (n * n << bits) for number, bits in roots]
    explained = [number / (trace << bits) if trace else None for number, bits in roots]
    return Model(n, [int(s) for s in sums], np.array(rows), variances, explained)


# -- whitening --------------------------------------------------------------------

MOMENTS = "dim int, n bigint, mean array<double>, spread array<double>"


def _moments_batch(totals: dict) -> Iterator[pa.RecordBatch]:
    for dim, (n, mean, spread) in totals.items():
        yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([n], pa.int64()), pa.array([mean.tolist()], pa.list_(pa.float64())),
                                          pa.array([spread.ravel().tolist()], pa.list_(pa.float64()))], ["dim", "n", "mean", "spread"])


def _centred(totals: dict, dim: int, n: int, mean: np.ndarray, spread: np.ndarray) -> None:
    """Merge centred moments: products are taken about the means, never of raw values."""
    if dim in totals:
        m, other, more = totals[dim]
        apart = mean - other
        spread = spread + more + np.outer(apart, apart) * (n * m / (n + m))
        mean, n = other + apart * (n / (n + m)), n + m
    totals[dim] = n, mean, spread


def identity_errors(rows: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """For each length the largest entry, by size, of the covariance of ``whitened`` minus the identity."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict = {}
        for batch in batches:
            for _, y in by_length(batch):
                model = models[y.shape[1]]
                z = model.whitened(model.deviations(y))
                mean = z.mean(0)
                _centred(totals, y.shape[1], len(z), mean, (z - mean).T @ (z - mean))
        yield from _moments_batch(totals)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict = {}
        for batch in batches:
            for r in batch.to_pylist():
                k = len(r["mean"])
                _centred(totals, r["dim"], r["n"], np.array(r["mean"]), np.array(r["spread"]).reshape(k, k))
        yield from _moments_batch(totals)

    found = map_partitions(map_partitions(rows.select("v"), add, MOMENTS).repartition(MERGERS), merge, MOMENTS).collect()
    totals: dict = {}
    for r in sorted(found, key=lambda r: (r.dim, r.n, r.mean)):
        k = len(r.mean)
        _centred(totals, r.dim, r.n, np.array(r.mean), np.array(r.spread).reshape(k, k))
    return {dim: float(np.abs(spread / n - np.eye(len(mean))).max(initial=0.0)) for dim, (n, mean, spread) in totals.items()}


def whiten(vectors: DataFrame, components: int = 8, scale: float = 1024.0, id_column: str = "vec_id",
           embedding: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row for each vector and component.

    ``deviation``, the exact squared length of n * v - S, is a decimal of 38 digits; more is an error.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id_column].dataType.simpleString()
    rows = taking_part(vectors, scale, id_column, embedding)
    models = {dim: fit(spark, *sums, components) for dim, sums in scatter(rows).items()}
    errors = identity_errors(rows, models)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at, y in by_length(batch):
            model = models[y.shape[1]]
            k, rank = len(model.components), model.rank
            deviations = model.deviations(y)
            z = model.whitened(deviations)
            square = pa.array([Decimal(x) for x in model.squares(deviations)], pa.decimal128(38, 0))
            each = np.repeat(np.arange(len(at)), k)
            filled = np.zeros((len(at), k))
            filled[:, :rank] = z
            no_variance = np.tile(np.arange(k) >= rank, len(at))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at[each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                 pa.array(np.full(len(each), model.n)), square.take(pa.array(each)),
                 pa.array(filled.ravel(), mask=no_variance), pa.array(model.explained * len(at), pa.float64()),
                 pa.array(np.full(len(each), errors[y.shape[1]]))],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    schema = (f"id {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, "
              "identity_error double")
    return map_batches(rows, run, schema).withColumnRenamed("id", id_column)
