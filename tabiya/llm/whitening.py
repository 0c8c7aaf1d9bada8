"""Embedding whitening by the exact characteristic polynomial of the integer scatter.

Components become whole numbers; the fit list is every distinct vector once.
With n vectors of sums S, the matrix G = n * sum(x x') - S S' is made of whole
numbers and is n * n times the covariance, so nothing is rounded before the
eigenvalues are known.

* Every task adds up its vectors' products exactly: float64 products of
  stretches that stay below 2**53, split into limbs where a component is too
  long for that; the upper triangle's sums meet in a ``groupBy``.
* The characteristic polynomial is found modulo many 31-bit primes, a range of
  primes per task: reduction to Hessenberg form by similarity, then the
  recurrence of the leading minors. As G is positive semi-definite, its k-th
  coefficient is at most C(d, k) * (trace / d) ** k, which says how many primes
  tell all coefficients apart; Chinese remaindering puts them together.
* All roots are real, so by Descartes' rule the sign changes of the polynomial
  shifted to y are exactly the number of roots above y. Bisection by these
  counts, in whole numbers of 2**-k of a unit, isolates every wanted root to
  ``ROOT_BITS`` bits, multiple roots included.
* Inverse iteration with ``DIGITS`` decimal digits gives the null space of
  G - root: as many orthonormal vectors as the root counts.

What the driver holds is bounded by the dimension: the matrix, the polynomial
and the components.

Defined cases: rows with a null vector, or a null, NaN or infinite component are
dropped; vectors of unequal length are filled up with zeros; an empty vector is
all zeros; repeated rows and copies under other ids count once in the fit and
are all whitened; components without spread (eigenvalue 0) are left out, so one
distinct vector, like an empty table, gives no rows; equal eigenvalues take any
orthonormal vectors of their space; each component's largest entry is positive;
null ids are kept; other columns are not read.
"""

from __future__ import annotations

import math
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, ship, stored
from .vectors import dimension, integers, usable

#: Bits to which a root is isolated, relative to the largest.
ROOT_BITS = 160
#: Decimal digits of the inverse iteration.
DIGITS = 90
#: Primes whose polynomials a task finds together.
PRIMES_A_TASK = 16
#: Float64 adds products of whole numbers exactly below this.
EXACT = 2 ** 53


# ---------------------------------------------------------------- exact sums

def _limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Parts of the numbers, the last first: x = sum of part * 2 ** (bits * place); all but the first are not negative."""
    out = []
    while True:
        if not len(x) or np.abs(x).max() < 1 << bits:
            return [*out, x.astype(np.float64)]
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits


def _products(x: np.ndarray) -> np.ndarray:
    """Exact sums of products of the columns (Python integers)."""
    rows = 4096
    bits = (EXACT // rows).bit_length() // 2 - 1
    total = np.zeros((x.shape[1],) * 2, object)
    for i in range(0, len(x), rows):
        limbs = _limbs(x[i:i + rows], bits)
        for a, u in enumerate(limbs):
            for b, v in enumerate(limbs):
                total += (u.T @ v).astype(np.int64).astype(object) * (1 << bits * (a + b))
    return total


def _scatter(width: int):
    """(place, value) of a partition: number of vectors at -1, sums, then the upper triangle of products."""
    upper = np.triu_indices(width)

    def run(batches):
        n, sums, total = 0, np.zeros(width, object), np.zeros((width, width), object)
        for batch in batches:
            x = integers(batch.column("vector"), width) if "vector" in batch.schema.names else _unpacked(batch.column("x"), width)
            n += len(x)
            sums += x.astype(object).sum(0) if len(x) and np.abs(x).max() > 2 ** 40 else x.sum(0).astype(object)
            total += _products(x)
        values = [n, *sums.tolist(), *total[upper].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(values) - 1), pa.int64()), pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))], names=["place", "value"])

    return run


def _packed(width: int):
    """Each vector's whole numbers as bytes, in two bytes each where they fit."""

    def run(batches):
        for batch in batches:
            x = integers(batch.column("vector"), width)
            small = (np.abs(x) < 1 << 15).all(1)
            out = [(row.astype("<i2") if s else row.astype("<i8")).tobytes() for row, s in zip(x, small)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["x"])

    return run


def _unpacked(column: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(column), width), np.int64)
    for i, v in enumerate(column):
        raw = v.as_buffer()
        out[i] = np.frombuffer(raw, "<i2" if raw.size == 2 * width else "<i8")
    return out


# ---------------------------------------------------------------- characteristic polynomial

def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that are enough below 2**32."""
    d, s = n - 1, 0
    while d % 2 == 0:
        d, s = d // 2, s + 1
    for a in (2, 7, 61):
        x = pow(a, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(s - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_above(bound: int) -> list[int]:
    """Primes below 2**31, the largest first, whose product is more than ``bound``."""
    out, product, p = [], 1, 2 ** 31 - 1
    while product <= bound:
        if _is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def polynomials_mod(matrix: list[list[int]], primes: list[int]) -> np.ndarray:
    """Coefficients (constant first) of det(t - matrix) modulo each prime, all primes advancing together."""
    d = len(matrix)
    p = np.array(primes, np.int64)[:, None]
    h = np.array([[[v % q for v in row] for row in matrix] for q in primes], np.int64).reshape(len(primes), d, d)
    every = np.arange(len(primes))
    q = p[:, :, None]
    for m in range(1, d - 1):
        # bring a row with an entry in column m - 1 to place m; without one the column is done
        there = h[:, m:, m - 1] != 0
        pivot = m + there.argmax(1)
        for axis in (1, 2):
            at = (every, pivot) if axis == 1 else (every, slice(None), pivot)
            to = (every, np.full(len(every), m)) if axis == 1 else (every, slice(None), np.full(len(every), m))
            h[at], h[to] = h[to].copy(), h[at].copy()
        inverse = np.array([pow(int(v), -1, int(r)) if v else 0 for v, r in zip(h[:, m, m - 1], primes)], np.int64)[:, None]
        u = h[:, m + 1:, m - 1] * inverse % p
        h[:, m + 1:] = (h[:, m + 1:] - u[:, :, None] * h[:, m:m + 1] % q) % q
        # column m takes the other columns' shares, one product at a time below 2**62
        h[:, :, m] = (h[:, :, m] + (h[:, :, m + 1:] * u[:, None] % q).sum(2)) % p
    minors = [np.ones((len(primes), 1), np.int64)]
    for k in range(d):
        own = np.zeros((len(primes), k + 2), np.int64)
        own[:, 1:] = minors[k]
        own[:, :-1] -= h[:, k, k, None] * minors[k] % p
        below = np.ones(len(primes), np.int64)
        for i in range(k - 1, -1, -1):
            below = below * h[:, i + 1, i] % p[:, 0]
            own[:, :i + 1] -= (below * h[:, i, k] % p[:, 0])[:, None] * minors[i] % p
        minors.append(own % p)
    return minors[d]


def remaindered(residues: list[list[int]], primes: list[int]) -> list[int]:
    """The whole numbers nearest to zero with the given residues."""
    product = math.prod(primes)
    parts = [product // p * pow(product // p, -1, p) for p in primes]
    out = []
    for column in zip(*residues):
        v = sum(r * part for r, part in zip(column, parts)) % product
        out.append(v - product if 2 * v > product else v)
    return out


def characteristic_polynomial(spark, g: list[list[int]]) -> list[int]:
    """Coefficients, constant first, of det(t - g) for a positive semi-definite matrix of whole numbers."""
    d, trace = len(g), sum(g[i][i] for i in range(len(g)))
    bound = max(math.comb(d, k) * trace ** k // d ** k + 1 for k in range(d + 1))
    primes = primes_above(2 * bound + 1)
    sent = spark.sparkContext.broadcast([[str(v) for v in row] for row in g])

    def run(batches):
        matrix = [[int(v) for v in row] for row in sent.value]
        for batch in batches:
            mine = batch.column("prime").to_pylist()
            for i in range(0, len(mine), PRIMES_A_TASK):
                some = mine[i:i + PRIMES_A_TASK]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(polynomials_mod(matrix, some).tolist(), pa.list_(pa.int64()))], names=["prime", "residues"])

    tasks = -(-len(primes) // PRIMES_A_TASK)
    given = spark.createDataFrame([(p,) for p in primes], "prime bigint").repartition(tasks, "prime")
    found = {r.prime: r.residues for r in given.mapInArrow(run, "prime bigint, residues array<bigint>").collect()}
    return remaindered([found[p] for p in primes], primes)


# ---------------------------------------------------------------- roots

def roots_above(poly: list[int], y: int, bits: int) -> int:
    """Roots above y / 2**bits, counted as often as they occur, of a polynomial with real roots only."""
    d = len(poly) - 1
    c = [v << bits * (d - k) for k, v in enumerate(poly)]  # roots are now multiples of 2**-bits
    for i in range(d):  # shift by y
        for k in range(d - 1, i - 1, -1):
            c[k] += y * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(poly: list[int], n: int) -> list[tuple[int, int, int]]:
    """(root in units of 2**-bits, bits, how often) of the largest positive roots, ``n`` in all or a few more."""
    trace = -poly[-2] if len(poly) > 1 else 0
    bits = max(0, ROOT_BITS - trace.bit_length())
    floor = 0
    n = min(n, roots_above(poly, 0, 0))
    out: list[tuple[int, int, int]] = []
    while sum(m for _, _, m in out) < n:
        before = sum(m for _, _, m in out)
        # the largest y with more than ``before`` roots above it is just below the next root
        low, high = floor, out[-1][0] if out else (trace << bits) + 1
        while high - low > 1:
            mid = (low + high) // 2
            if roots_above(poly, mid, bits) > before:
                low = mid
            else:
                high = mid
        out.append((high, bits, roots_above(poly, low, bits) - before))
    return out


# ---------------------------------------------------------------- components

def null_vectors(g: list[list[int]], root: int, bits: int, n: int) -> list[list[float]]:
    """``n`` orthonormal vectors v with g v = root / 2**bits * v, by inverse iteration."""
    d = len(g)
    with localcontext() as context:
        context.prec = DIGITS
        unit = Decimal(1 << bits)
        a = np.array([[Decimal(v) for v in row] for row in g], object)
        a[np.arange(d), np.arange(d)] -= Decimal(root) / unit
        tiny = max(abs(v) for v in a.ravel()) * Decimal(10) ** -(DIGITS - 5) or Decimal(1)
        order = list(range(d))
        for k in range(d):  # elimination with row exchanges; the factors stay below the diagonal
            pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
            if pivot != k:
                a[[k, pivot]] = a[[pivot, k]]
                order[k], order[pivot] = order[pivot], order[k]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            if k + 1 < d:
                a[k + 1:, k] = a[k + 1:, k] / a[k, k]
                a[k + 1:, k + 1:] = a[k + 1:, k + 1:] - np.multiply.outer(a[k + 1:, k], a[k, k + 1:])

        def solved(v):
            v = v[order].copy()
            for k in range(1, d):
                v[k] -= (a[k, :k] * v[:k]).sum()
            for k in range(d - 1, -1, -1):
                v[k] = (v[k] - (a[k, k + 1:] * v[k + 1:]).sum()) / a[k, k]
            return v

        out: list[np.ndarray] = []
        for start in range(n):
            v = np.array([Decimal(1 + (7 * i * (start + 1) + 3 * start) % 11) for i in range(d)], object)
            for _ in range(3):
                v = solved(v)
                for _ in range(2):
                    for u in out:
                        v = v - u * (u * v).sum()
                v = v / (v * v).sum().sqrt()
            out.append(v)
        return [[float(x) for x in (v if max(v, key=abs) > 0 else -v)] for v in out]


class Fit:
    """What the fit list gives: n, sums, components with their roots, and the trace."""

    def __init__(self, n: int, sums: list[int], g: list[list[int]], roots: list[tuple[int, int, int]], components: int):
        self.n, self.sums = n, sums
        self.trace = sum(g[i][i] for i in range(len(g)))
        vectors, values = [], []
        for root, bits, times in roots:
            some = null_vectors(g, root, bits, times)
            vectors += some
            values += [float(Decimal(root) / Decimal(1 << bits))] * times
        self.vectors = np.array(vectors[:components], np.float64).reshape(len(values[:components]), len(g))
        self.roots = np.array(values[:components])
        self.explained = (self.roots / float(self.trace)).tolist() if self.trace else []

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S as whole numbers (64 bits where they fit, else Python integers)."""
        largest = int(np.abs(x).max(initial=0)) * self.n + max((abs(s) for s in self.sums), default=0)
        if largest < 2 ** 62:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        """(x - S / n) on each component, over the square root of its eigenvalue."""
        return centred.astype(np.float64) @ (self.vectors / np.sqrt(self.roots)[:, None]).T

    def deviation(self, centred: np.ndarray) -> list[int] | np.ndarray:
        """Sum of squares of n * x - S, exact."""
        if centred.dtype != object and int(np.abs(centred).max(initial=0)) ** 2 * max(centred.shape[1], 1) < 2 ** 63:
            return (centred * centred).sum(1)
        return [sum(int(v) * int(v) for v in row) for row in centred.tolist()]


def _moments(sent, width: int):
    """Sums of a partition's whitened vectors and of their products."""

    def run(batches):
        fit = sent.value
        k = len(fit.roots)
        total = np.zeros((k + 1, k + 1))
        for batch in batches:
            w = fit.whitened(fit.centred(_unpacked(batch.column("x"), width)))
            w = np.concatenate((w, np.ones((len(w), 1))), 1)
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["place", "value"])

    return run


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = 4) -> tuple[Fit, float]:
    """The components of the distinct vectors, and how far their whitened covariance is from the identity."""
    spark = ship(vectors.sparkSession)
    rows = _rows(vectors, vector_col)
    width = dimension(rows, "vector")
    distinct = stored(rows.select("vector").mapInArrow(_packed(width), "x binary").distinct(), "distinct-vectors")
    sums = {r.place: int(r.value) for r in distinct.mapInArrow(_scatter(width), "place bigint, value decimal(38,0)").groupBy("place").agg(F.sum("value").cast("decimal(38,0)").alias("value")).collect()}
    n, s = sums.get(-1, 0), [sums.get(i, 0) for i in range(width)]
    g = [[0] * width for _ in range(width)]
    for place, (i, j) in enumerate(zip(*np.triu_indices(width)), width):
        g[i][j] = g[j][i] = n * sums.get(place, 0) - s[i] * s[j]
    roots = largest_roots(characteristic_polynomial(spark, g), components) if any(map(any, g)) else []
    found = Fit(n, s, g, roots, components)
    error = 0.0
    if len(found.roots):
        k = len(found.roots) + 1
        moments = distinct.mapInArrow(_moments(spark.sparkContext.broadcast(found), width), "place bigint, value double").groupBy("place").agg(F.sum("value").alias("value"))
        total = np.zeros(k * k)
        for r in moments.collect():
            total[r.place] = r.value
        total = total.reshape(k, k) / n
        covariance = total[:-1, :-1] - np.outer(total[-1, :-1], total[-1, :-1])
        error = float(np.abs(covariance - np.eye(k - 1)).max())
    drop_stored(distinct)
    return found, error


def _rows(vectors: DataFrame, vector_col: str, id_col: str | None = None) -> DataFrame:
    c = F.col(vector_col).cast("array<double>")
    keep = [c.alias("vector")] + ([F.col(id_col).alias("id")] if id_col else [])
    return vectors.select(*keep).filter(usable(F.col("vector")))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4) -> DataFrame:
    """(id, component, n, deviation decimal, whitened, explained, identity_error) of every usable row and component."""
    spark = ship(vectors.sparkSession)
    found, error = fit(vectors, vector_col, components)
    rows = _rows(vectors, vector_col, id_col)
    width = len(found.sums)
    sent = spark.sparkContext.broadcast(found)

    def run(batches):
        f = sent.value
        k = len(f.roots)
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            centred = f.centred(integers(batch.column("vector"), width))
            deviation = f.deviation(centred)
            wide = pa.array(deviation, pa.int64()).cast(pa.decimal128(38, 0)) if isinstance(deviation, np.ndarray) else pa.array([Decimal(v) for v in deviation], pa.decimal128(38, 0))
            take = pa.array(np.repeat(np.arange(batch.num_rows), k))
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(take), pa.array(np.tile(np.arange(1, k + 1), batch.num_rows), pa.int32()), wide.take(take),
                pa.array(f.whitened(centred).ravel()), pa.array(np.tile(f.explained, batch.num_rows))], names=["id", "component", "deviation", "whitened", "explained"])

    kind = vectors.schema[id_col].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, component int, deviation decimal(38,0), whitened double, explained double")
    return out.select(F.col("id").alias(id_col), "component", F.lit(found.n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(error).alias("identity_error"))
