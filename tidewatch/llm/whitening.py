"""Whitening of embeddings through the exact characteristic polynomial of their scatter.

Entries become whole numbers, so the scatter n * sum(x x') - S S' is an integer
matrix, summed exactly over the table: tasks send sums, never rows. Its
characteristic polynomial is found modulo many primes, one Hessenberg reduction
each and spread over the cluster, and put together by Chinese remaindering. All
roots of it are real, so the number of roots above a point is the number of sign
changes after a shift to that point (exact, multiplicities counted): bisection
isolates the largest roots to 160 bits. Components come from inverse iteration
on the null space in decimal arithmetic of 130 digits.

Matrix and polynomial depend on the dimension only, never on the number of rows.
"""

from __future__ import annotations

import decimal
import math
import random
from collections.abc import Iterator, Sequence
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import table

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
ROOT_BITS, DIGITS, ROUNDS = 160, 130, 5
LIMB = 32


# --- the scatter, exactly ----------------------------------------------------


def _whole(vector: Column) -> Column:
    """True if every entry becomes a long; a vector of no entries has none to use."""
    fits = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * SCALE) < 2.0**62)
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, fits), F.lit(False))


def _lattice(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """floor(1024 * c) of the last column, one row per vector (the constant shift cancels in every result)."""
    flat = batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False).astype(float)
    return np.floor(flat * SCALE).astype(np.int64).reshape(-1, dim)


def _products(y: np.ndarray) -> np.ndarray:
    """y' y as whole numbers of any size."""
    most = int(np.abs(y).max(initial=0))
    if most * most * max(len(y), 1) < 2**53:  # every partial sum is exact in a double
        return (y.T.astype(float) @ y.astype(float)).astype(np.int64).astype(object)
    wide = y.astype(object)
    return wide.T @ wide


def _sums(dim: int):
    upper = np.triu_indices(dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + dim + len(upper[0]), object)
        for batch in batches:
            if batch.num_rows:
                y = _lattice(batch, dim)
                total[0] += len(y)
                total[1 : dim + 1] += y.astype(object).sum(axis=0)
                total[dim + 1 :] += _products(y)[upper]
        cells, limbs, values = [], [], []
        for cell, value in enumerate(total.tolist()):
            sign, value, k = (-1 if value < 0 else 1), abs(value), 0
            while value:
                cells.append(cell)
                limbs.append(k)
                values.append(sign * (value & ((1 << LIMB) - 1)))
                value, k = value >> LIMB, k + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int32()), pa.array(limbs, pa.int32()), pa.array(values, pa.int64())], names=["cell", "limb", "v"]
        )

    return run


def scatter(rows: DataFrame, dim: int) -> tuple[int, list[int], np.ndarray]:
    """Rows n, sums S and the integer matrix n * sum(y y') - S S', of ``dim`` columns."""
    parts = rows.mapInArrow(_sums(dim), "cell int, limb int, v long").groupBy("cell", "limb").agg(F.sum("v").alias("v"))
    total = [0] * (1 + dim + dim * (dim + 1) // 2)
    for r in parts.collect():  # as many numbers as the matrix has, in limbs of 32 bits
        total[r.cell] += r.v << (LIMB * r.limb)
    n, sums = total[0], total[1 : dim + 1]
    upper = np.triu_indices(dim)
    matrix = np.zeros((dim, dim), object)
    matrix[upper] = total[dim + 1 :]
    matrix.T[upper] = total[dim + 1 :]
    wide = np.array(sums, object)
    return n, sums, n * matrix - np.outer(wide, wide)


# --- its characteristic polynomial -------------------------------------------


def characteristic_mod(matrix: Sequence[Sequence[int]], p: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo a prime below 2**31, the lowest first."""
    d = len(matrix)
    h = np.array([[int(x) % p for x in row] for row in matrix], np.int64).reshape(d, d)
    for m in range(1, d - 1):
        rows = np.flatnonzero(h[m:, m - 1])
        if not len(rows):
            continue
        if rows[0]:
            i = m + int(rows[0])
            h[[m, i]] = h[[i, m]]
            h[:, [m, i]] = h[:, [i, m]]
        u = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * u % p).sum(axis=1)) % p
    found = np.zeros((d + 1, d + 1), np.int64)
    found[0, 0] = 1
    below = np.zeros(0, np.int64)  # products of the subdiagonal down to the row above
    for k in range(1, d + 1):
        below = np.append(below, 1)
        if k > 1:
            below[:-1] = below[:-1] * h[k - 1, k - 2] % p
        taken = h[:k, k - 1] * below % p
        found[k, 1:] = found[k - 1, :-1]
        found[k] = (found[k] - (taken[:, None] * found[:k] % p).sum(axis=0)) % p
    return found[d].tolist()


def _prime(n: int) -> bool:
    """Exact below 3.2 * 10**9."""
    if n < 2 or any(n % q == 0 for q in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for a in (2, 3, 5, 7):
        x = pow(a, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2**31 whose product exceeds ``bound``."""
    found, product, n = [], 1, 2**31 - 1
    while product <= bound:
        if _prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def characteristic(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Coefficients of det(x - matrix) for a positive semidefinite integer matrix, the lowest first.

    A coefficient is at most C(d, k) * (trace / d)**k, as the eigenvalues are
    not negative; that tells how many primes are needed. One row per prime, its
    residues back: both follow from the matrix alone.
    """
    d = len(matrix)
    trace = int(np.trace(matrix))
    most = max(math.comb(d, k) * (trace // d + 1) ** k for k in range(d + 1))
    primes, rows = primes_beyond(2 * most), [[int(x) for x in row] for row in matrix]

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [primes[i] for i in batch.column(0).to_pylist()]
            found = [characteristic_mod(rows, p) for p in own]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["p", "c"])

    tasks = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    by_prime = spark.range(0, len(primes), 1, tasks).mapInArrow(residues, "p long, c array<long>").collect()
    product = math.prod(r.p for r in by_prime)
    whole = [0] * (d + 1)
    for r in by_prime:
        rest = product // r.p
        share = rest * pow(rest, -1, r.p)
        for k, c in enumerate(r.c):
            whole[k] += c * share
    return [x - product if (x := w % product) > product // 2 else x for w in whole]


# --- its roots ---------------------------------------------------------------


def _above(poly: list[int], a: int) -> int:
    """How many roots exceed ``a``, for a polynomial with real roots only: sign changes after the shift."""
    c = poly[::-1]
    for k in range(len(c) - 1, 0, -1):
        for i in range(1, k + 1):
            c[i] += a * c[i - 1]
    signs = [x > 0 for x in c if x]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def _sign(poly: list[int], x: int) -> int:
    value = 0
    for c in reversed(poly):
        value = value * x + c
    return (value > 0) - (value < 0)


def largest_roots(poly: list[int], wanted: int, bits: int = ROOT_BITS) -> list[Fraction]:
    """The largest roots, falling and with their multiplicity, of a polynomial with roots >= 0 only.

    Each is isolated by counting the roots above points, then halved by signs
    (a multiple root by counts throughout) to ``bits`` bits below the largest.
    """
    d = len(poly) - 1
    zeros = next(k for k, c in enumerate(poly) if c)
    top = -poly[d - 1]  # the sum of the roots
    shift = max(0, bits - top.bit_length())
    scaled = [c << (shift * (d - k)) for k, c in enumerate(poly)]
    known = {0: d - zeros, (top << shift) + 1: 0}

    def above(a: int) -> int:
        if a not in known:
            known[a] = _above(scaled, a)
        return known[a]

    roots: list[Fraction] = []
    for k in range(1, min(wanted, d) + 1):
        if k > d - zeros:
            roots.append(Fraction(0))
            continue
        low = max(a for a, n in known.items() if n >= k)
        high = min(a for a, n in known.items() if n < k)
        while high - low > 1 and above(low) - above(high) > 1:
            middle = (low + high) // 2
            if above(middle) >= k:
                low = middle
            else:
                high = middle
        side = _sign(scaled, high)
        while high - low > 1 and side:
            middle = (low + high) // 2
            sign = _sign(scaled, middle)
            low, high = (middle, high) if sign == -side else (low, middle)
            side = sign and side
        roots.append(Fraction(high, 1 << shift))
    return roots


def components(matrix: np.ndarray, roots: Sequence[Fraction]) -> np.ndarray:
    """Unit eigenvectors (rows, as Decimals) to the given eigenvalues of a symmetric integer matrix."""
    d, out = len(matrix), []
    with decimal.localcontext(prec=DIGITS):
        exact = np.array([[Decimal(int(x)) for x in row] for row in matrix], object).reshape(d, d)
        size = max((abs(x) for x in exact.flat), default=Decimal(0)) or Decimal(1)
        tiny = size.scaleb(20 - DIGITS)
        draw = random.Random(11)
        for root in roots:
            lu = exact.copy()
            lu[np.diag_indices(d)] -= Decimal(root.numerator) / Decimal(root.denominator)
            order = list(range(d))
            for k in range(d):
                best = max(range(k, d), key=lambda i: abs(lu[i, k]))
                if best != k:
                    lu[[k, best]] = lu[[best, k]]
                    order[k], order[best] = order[best], order[k]
                if abs(lu[k, k]) < tiny:
                    lu[k, k] = tiny
                lu[k + 1 :, k] /= lu[k, k]
                lu[k + 1 :, k + 1 :] -= np.outer(lu[k + 1 :, k], lu[k, k + 1 :])
            x = np.array([Decimal(draw.randrange(1, 10**9)) for _ in range(d)], object)
            for _ in range(ROUNDS):
                x = x[order]
                for k in range(1, d):
                    x[k] -= (lu[k, :k] * x[:k]).sum()
                for k in range(d - 1, -1, -1):
                    x[k] = (x[k] - (lu[k, k + 1 :] * x[k + 1 :]).sum()) / lu[k, k]
                for _ in range(2):  # equal roots share a null space: stay apart from what is found
                    x = x / (x * x).sum().sqrt()
                    for other in out:
                        x = x - (x * other).sum() * other
                x = x / (x * x).sum().sqrt()
            out.append(x)
    return np.array(out, object).reshape(len(roots), d)


# --- the rows ----------------------------------------------------------------


class Whitener:
    """Means, components and scales of a fit, small enough for every task."""

    def __init__(self, n: int, sums: list[int], matrix: np.ndarray, roots: Sequence[Fraction]):
        self.n, self.sums, dim = n, sums, len(sums)
        trace = int(np.trace(matrix))
        mean = [Fraction(s, n) for s in sums]
        self.mean = np.array([float(m) for m in mean])
        self.rest = np.array([float(m - Fraction(f)) for m, f in zip(mean, self.mean.tolist())])
        vectors = components(matrix, roots)
        self.explained = [float(r / trace) if trace else 0.0 for r in roots]
        self.used = [k for k, r in enumerate(roots) if r > 0]
        self.axes = np.zeros((dim, len(roots)))
        with decimal.localcontext(prec=DIGITS):
            for k in self.used:
                value = roots[k] / n / n
                scale = (Decimal(value.numerator) / Decimal(value.denominator)).sqrt()
                self.axes[:, k] = [float(x / scale) for x in vectors[k]]

    def whitened(self, y: np.ndarray) -> np.ndarray:
        return ((y - self.mean) - self.rest) @ self.axes

    def deviations(self, y: np.ndarray) -> list[int]:
        """Squared distance of n * y from the sums, exactly."""
        most = int(np.abs(y).max(initial=0)) * max([abs(s) for s in self.sums] + [1]) * y.shape[1]
        far = int(np.abs(y).max(initial=0)) ** 2 * y.shape[1]
        kind = np.int64 if max(most, far) < 2**62 else object
        wide, sums = y.astype(kind), np.array(self.sums, kind)
        own, with_sums, base = (wide * wide).sum(axis=1), (wide * sums).sum(axis=1), sum(s * s for s in self.sums)
        return [self.n * self.n * int(a) - 2 * self.n * int(b) + base for a, b in zip(own, with_sums)]


def _moments(model: Whitener, dim: int):
    """Per task: rows, sums and products of the whitened rows, centred within the task before they are multiplied."""
    width = len(model.explained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, spread = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            if not batch.num_rows:
                continue
            w = model.whitened(_lattice(batch, dim))
            m = w.mean(axis=0)
            c = w - m
            step, all_rows = m - mean, n + len(w)
            spread += c.T @ c + np.outer(step, step) * (n * len(w) / all_rows)
            mean, n = mean + step * (len(w) / all_rows), all_rows
        values = np.concatenate([n * mean, (spread + n * np.outer(mean, mean)).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values)], names=["cell", "v"])

    return run


def identity_error(rows: DataFrame, model: Whitener, dim: int) -> float | None:
    """Largest entry of the whitened covariance minus the identity, over components with variance.

    Means of the whole are rounding errors of zero, so taking them out of the
    summed products afterwards loses nothing.
    """
    if not model.used:
        return None
    summed = rows.mapInArrow(_moments(model, dim), "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    width = len(model.explained)
    flat = np.zeros(width + width * width)
    for r in summed:
        flat[r.cell] = r.v
    mean = flat[:width] / model.n
    covariance = flat[width:].reshape(width, width) / model.n - np.outer(mean, mean)
    part = np.ix_(model.used, model.used)
    return float(np.abs(covariance[part] - np.eye(len(model.used))).max())


def _rows(model: Whitener, dim: int, error: float | None):
    width = len(model.explained)
    zero = np.array([k not in model.used for k in range(width)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 4096):
                batch = whole.slice(a, 4096)
                y = _lattice(batch, dim)
                again = pa.array(np.repeat(np.arange(len(y)), width))
                far = [Decimal(x) if x < 10**38 else None for x in model.deviations(y)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(again),
                        pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(y))),
                        pa.array(np.full(len(y) * width, model.n)),
                        pa.array(far, pa.decimal128(38, 0)).take(again),
                        pa.array(model.whitened(y).ravel(), mask=np.tile(zero, len(y))),
                        pa.array(np.tile(model.explained, len(y))),
                        pa.array([error] * (len(y) * width), pa.float64()),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def whiten(embeddings: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per vector and component.

    Vectors that are null, empty, or hold a null, a non-finite entry or one that
    is no long after scaling are left out, and so are those shorter than the
    longest that remains (their missing entries count as nulls). Null and
    repeated ids stay, each row for itself; repeated rows count as often as they
    occur. There are as many components as dimensions, ``wanted`` at most. Equal
    eigenvalues get orthogonal components of their common space. A component
    without variance has explained 0 and whitened null, and does not count in
    identity_error, which is null if there is no other. deviation is
    decimal(38, 0), null beyond. No vectors left, no rows.
    """
    spark = embeddings.sparkSession
    valid = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).filter(_whole(F.col("embedding")))
    kind = dict(embeddings.dtypes)["vec_id"]
    schema = (
        f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    )
    dim = valid.agg(F.max(F.size("embedding"))).first()[0]
    if dim is None:
        return spark.createDataFrame([], schema)
    rows = valid.filter(F.size("embedding") == dim)
    vectors = rows.select("embedding")
    n, sums, matrix = scatter(vectors, dim)
    roots = largest_roots(characteristic(spark, matrix), wanted)
    model = Whitener(n, sums, matrix, roots)
    return rows.mapInArrow(_rows(model, dim, identity_error(vectors, model, dim)), schema)


def op11_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    rows = whiten(table(spark, sf_dir, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("bigint"))
