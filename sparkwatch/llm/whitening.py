"""Embedding whitening from the exact characteristic polynomial of the scatter matrix.

Vectors become integers, so their scatter matrix n * sum(x x') - (sum x)(sum x)' is an exact
integer matrix, summed in one pass by Spark. Its characteristic polynomial is worked out modulo
many primes, one prime per row of a Spark job (reduction to Hessenberg form, then the recurrence
over leading minors), and put together by Chinese remaindering. The matrix is symmetric, so all
roots are real and Descartes' sign rule counts them exactly: the number of roots above a is the
number of sign changes of the polynomial shifted by a. Bisection by that count isolates the root
of each rank, repeated ones included, to 100 bits. A component is the null vector of the
matrix less its root, by inverse iteration in decimal arithmetic of that precision.

The driver sees the scatter matrix and the polynomial, whose size depends on the dimension alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A component c becomes floor(SCALE * c) + SHIFT.
SCALE = 1024
SHIFT = 100_000
#: Roots are isolated to this relative precision.
ROOT_BITS = 100
_DIGITS = 90
#: Exact sums travel as limbs of this many bits.
_LIMB = 40
_ROWS = 1024


def _usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, v) of the rows whose vector is not null and holds finite numbers only."""
    v = F.col(f"`{vector_column}`").cast("array<double>")
    good = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    return vectors.where(F.coalesce(good, F.lit(False))).select(
        F.col(f"`{id_column}`").alias("vec_id"), v.alias("v")
    )


def _integers(column: pa.ListArray, width: int | None = None) -> np.ndarray:
    """floor(SCALE * c) of each component, rows filled up with zeros; exact at any size."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(lengths.max(initial=0)) if width is None else width
    values = column.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(column)), lengths)
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    if np.abs(values).max(initial=0) < 1 << 40:
        out = np.zeros((len(column), width), np.int64)
        out[row, place] = np.floor(values * SCALE).astype(np.int64)
        return out
    out = np.zeros((len(column), width), object)
    large = [int(c) * SCALE if abs(c) >= 1 << 53 else math.floor(c * SCALE) for c in values.tolist()]
    for r, p, value in zip(row.tolist(), place.tolist(), large, strict=True):
        out[r, p] = value
    return out


def _products(x: np.ndarray) -> np.ndarray:
    """x' x without rounding: in floating point where every sum fits its mantissa."""
    if x.dtype != object:
        most = int(np.abs(x).max(initial=0))
        if most * most * len(x) < 1 << 53:
            y = x.astype(np.float64)
            return np.rint(y.T @ y).astype(np.int64)
        x = x.astype(object)
    return x.T @ x


def _scatter_rows(batches):
    """Exact sums over a task's rows of the products of (1, x), as limbs."""
    total = np.zeros((1, 1), object)
    for batch in batches:
        for i in range(0, batch.num_rows, _ROWS):
            x = _integers(batch.column(0).slice(i, _ROWS))
            one = np.ones((len(x), 1), x.dtype)
            part = _products(np.concatenate([one, x], axis=1))
            if len(part) > len(total):
                grown = np.zeros(part.shape, object)
                grown[: len(total), : len(total)] = total
                total = grown
            total[: len(part), : len(part)] += part
    i, j = np.tril_indices(len(total))
    cells, limbs, values = [], [], []
    for cell, value in enumerate(total[i, j].tolist()):
        sign, rest, limb = (1 if value >= 0 else -1), abs(int(value)), 0
        while rest or not limb:
            cells.append(cell)
            limbs.append(limb)
            values.append(sign * (rest & ((1 << _LIMB) - 1)))
            rest >>= _LIMB
            limb += 1
    yield pa.RecordBatch.from_arrays(
        [pa.array(cells, pa.int64()), pa.array(limbs, pa.int32()), pa.array(values, pa.int64())],
        names=["cell", "limb", "value"],
    )


def scatter(vectors: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums per dimension and the integer scatter n * sum(x x') - (sum x)(sum x)'.

    One scan with a bounded aggregate: what reaches the driver has the size of the matrix. The shift
    of all components by a constant leaves the scatter as it is and is left out of the sums here.
    """
    rows = vectors.select("v").mapInArrow(_scatter_rows, "cell long, limb int, value long")
    sums: dict[int, int] = {}
    for r in rows.groupBy("cell", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("s")).collect():
        sums[r.cell] = sums.get(r.cell, 0) + (int(r.s) << (_LIMB * r.limb))
    n = sums.get(0, 0)
    d = max((math.isqrt(8 * cell + 1) - 1) // 2 for cell in sums) if sums else 0
    cell = lambda i, j: sums.get(i * (i + 1) // 2 + j, 0)
    total = [cell(i + 1, 0) for i in range(d)]
    matrix = [
        [n * cell(max(i, j) + 1, min(i, j) + 1) - total[i] * total[j] for j in range(d)] for i in range(d)
    ]
    return n, total, matrix


def primes_below(top: int):
    """Primes in falling order, by Miller-Rabin; the bases decide all numbers below 3.2e9."""
    for p in range(top - 1 - top % 2, 2, -2):
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):
            x = pow(base, odd, p)
            if x not in (1, p - 1) and not any((x := x * x % p) == p - 1 for _ in range(twos - 1)):
                break
        else:
            yield p


def characteristic_mod(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients, lowest first, of det(x - matrix) modulo a prime below 2^31."""
    n = len(matrix)
    a = np.array([[value % p for value in row] for row in matrix], np.int64).reshape(n, n)
    for k in range(n - 2):  # similar matrix with zeros below the subdiagonal
        below = np.flatnonzero(a[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            a[[k + 1, pivot]] = a[[pivot, k + 1]]
            a[:, [k + 1, pivot]] = a[:, [pivot, k + 1]]
        factor = a[k + 2 :, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2 :] = (a[k + 2 :] - factor[:, None] * a[k + 1] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2 :] * factor % p).sum(axis=1)) % p
    minors = np.zeros((n + 1, n + 1), np.int64)  # characteristic polynomials of leading blocks
    minors[0, 0] = 1
    for k in range(1, n + 1):
        minors[k, 1:] = minors[k - 1, :-1]
        chain, weight = 1, np.zeros(k, np.int64)
        for i in range(k - 1, -1, -1):
            weight[i] = a[i, k - 1] * chain % p
            chain = chain * int(a[i, i - 1]) % p if i else chain
        minors[k] = (minors[k] - (weight[:, None] * minors[:k] % p).sum(axis=0)) % p
    return minors[n].tolist()


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients, lowest first, of det(x - matrix) for a scatter matrix.

    Its roots are not negative and sum up to the trace, so no coefficient is larger than
    (1 + trace / dimension)^dimension. Primes are taken until their product is more than twice that.
    """
    n = len(matrix)
    if not n:
        return [1]
    bound = (2 + sum(matrix[i][i] for i in range(n)) // n) ** n
    primes, product = [], 1
    for p in primes_below(1 << 31):
        primes.append(p)
        product *= p
        if product > 2 * bound + 1:
            break

    def run(batches):
        for batch in batches:
            p = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(p, pa.int64()), pa.array([characteristic_mod(matrix, q) for q in p], pa.list_(pa.int64()))],
                names=["p", "c"],
            )

    dealt = spark.createDataFrame([(p,) for p in primes], "p long").repartition(min(len(primes), 64), "p")
    found = dealt.mapInArrow(run, "p long, c array<long>").collect()
    out, product = [0] * (n + 1), 1
    for r in sorted(found, key=lambda r: r.p):
        step = pow(product, -1, r.p)
        out = [value + product * ((c - value) * step % r.p) for value, c in zip(out, r.c, strict=True)]
        product *= r.p
    return [value - product if 2 * value > product else value for value in out]


def roots_above(c: list[int], a: int) -> int:
    """How many roots are larger than ``a``, with multiplicity; all roots must be real."""
    c = list(c)
    for k in range(len(c) - 1):  # the polynomial in x + a
        for i in range(len(c) - 2, k - 1, -1):
            c[i] += a * c[i + 1]
    signs = [value > 0 for value in c if value]
    return sum(s != t for s, t in zip(signs, signs[1:], strict=False))


def largest_roots(c: list[int], most: int) -> list[tuple[int, int]]:
    """The ``most`` largest roots of a polynomial whose roots are real and not negative.

    A root is (m, s) for m / 2^s, right to ROOT_BITS bits; zero is (0, 0). Repeated roots are
    listed as often as they occur.
    """
    degree = len(c) - 1
    zeros = next((i for i, value in enumerate(c) if value), 0)
    top = 1 + abs(c[-2]) if degree else 0  # the sum of the roots
    found: list[tuple[int, int]] = []
    for rank in range(1, min(most, degree) + 1):
        if rank > degree - zeros:
            found.append((0, 0))
            continue
        scale, scaled, low, high = 0, c, 0, top
        while not low or (high - low) << ROOT_BITS > low:
            if high - low == 1:
                scale += 64
                scaled = [value << (scale * (degree - i)) for i, value in enumerate(c)]
                low, high = low << 64, high << 64
            middle = (low + high) // 2
            if roots_above(scaled, middle) >= rank:
                low = middle
            else:
                high = middle
        found.append((low + high, scale + 1))
    return found


def _solver(matrix: list[list[Decimal]], tiny: Decimal):
    """A function that solves for right-hand sides, by elimination with row exchanges."""
    n = len(matrix)
    rows, order = [list(row) for row in matrix], list(range(n))
    for k in range(n):
        pivot = max(range(k, n), key=lambda i: abs(rows[i][k]))
        rows[k], rows[pivot] = rows[pivot], rows[k]
        order[k], order[pivot] = order[pivot], order[k]
        if abs(rows[k][k]) < tiny:
            rows[k][k] = tiny
        head = rows[k]
        for i in range(k + 1, n):
            row = rows[i]
            if row[k]:
                factor = row[k] = row[k] / head[k]
                for j in range(k + 1, n):
                    row[j] -= factor * head[j]

    def solve(b):
        x = [b[i] for i in order]
        for i in range(n):
            x[i] -= sum((rows[i][j] * x[j] for j in range(i)), Decimal(0))
        for i in range(n - 1, -1, -1):
            x[i] = (x[i] - sum((rows[i][j] * x[j] for j in range(i + 1, n)), Decimal(0))) / rows[i][i]
        return x

    return solve


def components_of(matrix: list[list[int]], roots: list[tuple[int, int]]) -> list[list[float]]:
    """A unit eigenvector for each root, orthogonal to those before it."""
    n, found = len(matrix), []
    largest = max((abs(value) for row in matrix for value in row), default=0)
    with localcontext() as context:
        context.prec, context.Emin, context.Emax = _DIGITS + largest.bit_length() // 3, -999_999, 999_999
        dot = lambda u, v: sum((a * b for a, b in zip(u, v, strict=True)), Decimal(0))
        for m, scale in roots:
            root = Decimal(m) / (1 << scale)
            shifted = [[Decimal(value) - (root if i == j else 0) for j, value in enumerate(row)] for i, row in enumerate(matrix)]
            solve = _solver(shifted, Decimal(max(largest, 1)).scaleb(5 - context.prec))
            # A start that no symmetry of the data makes orthogonal to the component.
            vector = [Decimal(1 + (i * i * 7919 + i * 104729 + len(found) * 31) % 1009) for i in range(n)]
            for turn in range(4):
                vector = solve(vector) if turn else vector
                for _ in range(2):
                    for other in found:
                        part = dot(vector, other)
                        vector = [a - part * b for a, b in zip(vector, other, strict=True)]
                size = dot(vector, vector).sqrt()
                vector = [a / size for a in vector]
            found.append(vector)
    return [[float(a) for a in vector] for vector in found]


@dataclass
class Whitening:
    """n, sums without the shift, components, their roots (n^2 times the variance) and the trace."""

    n: int
    total: list[int]
    vectors: list[list[float]]
    roots: list[tuple[int, int]]
    trace: int

    def share(self, k: int) -> float:
        m, scale = self.roots[k]
        return float(Decimal(m) / (1 << scale) / self.trace) if self.trace else 0.0

    def variance(self, k: int) -> float:
        m, scale = self.roots[k]
        return float(Decimal(m) / (1 << scale) / (self.n * self.n))

    def whiten(self, x: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Per row the whitened coordinates (not a number where a root is 0) and the deviation."""
        n, total = self.n, np.array(self.total, object)
        out = np.full((len(x), len(self.roots)), np.nan)
        largest = n * int(np.abs(x).max(initial=0)) + max((abs(t) for t in self.total), default=0)
        if x.dtype != object and largest * largest * max(x.shape[1], 1) < 1 << 63:
            away = n * x - total.astype(np.int64)
            deviation = (away * away).sum(axis=1).tolist()
        else:
            away = n * x.astype(object) - total
            deviation = [int(s) for s in (away * away).sum(axis=1)] if x.shape[1] else [0] * len(x)
        with localcontext() as context:
            context.prec, context.Emin, context.Emax = _DIGITS, -999_999, 999_999
            for k, (m, scale) in enumerate(self.roots):
                if not m:
                    continue
                size = (Decimal(m) / (1 << scale)).sqrt()
                if away.dtype != object:
                    out[:, k] = away.astype(np.float64) @ np.array(self.vectors[k]) / float(size)
                else:
                    scaled = np.array([[float(Decimal(int(a)) / size) for a in row] for row in away])
                    out[:, k] = scaled.reshape(x.shape) @ np.array(self.vectors[k])
        return out, deviation


def fit_whitening(vectors: DataFrame, components: int = 8, id_column: str = "vec_id", vector_column: str = "embedding") -> Whitening:
    """The principal components of all usable vectors, from their exact scatter matrix."""
    usable = _usable(vectors, id_column, vector_column)
    n, total, matrix = scatter(usable)
    roots = largest_roots(characteristic(vectors.sparkSession, matrix), components)
    return Whitening(n, total, components_of(matrix, roots), roots, sum(matrix[i][i] for i in range(len(matrix))))


def apply_whitening(vectors: DataFrame, model: Whitening, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Per usable row: vec_id, whitened (an array, null where a root is 0), deviation (decimal(38,0)).

    Components that the fit has not seen are left out; a deviation of more than 38 digits is null.
    """
    width = len(model.total)

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, _ROWS):
                part = batch.slice(i, _ROWS)
                x = _integers(pc.list_slice(part.column(1), 0, width), width) if width else np.zeros((part.num_rows, 0), np.int64)
                white, deviation = model.whiten(x)
                flat = pa.array(white.ravel(), pa.float64(), from_pandas=True)
                ends = pa.array(np.arange(len(white) + 1) * white.shape[1], pa.int32())
                exact = [Decimal(s) if s < 10**38 else None for s in deviation]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(ends, flat), pa.array(exact, pa.decimal128(38, 0))],
                    names=["vec_id", "whitened", "deviation"],
                )

    rows = _usable(vectors, id_column, vector_column)
    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, whitened array<double>, deviation decimal(38,0)")


def identity_error(white: DataFrame, components: list[int]) -> float | None:
    """The largest entry of |covariance - identity| over the whitened rows; null without components.

    Spark's population covariance centres each column and merges partial results, so it is one scan.
    """
    pairs = [(i, j) for i in components for j in components if j <= i]
    if not pairs:
        return None
    w = lambda k: F.col("whitened")[k]
    found = white.agg(*[F.covar_pop(w(i), w(j)) for i, j in pairs]).first()
    gaps = [abs(v - (i == j)) for v, (i, j) in zip(found, pairs, strict=True) if v is not None]
    return max(gaps, default=None)


def whitened(vectors: DataFrame, components: int = 8, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """Each vector on the principal components of all of them, each with variance 1.

    Per usable row and component: vec_id, component (from 1, by falling variance), n,
    deviation (decimal, exact), whitened, variance, explained, identity_error.

    Rows whose vector is null or holds null or non-finite entries are left out; ids may be null or
    repeat, each row counts. A shorter vector is filled up with components 0, an empty one too. There are as
    many components as dimensions at most. Where all variance is used up (one row, equal rows, fewer rows
    than components) a component has variance and explained 0 and whitened null; its vector is any unit
    vector orthogonal to the others. Without usable rows, or with empty vectors alone, there is no row.
    Equal variances have a space of components, of which an orthogonal basis is taken. Integers are exact at any
    size; only a deviation of more than 38 digits is null. Coordinates are doubles, so where variances differ
    by more than a double's digits the small ones are lost in rounding. Other columns are not read.
    """
    model = fit_whitening(vectors, components, id_column, vector_column)
    white = apply_whitening(vectors, model, id_column, vector_column)
    real = [k for k, (m, _) in enumerate(model.roots) if m]
    error = identity_error(white, real)
    shares = [F.struct(F.lit(model.variance(k)).alias("variance"), F.lit(model.share(k)).alias("explained")) for k in range(len(model.roots))]
    if not shares:
        return white.limit(0).selectExpr(
            "vec_id", "0 AS component", "0L AS n", "deviation", "0D AS whitened", "0D AS variance",
            "0D AS explained", "0D AS identity_error",
        )
    return white.select(
        "vec_id", "deviation", F.posexplode(F.arrays_zip(F.array(*shares).alias("s"), F.col("whitened").alias("w"))).alias("k", "c")
    ).select(
        "vec_id",
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("c.w").alias("whitened"),
        F.col("c.s.variance").alias("variance"),
        F.col("c.s.explained").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
