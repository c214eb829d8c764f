"""Embedding whitening from an exact characteristic polynomial.

Entries become integers, ``floor(1024 c) + 100000``, so sums over all vectors are exact. With n vectors x
and sums S, the scatter n sum(x x') - S S' is an integer matrix, n * n times the covariance. Its
characteristic polynomial is found modulo many 31-bit primes, by reduction to Hessenberg form, a prime to a
task's turn, and put together by Chinese remaindering: as many primes as the coefficients' bound needs.
All its roots are real, so Descartes' rule counts the roots above a number exactly; bisection parts the
largest roots and goes on to ``ROOT_BITS`` bits behind the point. A component is the null vector of the
scatter less its root, by inverse iteration in fixed-point numbers of ``SOLVE_BITS`` bits; roots that stay
together share a null space, which is spanned by orthogonal vectors.

What reaches the driver has the size of the scatter, not of the table.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction
from math import comb, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
ROOT_BITS = 256
SOLVE_BITS = 512
LARGEST = float(1 << 30)                     # of an entry, so that sums of squares fit 38 digits
SLICE = 4096                                 # vectors multiplied at once


# ---- integers and their sums

def kept_rows(embeddings: DataFrame, vector_col: str = "embedding") -> Column:
    v = F.col(vector_col)
    return v.isNotNull() & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(ids, integers less ``SHIFT``) of slices of rows; vectors of a slice have one length."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            own = part.column(1)
            sizes = np.diff(own.offsets.to_numpy())
            if len(sizes) and sizes.min() != sizes.max():
                raise ValueError(f"vectors of {sizes.min()} and of {sizes.max()} entries")
            flat = own.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            if len(flat) and np.abs(flat).max() >= LARGEST:
                raise ValueError(f"an entry of {LARGEST:.0f} or more")
            yield part.column(0), np.floor(flat * SCALE).astype(np.int64).reshape(len(sizes), -1)


def _products(x: np.ndarray) -> np.ndarray:
    """x'x as Python integers: in floating point where every sum is below 2 ** 53."""
    most = int(np.abs(x).max()) if x.size else 0
    if most * most * len(x) < 1 << 53:
        wide = x.astype(np.float64)
        return (wide.T @ wide).astype(np.int64).astype(object)
    wide = x.astype(object)
    return wide.T @ wide


def moments(vectors: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, sums of products) of the rows' integers less ``SHIFT``. A task gives one row for each pair of
    dimensions; an aggregation adds them up."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, None, None
        for _, x in _vectors(batches):
            if sums is None:
                sums, products = np.zeros(x.shape[1], object), np.zeros((x.shape[1],) * 2, object)
            if x.shape[1] != len(sums):
                raise ValueError(f"vectors of {len(sums)} and of {x.shape[1]} entries")
            n += len(x)
            sums = sums + x.sum(axis=0).astype(object)
            products = products + _products(x)
        if n:
            d = len(sums)
            cells = [(-1, -1, n), (-1, d, n)] + [(-1, i, sums[i]) for i in range(d)]
            cells += [(i, j, products[i, j]) for i in range(d) for j in range(i, d)]
            i, j, s = zip(*cells)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                              pa.array([Decimal(int(v)) for v in s], pa.decimal128(38, 0))], names=["i", "j", "s"])

    cells = (vectors.mapInArrow(fold, "i int, j int, s decimal(38,0)").groupBy("i", "j").agg(F.sum("s").alias("s"))).collect()
    found = {(i, j): int(s) for i, j, s in cells}
    n = found.pop((-1, -1), 0)
    d = max((j for i, j in found if i < 0), default=0)
    if n and found.get((-1, d)) != n:
        raise ValueError("vectors of several lengths")
    return n, [found[-1, i] for i in range(d)], [[found[min(i, j), max(i, j)] for j in range(d)] for i in range(d)]


def scatter(n: int, sums: list[int], products: list[list[int]]) -> list[list[int]]:
    """n * n times the covariance. A shift of all vectors leaves it as it is."""
    return [[n * q - a * b for q, b in zip(row, sums)] for row, a in zip(products, sums)]


# ---- the characteristic polynomial

def is_prime(n: int) -> bool:
    """Miller and Rabin's test with bases that decide every n below 2 ** 31."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_above(bound: int) -> list[int]:
    """The largest 31-bit primes, until their product is above the bound."""
    out, product, p = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def polynomial_mod(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients of det(x - matrix) modulo p, the constant first."""
    h = np.array([[v % p for v in row] for row in matrix], np.int64)
    d = len(h)
    for k in range(d - 2):                   # similar to a Hessenberg matrix, a column at a time
        below = np.flatnonzero(h[k + 1:, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        h[[k + 1, pivot]] = h[[pivot, k + 1]]
        h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        u = h[k + 2:, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2:, k:] = (h[k + 2:, k:] - u[:, None] * h[k + 1, k:] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2:] * u % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)           # of the leading minors
    polys[0, 0] = 1
    for k in range(d):
        new = -polys[k] * int(h[k, k]) % p
        new[1:] += polys[k, :-1]
        if k:
            weights, run = np.zeros(k, np.int64), 1
            for i in range(k - 1, -1, -1):
                run = run * int(h[i + 1, i]) % p
                weights[i] = run * int(h[i, k]) % p
            new -= (weights[:, None] * polys[:k] % p).sum(axis=0) % p
        polys[k + 1] = new % p
    return polys[d].tolist()


def polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients of det(x - matrix), the constant first, for a matrix without negative eigenvalues."""
    d = len(matrix)
    mean = -(-sum(matrix[i][i] for i in range(d)) // d) if d else 0
    # the k-th elementary symmetric function is at most that of equal numbers
    primes = primes_above(2 * max(comb(d, k) * mean ** k for k in range(d + 1)))
    ship_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([primes[i]]), pa.array([polynomial_mod(matrix, primes[i])], pa.list_(pa.int64()))],
                                                 names=["p", "c"])

    tasks = min(len(primes), spark.sparkContext.defaultParallelism)
    found = spark.range(0, len(primes), 1, tasks).mapInArrow(run, "p long, c array<long>").collect()
    total = 1
    for p in primes:
        total *= p
    out = [0] * (d + 1)
    for p, rest in found:
        other = total // p
        unit = other * pow(other, -1, p)
        for i, r in enumerate(rest):
            out[i] = (out[i] + r * unit) % total
    return [c - total if c > total // 2 else c for c in out]


# ---- roots

def scaled(poly: list[int], bits: int) -> list[int]:
    """The polynomial of the roots times 2 ** bits."""
    d = len(poly) - 1
    return [c << bits * (d - i) for i, c in enumerate(poly)]


def roots_above(poly: list[int], x: int) -> int:
    """How many roots, each as often as it is one, lie above x: for a polynomial with real roots alone the
    changes of sign among the coefficients about x."""
    c = list(poly)
    for i in range(len(c) - 1):
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += x * c[j + 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def sign_at(poly: list[int], x: int) -> int:
    value = 0
    for c in reversed(poly):
        value = value * x + c
    return (value > 0) - (value < 0)


def isolate(poly: list[int], k: int, bits: int = ROOT_BITS) -> tuple[int, int, int]:
    """(root times 2 ** bits, rounded down; place in its cluster; cluster's size) of the k-th largest root,
    from 1, of a polynomial whose roots are real and not negative."""
    low, high, step = -1, max(1, abs(poly[-2])), 0       # in (low, high] times 2 ** -step; the trace bounds the roots
    above_low, above_high = roots_above(poly, low), 0
    here = poly
    while above_low - above_high > 1 and step < bits:    # other roots share the interval
        if high - low == 1:
            more = min(32, bits - step)
            step, low, high = step + more, low << more, high << more
            here = scaled(poly, step)
        middle = (low + high) // 2
        above = roots_above(here, middle)
        if above >= k:
            low, above_low = middle, above
        else:
            high, above_high = middle, above
    size = above_low - above_high
    if size > 1:
        return low, k - above_high, size
    low, high = low << bits - step, high << bits - step
    here = scaled(poly, bits)
    at_high = sign_at(here, high)
    if not at_high:
        return high, 1, 1
    while high - low > 1:                    # one root: the sign tells its side
        middle = (low + high) // 2
        sign = sign_at(here, middle)
        if not sign:
            return middle, 1, 1
        if sign == at_high:
            high = middle
        else:
            low = middle
    return low, 1, 1


# ---- components

def null_vectors(matrix: list[list[int]], root: int, bits: int, size: int, rounds: int = 3) -> list[list[int]]:
    """``size`` orthogonal vectors, in fixed point, that the matrix less the root (times 2 ** -bits) makes least
    of: by inverse iteration from fixed starts. Pivots are chosen by size; one that vanishes is the least unit."""
    d, one = len(matrix), 1 << SOLVE_BITS
    a = [[v << SOLVE_BITS for v in row] for row in matrix]
    for i in range(d):
        a[i][i] -= root << SOLVE_BITS - bits
    order = list(range(d))
    for k in range(d):
        pivot = max(range(k, d), key=lambda i: abs(a[i][k]))
        a[k], a[pivot] = a[pivot], a[k]
        order[k], order[pivot] = order[pivot], order[k]
        if not a[k][k]:
            a[k][k] = 1
        for i in range(k + 1, d):
            if a[i][k]:
                factor = (a[i][k] << SOLVE_BITS) // a[k][k]
                head = a[k]
                a[i] = a[i][:k] + [factor] + [v - (factor * h >> SOLVE_BITS) for v, h in zip(a[i][k + 1:], head[k + 1:])]

    def solve(b: list[int]) -> list[int]:
        y = [b[i] for i in order]
        for i in range(d):
            y[i] -= sum(f * v for f, v in zip(a[i][:i], y)) >> SOLVE_BITS
        for i in range(d - 1, -1, -1):
            y[i] = ((y[i] << SOLVE_BITS) - sum(f * v for f, v in zip(a[i][i + 1:], y[i + 1:]))) // a[i][i]
        return y

    def unit(y: list[int], others: list[list[int]]) -> list[int]:
        for _ in range(2):
            norm = isqrt(sum(v * v for v in y)) or 1
            y = [(v << SOLVE_BITS) // norm for v in y]
            for o in others:
                part = sum(v * w for v, w in zip(y, o)) >> SOLVE_BITS
                y = [v - (part * w >> SOLVE_BITS) for v, w in zip(y, o)]
        norm = isqrt(sum(v * v for v in y)) or 1
        return [(v << SOLVE_BITS) // norm for v in y]

    starts = np.random.default_rng(7).integers(1, 1 << 30, (size, d)).tolist()
    found: list[list[int]] = []
    for start in starts:
        y = unit([v << SOLVE_BITS - 30 for v in start], found)
        for _ in range(rounds):
            y = unit(solve(y), found)
        found.append(y)
    return found


@dataclass
class Whitening:
    """n, the sums of the integers less ``SHIFT``, and for each component the eigenvalue of the covariance,
    its share of the trace, and the unit vector."""

    n: int
    sums: list[int]
    values: list[float]
    shares: list[float]
    vectors: list[list[float]]


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The largest components of positive variance of ``vectors(id, vector)``; see ``whiten``."""
    spark = vectors.sparkSession
    ship_package(spark)
    n, sums, products = moments(vectors)
    matrix = scatter(n, sums, products)
    poly = polynomial(spark, matrix)
    zeros = next(i for i, c in enumerate(poly) if c)     # how often zero is a root
    wanted = min(components, len(matrix) - zeros)
    if not wanted:
        return Whitening(n, sums, [], [], [])
    trace = sum(matrix[i][i] for i in range(len(matrix)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                root, place, size = isolate(poly, k)
                y = null_vectors(matrix, root, ROOT_BITS, size)[place - 1]
                exact = Fraction(2 * root + 1, 2 << ROOT_BITS)
                yield pa.RecordBatch.from_pylist([{
                    "k": k, "value": float(exact / (n * n)), "share": float(exact / trace),
                    "vector": [float(Fraction(v, 1 << SOLVE_BITS)) for v in y]}])

    rows = sorted(spark.range(1, wanted + 1, 1, wanted)
                  .mapInArrow(run, "k long, value double, share double, vector array<double>").collect())
    return Whitening(n, sums, [r["value"] for r in rows], [r["share"] for r in rows], [list(r["vector"]) for r in rows])


# ---- rows

def project(vectors: DataFrame, model: Whitening) -> DataFrame:
    """(id, deviation, whitened array): the exact sum of squares of n * x - S (null where a long can't hold it),
    and x - S / n on each component over the root of its eigenvalue."""
    id_col = vectors.columns[0]
    sums, n = model.sums, model.n
    axes = np.array(model.vectors, np.float64).reshape(len(model.vectors), len(sums)).T / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _vectors(batches):
            most = n * (int(np.abs(x).max()) if x.size else 0) + max(map(abs, sums), default=0)
            kind = np.int64 if most * most * max(1, len(sums)) < 1 << 63 else object
            apart = x.astype(kind) * n - np.array(sums, kind)
            squares = [int(v) if v < 1 << 63 else None for v in (apart * apart).sum(axis=1)]
            white = (apart.astype(np.float64) / n) @ axes
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(squares, pa.int64()), pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1, dtype=np.int32) * axes.shape[1]), pa.array(white.reshape(-1)))],
                names=[id_col, "deviation", "whitened"])

    kind = vectors.schema[id_col].dataType.simpleString()
    return vectors.mapInArrow(run, f"`{id_col}` {kind}, deviation long, whitened array<double>")


def identity_error(projected: DataFrame, components: int) -> float:
    """The largest entry, without sign, of the whitened vectors' covariance less the identity, centred first."""
    each = [F.get("whitened", F.lit(i)) for i in range(components)]
    means = projected.agg(*[F.avg(c) for c in each]).first()
    centred = [c - F.lit(m) for c, m in zip(each, means)]
    off = [F.abs(F.avg(centred[i] * centred[j]) - F.lit(float(i == j))) for i in range(components) for j in range(i, components)]
    return max(projected.agg(*off).first())


def whiten(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for each row and component, from 1.

    Rows whose vector is null, or holds a null or a number that is not finite, are left out. Vectors of several
    lengths, or entries of 2 ** 30 and more, are refused. Components without variance are not there: fewer
    than ``components`` where the vectors span fewer dimensions, and none (no rows) for an empty table, empty
    vectors, or equal vectors alone. Equal eigenvalues share their plane; the vectors taken in it are the same in
    every run. Repeated rows and ids, null ids included, come back as often. Other columns are not looked at.
    Very long vectors cost their dimension's cube for each prime and component.
    """
    kept = embeddings.filter(kept_rows(embeddings, vector_col)).select(id_col, F.col(vector_col).cast("array<double>").alias("_vector"))
    kind = embeddings.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(kept, components)
    k = len(model.values)
    if not k:
        return embeddings.sparkSession.createDataFrame([], schema)
    projected = stored(project(kept, model), "whitened")
    error = identity_error(projected, k)
    shares = F.array(*map(F.lit, model.shares))
    return projected.select(id_col, F.posexplode("whitened").alias("_at", "_w"), "deviation").select(
        id_col, (F.col("_at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        F.col("_w").alias("whitened"), F.get(shares, F.col("_at")).alias("explained"), F.lit(error).alias("identity_error"))
