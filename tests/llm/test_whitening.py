import math
import random
from fractions import Fraction

import numpy as np
import pytest

from vitrine.llm import queries, whitening as w


def slow_polynomial(matrix):
    """Faddeev and LeVerrier's recurrence in fractions; the constant first."""
    d = len(matrix)
    a = [[Fraction(v) for v in row] for row in matrix]
    m, c = [[Fraction(0)] * d for _ in range(d)], [Fraction(0)] * d + [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(d)) + (c[d - k + 1] if i == j else 0) for j in range(d)] for i in range(d)]
        c[d - k] = -sum(a[i][t] * m[t][i] for i in range(d) for t in range(d)) / k
    return [int(v) for v in c]


def gram(rng, d, rank=None, most=50):
    x = rng.integers(-most, most, (rank or d + 3, d)).astype(object)
    return (x.T @ x).tolist()


@pytest.mark.parametrize("d,rank", [(1, None), (2, None), (5, None), (7, 3), (9, None)])
def test_polynomial(spark, d, rank):
    matrix = gram(np.random.default_rng(d), d, rank)
    assert w.polynomial(spark, matrix) == slow_polynomial(matrix)


def test_polynomial_of_sparse_matrices(spark):
    for matrix in ([[0]], [[0, 0], [0, 0]], [[2, 0, 0, 0], [0, 2, 0, 0], [0, 0, 5, 0], [0, 0, 0, 0]],
                   [[5, 0, 0, 2], [0, 4, 0, 0], [0, 0, 4, 0], [2, 0, 0, 5]]):
        assert w.polynomial(spark, matrix) == slow_polynomial(matrix)


def test_primes():
    small = [n for n in range(2, 2000) if all(n % p for p in range(2, math.isqrt(n) + 1))]
    assert [n for n in range(2000) if w.is_prime(n)] == small
    found = w.primes_above(1 << 200)
    assert len(set(found)) == 7 and math.prod(found) > 1 << 200 and not w.is_prime(25326001)


def test_roots():
    roots = [0, 0, 3, 3, 3, 10, 1000, 1001, 10 ** 20]
    poly = [1]
    for x in roots:
        poly = [a - x * b for a, b in zip([0, *poly], [*poly, 0])]
    assert [w.roots_above(poly, x) for x in (-1, 0, 2, 3, 999, 1000, 10 ** 21)] == [9, 7, 7, 4, 3, 2, 0]
    found = [w.isolate(poly, k) for k in range(1, 8)]
    assert [round(Fraction(r, 1 << w.ROOT_BITS)) for r, _, _ in found] == sorted(roots, reverse=True)[:7]
    assert [(p, s) for _, p, s in found] == [(1, 1)] * 4 + [(1, 3), (2, 3), (3, 3)]
    root = w.isolate([1, -4, 1], 1)[0]                 # 2 + sqrt(3)
    assert root == (2 << w.ROOT_BITS) + math.isqrt(3 << 2 * w.ROOT_BITS)


def checked(spark, rows, kept, components=8):
    """The result against eigenvectors in floating point; signs are free, planes of equal roots too."""
    got = w.whiten(rows, components).collect()
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in kept], dtype=object)
    n, s = len(x), x.sum(axis=0)
    centred = (n * x - s).astype(float) / n
    v = centred.T @ centred / n
    values = np.linalg.eigvalsh(v)[::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    by_row = sorted((g.vec_id is not None, g.vec_id, g.deviation, g.component) for g in got)
    want = [(i is not None, i, int(((n * y - s) ** 2).sum()), c) for (i, _), y in zip(kept, x) for c in range(1, k + 1)]
    assert by_row == sorted(want) and {g.n for g in got} == {n}
    white = np.array([[g.whitened for g in got if g.component == c] for c in range(1, k + 1)])
    assert np.abs(np.cov(white, bias=True).reshape(k, k) - np.eye(k)).max() < 1e-9
    share = {g.component: g.explained for g in got}
    assert np.allclose([share[c] for c in range(1, k + 1)], values[:k] / np.trace(v), rtol=1e-10)
    assert len({g.identity_error for g in got}) == 1 and got[0].identity_error < 1e-9
    return got


def plain(rows):
    """All but the error, whose last digit depends on the order of a sum."""
    return sorted(tuple(x)[:-1] for x in rows)


def test_given_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    kept = [(x.vec_id, x.embedding) for x in rows.collect()]
    got = checked(spark, rows, kept)
    assert len(got) == 8 * len(kept)
    assert plain(got) == plain(queries.op13_whitening(spark, "/root/testdata/sf0.001").collect())


SCHEMA = "vec_id long, embedding array<float>, whitened string, component string, deviation string, n string, _at string, label int"


def test_edges(spark):
    rng = random.Random(4)
    vectors = [[rng.gauss(0, 1) for _ in range(5)] + [0.5] for _ in range(60)]
    for v in vectors:
        v[4] = v[3]                                          # a repeated and a constant dimension
    kept = [*enumerate(vectors), (3, vectors[3]), (3, vectors[9]), (None, vectors[1])]
    kept = [(i, np.array(v, np.float32).tolist()) for i, v in kept]
    odd = [(70, None), (71, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (72, [float("nan")] * 6), (73, [float("inf")] + [0.0] * 5), (74, [-float("inf")] * 6)]
    rows = spark.createDataFrame([(i, v, *"abcde", 1) for i, v in [*kept, *odd]], SCHEMA)
    got = checked(spark, rows, kept)
    assert {g.component for g in got} == {1, 2, 3, 4}


def test_equal_eigenvalues(spark):
    """Three directions of one variance: the vectors taken are orthogonal, and the same in each run."""
    points = [[s * 2.0 if i == j else 0.0 for j in range(4)] for i in range(3) for s in (1, -1)] + [[0.0, 0.0, 0.0, 9.0], [0.0, 0.0, 0.0, -9.0]]
    rows = spark.createDataFrame([(i, v, *"abcde", 1) for i, v in enumerate(points)], SCHEMA)
    kept = list(enumerate(points))
    got = checked(spark, rows, kept)
    assert plain(got) == plain(w.whiten(rows).collect())


def test_no_components(spark):
    for vectors in ([], [[1.0, 2.0]], [[1.0, 2.0]] * 3, [[]], [None]):
        rows = spark.createDataFrame([(i, v, *"abcde", 1) for i, v in enumerate(vectors)], SCHEMA)
        assert w.whiten(rows).collect() == []


def test_lengths_must_agree(spark):
    rows = spark.createDataFrame([(1, [1.0, 2.0], *"abcde", 1), (2, [1.0], *"abcde", 1)], SCHEMA)
    with pytest.raises(Exception, match="entries|lengths"):
        w.whiten(rows).collect()


def test_large_entries_are_exact(spark):
    rng = random.Random(2)
    kept = [(i, [float(np.float32(rng.uniform(-2 ** 29, 2 ** 29))) for _ in range(3)]) for i in range(40)]
    rows = spark.createDataFrame([(i, v, *"abcde", 1) for i, v in kept], SCHEMA)
    model = w.fit(rows.select("vec_id", rows["embedding"].cast("array<double>").alias("v")))
    x = np.array([[math.floor(1024 * c) for c in v] for _, v in kept], dtype=object)
    s = x.sum(axis=0)
    want = {i: int(((40 * y - s) ** 2).sum()) for (i, _), y in zip(kept, x)}
    got = {r.vec_id: r.deviation for r in w.project(rows.select("vec_id", rows["embedding"].cast("array<double>").alias("v")), model).collect()}
    assert got == {i: v if v < 1 << 63 else None for i, v in want.items()}
