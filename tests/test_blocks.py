"""Scores of many classes from blocks, and the gradient's packed partial sums."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.functions import vectors as V
from vitrine.operators import scoring as SC
from vitrine.operators import training as T


def full(x, w, b, k):
    """All scores, sorted: larger first, of equal ones the higher class."""
    z = x @ w.T + b
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    order = np.lexsort((-np.arange(z.shape[1])[None].repeat(len(z), 0), -p), axis=1)[:, :k]
    return np.take_along_axis(p, order, 1), order


@pytest.mark.parametrize("k", [1, 2, 5, 9, 30])
def test_blocks_against_the_full_softmax(monkeypatch, k):
    monkeypatch.setattr(SC, "CLASSES", 7)
    rng = np.random.default_rng(k)
    for classes in (1, 6, 7, 8, 40):
        x, w, b = rng.normal(size=(50, 3)), rng.normal(size=(classes, 3)) * 20, rng.normal(size=classes)
        w[classes // 2:] = np.round(w[classes // 2:] / 20)           # many equal logits
        b[classes // 2:] = 0
        x[::5] = 0
        own = min(k, classes)
        score, ids = SC.top_scores(x, w, b, own)
        want, at = full(x, w, b, own)
        assert (ids == at).all() and np.allclose(score, want, rtol=1e-12)


def test_fifty_thousand_classes(spark):
    """Equal to the full softmax, and a task holds a block of logits, not 50,000 a row."""
    import tracemalloc

    rng = np.random.default_rng(1)
    w, b = rng.normal(size=(50_000, 16)), rng.normal(size=50_000)
    x = rng.normal(size=(2_000, 16))
    tracemalloc.start()
    for at in range(0, len(x), SC.ROWS):
        SC.top_scores(x[at:at + SC.ROWS], w, b, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 * 8 * SC.ROWS * SC.CLASSES                       # all logits of these rows are 400 MB
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:300])] + [(999, None)], "id long, features array<double>")
    model = SC.SoftmaxModel([str(i) for i in range(50_000)], w, b)
    got = {r.id: r.top for r in SC.score_top(rows, model, 3).collect()}
    want, ids = full(x[:300], w, b, 3)
    assert got.pop(999) is None and len(got) == 300
    for i, top in got.items():
        assert [t.class_id for t in top] == ids[i].tolist() and np.allclose([t.score for t in top], want[i], rtol=1e-12)


def test_top_equals_top_k_of_all_scores(spark):
    rng = np.random.default_rng(3)
    model = SC.fixed_model(["a", "b", "c", "d", "e"], 4)
    rows = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(500)] + [(500, [0.0] * 4), (501, None)],
                                 "id long, features array<float>")
    both = SC.score_top(SC.score(rows, model), model, 3).select("id", "top", V.top_k("probs", 3).alias("all"))
    for r in both.collect():
        assert (r.top is None) == (r.all is None)
        for a, b in zip(r.top or [], r.all or []):
            assert a.class_id == b.class_id and a.score == pytest.approx(b.score, rel=1e-12)


def test_gradient_partials_are_packed(spark, monkeypatch):
    """K = 1,000, D = 2,048: a row for each task and block of classes is shuffled, then one for each block and
    share, and the gradient is that of the whole."""
    rng = np.random.default_rng(2)
    k, d, n = 1000, 2048, 60
    w, b, x, y = rng.normal(size=(k, d)) * 0.01, rng.normal(size=k), rng.normal(size=(n, d)), rng.integers(0, k, n)
    df = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, y)], "features array<double>, true_id int").repartition(4)
    model = SC.SoftmaxModel([str(i) for i in range(k)], w, b)
    seen, added = [], T._added
    monkeypatch.setattr(T, "_added", lambda p, keys: seen.append((keys, p.count())) or added(p, keys))
    grad = np.zeros((k, d + 1))
    for r in T.gradient(df, model).filter("class_id % 100 = 7 or dim = -1").collect():
        grad[r.class_id, r.dim + 1] = r.grad
    blocks = -(-k // T.block_classes(d))
    assert [s for s, _ in seen] == [["block", "share"], ["block"]] and seen[0][1] == 4 * blocks and seen[1][1] == 2 * blocks
    z = x @ w.T + b
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(n), y] -= 1
    want = np.concatenate([p.mean(axis=0)[:, None], p.T @ x / n], axis=1)
    assert np.allclose(grad[:, 0], want[:, 0], atol=1e-12) and np.allclose(grad[7::100], want[7::100], atol=1e-12)
