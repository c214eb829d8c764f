import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import common
from vitrine.llm import quality as q


def slow_buckets(text, buckets=q.BUCKETS):
    words = re.findall(r"\w+|[^\w\s]+", text)
    one = [crc32(w.encode()) for w in words]
    grams = one + [0 if a == b else (a * 0x9E3779B1 + b * 0x85EBCA77 + 1) % 2 ** 64 for a, b in zip(one, one[1:])]
    return [(g * 0x9E3779B97F4A7C15 % 2 ** 64 >> 44) % buckets for g in grams]


TEXT = "Hello, hello!! wörld wörld 日本 -- a_b 12 12 12\n"


def test_buckets_against_slow():
    for t in ("", "x", TEXT, TEXT * 50):
        assert q.ngram_buckets(t, q.Hashes()).tolist() == slow_buckets(t)


def test_whole_query_against_slow(spark):
    at = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    fifth = {r.doc_id: crc32(str(r.doc_id).encode()) % 5 for r in labels.collect()}
    known = {r.doc_id: r.quality for r in labels.collect()}
    raw, target = Counter(), Counter()
    for i, t in texts.items():
        own = Counter(slow_buckets(t))
        raw += own
        if known.get(i) == 1 and fifth[i] in (1, 2, 3):
            target += own
    def p(c):
        return np.array([(c[b] + 1) / (sum(c.values()) + q.BUCKETS) for b in range(q.BUCKETS)])
    ratio = np.log(p(target)) - np.log(p(raw))
    weight = {i: ratio[slow_buckets(t)].sum() for i, t in texts.items()}
    cut = common.best_cut([(weight[i], y) for i, y in known.items() if fifth[i] == 4])
    keys = {r.doc_id: r.g for r in docs.select("doc_id", q.gumbel(F.col("doc_id")).alias("g")).collect()}
    k = sum(w >= cut for w in weight.values())
    want = sorted(texts, key=lambda i: -(weight[i] + keys[i]))[:k]
    got = q.resample(docs, labels).collect()
    assert {r.doc_id for r in got} == set(want)
    assert all(abs(r.log_weight - weight[r.doc_id]) < 1e-6 for r in got)


def test_held_out_accuracy(spark):
    at = "/root/testdata/sf0.1"                           # about 2,000 rows for the target model
    docs, labels = spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")
    kept = {r.doc_id for r in q.resample(docs, labels).collect()}
    held = [(r.doc_id in kept) == (r.quality == 1) for r in labels.collect() if crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 500 and np.mean(held) > 0.99


@pytest.mark.parametrize("seed", range(3))
def test_kth_largest(spark, seed):
    rng = np.random.default_rng(seed)
    values = [int(v) for v in rng.choice([-2 ** 63, -5, -1, 0, 1, 7, 2 ** 40, 2 ** 63 - 1, 65535, 65536, -65536], 60)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    for k in (1, 2, 30, 60):
        assert q.kth_largest(df, "v", k) == sorted(values, reverse=True)[k - 1]
    assert q.kth_largest(df, "v", 100) == min(values) and q.kth_largest(df, "v", 0) is None
    assert q.kth_largest(df.filter("false"), "v", 3) is None


def test_gumbel(spark):
    rows = np.array([r.g for r in spark.range(20_000).select(q.gumbel(F.col("id")).alias("g")).collect()])
    assert abs(rows.mean() - 0.5772) < 0.03 and abs(rows.var() - np.pi ** 2 / 6) < 0.08


def test_sample_is_proportional(spark):
    """One drawn of two, many times: the odds are the weights'."""
    hits = 0
    for seed in range(60):
        rows = spark.range(2).select("id", (F.col("id") * float(np.log(4))).alias("w"))
        hits += q.sample_weights(rows, "w", "id", 1, seed).first().id
    assert 36 <= hits <= 58                               # 48 expected of 60


def test_best_cut():
    assert common.best_cut([(0.0, 0), (1.0, 1)]) == 0.5
    assert common.best_cut([(0.0, 1), (1.0, 1)]) is None and common.best_cut([]) is None
    assert common.best_cut([(0.0, 0), (0.0, 1), (2.0, 1)]) == 1.0


def test_edge_rows(spark, edge_docs, empty_docs):
    labels = spark.createDataFrame([(1, 1), (5, 1), (2, 0), (10, 0), (None, 1), (3, None), (99, 1)], "doc_id long, quality int")
    kept = q.drop_low_quality(edge_docs, labels)
    assert kept.columns == edge_docs.columns and kept.count() > 0
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(7) in (0, 2)
    every = q.drop_low_quality(edge_docs, labels.filter("false"))
    assert every.count() == edge_docs.count()             # no labels: nothing to go by, all stay
    assert q.drop_low_quality(empty_docs, labels).count() == 0
    assert q.resample(edge_docs, labels, size=1, weight="w", key="g").count() >= 1
    assert q.resample(edge_docs, labels, size=0, weight="w", key="g").count() == 0
