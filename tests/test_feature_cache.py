"""The feature cache's key index, filters, broken fills and compaction."""
import os
import random

import pytest
from pyspark.sql import functions as F

from vitrine.operators import features as FE

FACTORY = FE.text_histogram_factory(8)


def plan_of(df):
    return df._jdf.queryExecution().toString()


def fill(spark, rows, cache, **how):
    idx = spark.createDataFrame(rows, "doc_id long, text string, h string")
    return FE.fill_cache(spark, idx, cache, "doc_id", ["text"], FACTORY, "v1", 8, content_hash_col="h", **how)


def current(spark, cache):
    return sorted((r.key or "", r.model_version, r.content_hash or "", r.seq, r.batch_id, tuple(r.features))
                  for r in FE.read_cache(spark, cache).collect())


@pytest.fixture
def stored_docs(spark, tmp_dir):
    path = os.path.join(tmp_dir, "docs")
    (spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"),
                              F.sha1(F.col("id").cast("string").cast("binary")).alias("h")).write.parquet(path))
    return spark.read.parquet(path)


def test_look_up_reads_keys_alone(spark, tmp_dir, stored_docs):
    """Neither vectors nor inputs are in the plan that finds what is missing, and nothing is written."""
    cache = os.path.join(tmp_dir, "cache")
    args = (spark, stored_docs, cache, "doc_id", ["text"], FACTORY, "v1", 8)
    assert FE.fill_cache(*args, content_hash_col="h") == 3000
    for _ in range(2):                       # one fill, then two
        todo = FE.uncached_keys(spark, stored_docs, cache, "doc_id", "v1", content_hash_col="h")
        plan = plan_of(todo)
        scans = [line for line in plan.split("\n") if "ReadSchema" in line]
        assert scans and not any("features" in line or "text" in line for line in scans)
        assert "/vectors/" not in plan and todo.isEmpty()
        before = sorted(os.listdir(os.path.join(cache, "vectors")))
        assert FE.fill_cache(*args, content_hash_col="h") == 0
        assert sorted(os.listdir(os.path.join(cache, "vectors"))) == before
        fill(spark, [(5000, "more", "x")], cache)


def test_inputs_are_fetched_for_misses(spark, tmp_dir, stored_docs):
    cache, asked = os.path.join(tmp_dir, "cache"), []

    def fetch(todo):
        asked.append(sorted(r.doc_id for r in todo.collect()))
        return todo.withColumn("text", F.lit("fetched"))

    def run(df):
        return FE.fill_cache(spark, df.drop("text"), cache, "doc_id", ["text"], FACTORY, "v1", 8, content_hash_col="h", fetch=fetch)

    assert [run(stored_docs.filter("doc_id < 5")), run(stored_docs.filter("doc_id < 7")), run(stored_docs.filter("doc_id < 7"))] == [5, 2, 0]
    assert asked == [list("01234"), ["5", "6"]]


def test_random_fills_against_a_dict(spark, tmp_dir):
    """Fills and compactions in any order: the cache has the last content of every key, null keys and hashes too."""
    rng, cache, known = random.Random(3), os.path.join(tmp_dir, "cache"), {}
    for _ in range(6):
        rows = {}
        for _ in range(rng.randint(1, 12)):
            key = rng.choice([None, *range(12)])
            rows[key] = rng.choice([None, "a", "b", "c"])
        missing = {k for k, h in rows.items() if k not in known or known[k] != h}
        assert fill(spark, [(k, f"{h}-text", h) for k, h in rows.items()], cache) == len(missing)
        known.update(rows)
        if rng.random() < 0.5:
            before = current(spark, cache)
            FE.compact_cache(spark, cache, "v1")
            assert current(spark, cache) == before and len(FE.live_fills(spark, cache)) == 1
        found = FE.read_cache(spark, cache).collect()
        assert {None if r.key is None else int(r.key): r.content_hash for r in found} == known and len(found) == len(known)


def test_compaction_drops_superseded_rows(spark, tmp_dir):
    cache = os.path.join(tmp_dir, "cache")
    for h in "abc":
        fill(spark, [(i, h * 3, h if i < 4 else "same") for i in range(10)], cache)
    FE.add_vectors(spark, spark.createDataFrame([("1", None, [1.0])], "key string, content_hash string, features array<float>"), cache, "v2")
    assert FE.read_cache_rows(spark, cache, model_version="v1").count() == 18
    before = current(spark, cache)
    reader = FE.read_cache(spark, cache)                    # begun before the compaction
    assert FE.compact_cache(spark, cache, "v1") == 8 and FE.compact_cache(spark, cache, "v1") == 0
    assert current(spark, cache) == before and reader.count() == 11
    assert FE.read_cache_rows(spark, cache).count() == 11 and "left_anti" not in plan_of(FE.read_cache(spark, cache)).lower()
    assert FE.drop_replaced(spark, cache) == 3 and len(os.listdir(os.path.join(cache, "vectors"))) == 2
    assert current(spark, cache) == before
    assert fill(spark, [(0, "ddd", "d"), (9, "x", "same")], cache) == 1


def test_broken_fill_is_not_there(spark, tmp_dir, monkeypatch):
    cache = os.path.join(tmp_dir, "cache")
    fill(spark, [(1, "a", "a")], cache)

    def broken(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(FE, "build_filter", broken)
        with pytest.raises(RuntimeError):
            fill(spark, [(1, "b", "b"), (2, "b", "b")], cache)
    assert len(os.listdir(os.path.join(cache, "vectors"))) == 2
    assert [r.content_hash for r in FE.read_cache(spark, cache).collect()] == ["a"]
    assert fill(spark, [(1, "b", "b"), (2, "b", "b")], cache) == 2


def test_filters(spark, monkeypatch):
    """No key of a fill is missed; few others pass; with too small a filter all may."""
    from vitrine.session import ship_package

    ship_package(spark)
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("key"))
    bits = FE.build_filter(keys, 20_000)
    others = spark.range(20_000, 60_000).select(F.col("id").cast("string").alias("key"))
    assert FE.with_filters(keys, "key", [bits]).filter("not _may").isEmpty()
    assert FE.with_filters(others, "key", [bits]).filter("_may").count() < 1_500
    assert FE.with_filters(keys, "key", []).filter("_may").isEmpty()
    monkeypatch.setattr(FE, "MOST_BITS", 1 << 10)
    full = FE.build_filter(keys, 20_000)
    assert len(full) == 128 and FE.with_filters(others, "key", [full, bits]).filter("not _may").isEmpty()


def test_more_fills_than_filters(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(FE, "FILTERS", 1)
    cache = os.path.join(tmp_dir, "cache")
    assert [fill(spark, [(k, "t", "h") for k in ks], cache) for ks in ([1], [1, 2], [1, 2, 3], [3])] == [1, 1, 1, 0]


def test_inputs_are_shuffled_once(spark, stored_docs):
    """With a shuffled semi join too, one exchange at most carries the texts."""
    todo = stored_docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("h").alias("_content_hash"))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        rows = FE._inputs_of(stored_docs, todo, "doc_id", ["text"], "string", "h")
        assert len(rows.collect()) == 3000
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    final = plan[:plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    assert sum("Exchange hashpartitioning" in line for line in final.split("\n")) == 2         # the texts, the keys
