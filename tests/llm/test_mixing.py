import hashlib
import math
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from vitrine.llm import mixing as m
from vitrine.llm import queries


def row_key(*values):
    return hashlib.md5("\x1f".join("null" if v is None else str(v) for v in values).encode()).hexdigest()


def slow(rows, rates, seed=m.SEED):
    out = []
    for doc_id, source in rows:
        name = row_key(doc_id, source)
        u = int(hashlib.md5(f"{seed}:count:{name}".encode()).hexdigest()[:13], 16) * 2.0 ** -52
        k, p = 0, math.exp(-rates[source])
        total = p
        while u >= total and k < 1000:
            k += 1
            p *= rates[source] / k
            total += p
        out += [(doc_id, source, c) for c in range(k)]
    return out


def test_against_slow(spark, edge_docs):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "source")
    for given, weights in ((docs, None), (docs, {"src0": 5, "src1": 1, "src2": 0.1}), (edge_docs.select("doc_id", "source"), None)):
        rows = [tuple(r) for r in given.collect()]
        n = Counter(s for _, s in rows)
        share = {s: c ** 0.5 if weights is None else weights.get(s, 0) for s, c in n.items()}
        rates = {s: min(64, len(rows) * share[s] / sum(share.values()) / n[s]) for s in n}
        got = m.mix_sources(given, weights=weights).collect()
        assert Counter((r.doc_id, r.source, r.copy) for r in got) == Counter(slow(rows, rates))
        assert all(abs(r.rate - rates[r.source]) < 1e-9 for r in got)


@pytest.mark.parametrize("rate", [0.0, 1e-9, 0.3, 1.0, 7.5, 64.0])
def test_distribution(spark, rate):
    steps = spark.range(1).select(m.poisson_steps(F.lit(rate)).alias("s")).first().s
    total, p = [], math.exp(-rate)
    for k in range(len(steps)):
        p = p * rate / k if k else p
        total.append(p + (total[-1] if total else 0))
    assert steps == pytest.approx(total, abs=1e-15) and steps[-1] >= 1 - 1e-12


def test_mean_and_order(spark):
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("source"))
    mixed = m.mix_sources(docs, weights={"a": 0.5, "b": 0.5}).collect()
    n = Counter(r.source for r in mixed)
    assert abs(n["a"] - 20_000) < 500 and abs(n["b"] - 20_000) < 700
    first = Counter(r.source for r in mixed[:10_000])           # every stretch has the mixture
    assert abs(first["a"] - 5_000) < 300
    ids = [r.doc_id for r in mixed]
    assert sum(a < b for a, b in zip(ids, ids[1:])) < 0.52 * len(ids)


def test_many_sources_take_the_shuffle_join(spark, monkeypatch):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") > 5, F.concat(F.lit("s"), F.col("id") % 50)).alias("source"))
    want = Counter(map(tuple, m.mix_sources(docs).collect()))
    monkeypatch.setattr(m, "BROADCAST_SOURCES", 3)
    assert Counter(map(tuple, m.mix_sources(docs).collect())) == want


def test_edge_rows(spark, edge_docs, empty_docs):
    mixed = m.mix_sources(edge_docs, size=3.0)
    assert mixed.columns == [*edge_docs.columns, "_copy", "_rate"]
    assert m.mix_sources(empty_docs).count() == 0 and m.mix_sources(edge_docs, weights={"none": 1.0}).count() == 0
    assert m.mix_sources(edge_docs, weights={}).count() == 0


def test_native(spark):
    plan = queries.op8_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def against_sql(spark, docs, tmp_path):
    """The rows of the mixture, which are those of the SQL."""
    docs.select("doc_id", "text", "source").coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.sql(f"create view given as select * from '{tmp_path}/d/*.parquet'")
    rows = con.sql(f"select doc_id, text, source, copy, round(rate, 6) from ({queries.mixing_sql(('doc_id', 'text', 'source'), 'given')})").fetchall()
    mixed = m.mix_sources(docs.select("doc_id", "text", "source"))
    got = [(r.doc_id, r.text, r.source, r.copy, round(r.rate, 6)) for r in mixed.collect()]
    assert sorted(got, key=str) == sorted(rows, key=str)
    return got


def test_sql_with_nulls(spark, edge_docs, tmp_path):
    against_sql(spark, edge_docs, tmp_path)


def test_sql_of_rates_above_a_part(spark, tmp_path):
    """One row of a source beside many of another: it is repeated about 150 times."""
    docs = spark.range(20_001).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") < 1, "one").otherwise("many").alias("source"))
    got = against_sql(spark, docs, tmp_path)
    assert {r[4] for r in got if r[2] == "one"} == {round(20_001 / (1 + 20_000 ** 0.5), 6)} and sum(r[2] == "one" for r in got) > 2 * m.MAX_RATE - 40


def test_rows_without_an_id_are_drawn_each_for_itself(spark):
    """Of a source without ids, and of one that has one id, the target weights come out; no task gets more than
    twice the median, and the order is global."""
    docs = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id")).alias("doc_id"),
                                      F.col("id").cast("string").alias("text"), F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("source"))
    weights = {"s0": 0.6, "s1": 0.3, "s2": 0.1}
    mixed = m.mix_sources(docs, weights=weights)
    n = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    for source, share in weights.items():
        assert abs(n[source] - share * 30_000) < 5 * (share * 30_000) ** 0.5
    sizes = sorted(r["count"] for r in mixed.groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 8 and sizes[-1] < 2 * sizes[4]
    order = [int(hashlib.md5(f"{m.SEED}:order:{row_key(r.doc_id, r.text, r.source)}:{r.copy}".encode()).hexdigest()[:13], 16) for r in mixed.collect()]
    assert order == sorted(order)


def test_rates_above_a_part(spark):
    """A small source reaches its share whatever number of repetitions that takes."""
    docs = spark.range(20_020).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 20, "small").otherwise("large").alias("source"))
    mixed = m.mix_sources(docs, weights={"small": 0.5, "large": 0.5})
    rate = 20_020 * 0.5 / 20
    rows = mixed.filter("source = 'small'").select("doc_id", "copy", "rate").collect()
    assert rate > 7 * m.MAX_RATE and {round(r.rate, 6) for r in rows} == {round(rate, 6)}
    assert abs(len(rows) - 10_010) < 500                        # five standard deviations
    steps = {x: spark.range(1).select(m.poisson_steps(F.lit(x)).alias("s")).first().s for x in (64.0, rate - 7 * 64)}

    def drawn(purpose, left):
        u = int(hashlib.md5(f"{m.SEED}:{purpose}".encode()).hexdigest()[:13], 16) * 2.0 ** -52
        return sum(s <= u for s in steps[left])
    key = {i: row_key(i, "small") for i in range(20)}
    want = {i: drawn(f"count:{key[i]}", rate - 7 * 64) + sum(drawn(f"part:{k}:{key[i]}", 64.0) for k in range(1, 8)) for i in range(20)}
    assert Counter((r.doc_id, r.copy) for r in rows) == Counter((i, c) for i, n in want.items() for c in range(n))


def test_parts_are_poisson(spark):
    docs = spark.range(4_000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"))
    for rate in (64.0, 130.0):
        n = [r["count"] for r in m.mix_sources(docs, size=rate).groupBy("doc_id").count().collect()]
        mean = sum(n) / 4_000
        assert abs(mean - rate) < 5 * (rate / 4_000) ** 0.5
        assert sum((x - mean) ** 2 for x in n) / 4_000 == pytest.approx(rate, rel=0.12)
