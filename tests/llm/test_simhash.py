import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vitrine.llm import simhash
from vitrine.llm.components import connected_components


def slow_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words, at = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            if at:
                words.append(at)
            at = ""
        else:
            at += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, bits):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(fps))]


@pytest.mark.parametrize("text", ["", "One", "a B\tc\nd", "É é A z\x0b\x0cq " * 40, "x x x x x x"])
def test_fingerprint_against_slow(text):
    assert simhash.fingerprint(text.encode()) == slow_fingerprint(text)


def test_spark_hash_is_the_shingle_hash(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", seed=42)


def test_every_link_shares_a_key():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2 ** 64, 4000, dtype=np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(64, i % 4, replace=False):
            y[i] ^= np.uint64(1) << np.uint64(b)
    kx, rx = simhash.lookup_keys(x)
    ky, ry = simhash.lookup_keys(y)
    shared = set(zip(rx.tolist(), kx.tolist())) & set(zip(ry.tolist(), ky.tolist()))
    assert len({r for r, _ in shared}) == len(x)


def crowd(n, seed, spread):
    """Fingerprints in clusters: chains and dense balls."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n // spread):
        base = int(rng.integers(0, 2 ** 63))
        for _ in range(spread):
            base ^= sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False))
            out.append(base)
    return out


@pytest.mark.parametrize("run_max", [4096, 3])
@pytest.mark.parametrize("bits", [3, 2])
def test_components_against_all_pairs(spark, run_max, bits, monkeypatch):
    fps = crowd(240, run_max, 12)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    given = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, shingle: given)
    got = {r.doc_id: r.component_id for r in simhash.simhash_groups(given, max_bits=bits, run_max=run_max).collect()}
    roots = components(fps, bits)
    smallest = {}
    for i, r in enumerate(roots):
        smallest.setdefault(r, i)
    assert got == {i: smallest[r] for i, r in enumerate(roots)}


def test_long_runs_over_several_batches(spark):
    """A run of equal keys longer than an Arrow batch and than run_max: every member is kept for dense_links."""
    rows = [(k, i) for k, n in ((1, 1), (2, 70), (3, 2), (4, 1), (5, 40)) for i in range(n)]
    keyed = spark.createDataFrame(rows, "key long, fp long").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        found = simhash.bucket_links(keyed, 3, 50).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {r.a for r in found if r.b is None} == set(range(70))


def test_chain_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100, 160)] + [(7, 3), (3, 9)], "a long, b long")
    got = {r.node: r.label for r in connected_components(edges).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {7: 3, 3: 3, 9: 3}


def test_edge_rows(spark, edge_docs, empty_docs):
    rows = simhash.simhash_groups(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.fp, r.component_id))
    assert by[2] == by[3] == by[4] == {(0, 2)}               # no words: fingerprint zero, linked
    assert {c for _, c in by[7]} == {1} and len(by[1]) == 1
    assert (0, 2) in by[None]
    assert simhash.simhash_groups(empty_docs).count() == 0
    kept = simhash.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 7 not in ids and 3 not in ids and ids.count(None) == 2
    assert simhash.drop_near_duplicates(empty_docs).count() == 0
