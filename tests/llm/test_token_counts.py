import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vitrine.llm import token_counts as t
from vitrine.session import scratch_path


def library(path):
    if path.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda x: len(model.encode(x or ""))
    model = Tokenizer.from_file(path)
    return lambda x: len(model.encode(x or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_and_cache(spark, edge_docs, empty_docs, name):
    path, cache = public_tokenizers.path(name), scratch_path(spark, "cache")
    count = library(path)
    half = edge_docs.filter("doc_id < 5")
    t.token_counts(half, path, cache).count()
    first = spark.read.parquet(cache)
    assert first.count() == half.select("text").na.fill("").distinct().count()
    rows = t.token_counts(edge_docs, path, cache, limit=8)
    want = sorted(((r.doc_id, len((r.text or "").encode()), count(r.text), count(r.text) > 8) for r in edge_docs.collect()), key=str)
    assert sorted(map(tuple, rows.collect()), key=str) == want
    every = spark.read.parquet(cache)
    assert every.count() == edge_docs.select("text").na.fill("").distinct().count()       # only misses were added
    t.token_counts(edge_docs, path, cache).count()
    assert spark.read.parquet(cache).count() == every.count()
    assert t.token_counts(empty_docs, path, scratch_path(spark, "cache")).count() == 0


def test_another_version_is_not_met(spark, edge_docs, monkeypatch):
    path, cache = public_tokenizers.path("byte_bpe_50k.json"), scratch_path(spark, "cache")
    t.token_counts(edge_docs, path, cache).count()
    n = spark.read.parquet(cache).count()
    monkeypatch.setattr(t, "tokenizer_version", lambda p: "other")
    t.token_counts(edge_docs, path, cache).count()
    assert spark.read.parquet(cache).count() == 2 * n


def test_special_strings(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert t.counter(path)(["<|endoftext|>", "a<|endoftext|>b", ""]) == [1, 3, 0]


def test_cache_errors_are_not_swallowed(spark, edge_docs):
    with pytest.raises(Exception, match="UNSUPPORTED|No FileSystem|scheme"):
        t.token_counts(edge_docs, public_tokenizers.path("byte_bpe_50k.json"), "nostore://x/y").count()
