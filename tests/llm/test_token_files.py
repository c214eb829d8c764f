import heapq
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vitrine.llm import queries, token_files as tf
from vitrine.session import scratch_path

PATH = public_tokenizers.path(queries.WORD_TOKENIZER)


@pytest.fixture(scope="module")
def library():
    model = Tokenizer.from_file(PATH)
    return lambda text: model.encode(text or "", add_special_tokens=False).ids + [queries.END_ID]


def slow_lengths(counts, most):
    """Package-merge on lists of symbols; plain Huffman sums are at most as large without a limit."""
    leaves = sorted((c, [s]) for s, c in enumerate(counts) if c)
    row = leaves
    for _ in range(most - 1):
        pairs = [(a[0] + b[0], a[1] + b[1]) for a, b in zip(row[::2], row[1::2])]
        row = sorted(leaves + pairs, key=lambda x: x[0])
    out = [0] * len(counts)
    for _, symbols in row[:2 * len(leaves) - 2]:
        for s in symbols:
            out[s] += 1
    return out


def huffman_size(counts):
    heap, total = [c for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


@pytest.mark.parametrize("most", [4, 6, 16])
def test_lengths(most):
    rng = random.Random(most)
    for _ in range(60):
        counts = [rng.choice([0, 1, 1, 2, 3, 5, 8, 400, 10 ** 9]) for _ in range(rng.randint(2, 16))]
        if sum(c > 0 for c in counts) < 2:
            continue
        bits = tf.code_lengths(np.array(counts), most)
        size = sum(c * int(b) for c, b in zip(counts, bits))
        assert size == sum(c * b for c, b in zip(counts, slow_lengths(counts, most)))
        assert bits.max() <= most and sum(2.0 ** -int(b) for b in bits if b) == 1
        if most == 16:
            assert size == huffman_size(counts)
    assert tf.code_lengths(np.array([0, 7, 0])).tolist() == [0, 1, 0] and not tf.code_lengths(np.zeros(3, int)).any()
    with pytest.raises(ValueError):
        tf.code_lengths(np.ones(17, int), 4)


def test_codes_are_canonical():
    bits = np.array([3, 1, 0, 3, 2], np.uint8)
    codes = tf.canonical_codes(bits)
    assert [format(int(c), f"0{b}b") for c, b in zip(codes, bits) if b] == ["110", "0", "111", "10"]


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000, 1_200_000])
def test_pack_and_unpack(n):
    rng = np.random.default_rng(n)
    counts = np.zeros(3000, int)
    counts[:1500] = rng.zipf(1.2, 1500) % 10 ** 6 + 1
    bits = tf.code_lengths(counts)
    ids = rng.choice(1500, n, p=counts[:1500] / counts.sum()).astype(np.uint32)
    payload, marks = tf.pack(ids, tf.canonical_codes(bits), bits)
    if n < 6000:                             # the bits as a string, one code at a time
        codes = tf.canonical_codes(bits)
        text = "".join(format(int(codes[i]), f"0{bits[i]}b") for i in ids)
        assert payload == int(text.ljust(-(-len(text) // 8) * 8, "0") or "0", 2).to_bytes(-(-len(text) // 8), "big")
    table = tf.decoding_table(bits)
    assert (tf.unpack(np.frombuffer(payload, np.uint8), marks, n, table) == ids).all()
    block = tf.Block(tf.build_block(3, 4, 99, [(5, ids[:n // 2]), (None, ids[n // 2:])], tf.canonical_codes(bits), bits))
    assert (block.shard, block.number, block.start, block.lengths.tolist()) == (3, 4, 99, [n // 2, n - n // 2])
    for low, high in ((0, n), (n // 3, n // 2), (max(0, n - 2), n + 9), (256, 512), (511, 513)):
        assert (block.ids(table, low, high) == ids[low:high]).all()


def test_damage_is_seen():
    bits = np.array([1, 1], np.uint8)
    data = bytearray(tf.build_block(0, 0, 0, [(1, np.array([0, 1], np.uint32))], tf.canonical_codes(bits), bits))
    data[-6] ^= 1
    with pytest.raises(ValueError):
        tf.Block(bytes(data))


HOSTILE = ["a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>", "é ́x a b c　d", "don't WE'LL I'D 'tis it's",
           "\t\n\r\x0b\x0c\x1c\x1d\x85 x", "각 Å İ Σσς", "1,234.50%% ---- ...", "x" * 9000,
           "\U0001f469‍\U0001f4bb and 你好", "<|endoftext|", "|>", " ", "ß ﬁ ǅ"]


def ids_of(model, texts):
    ids, sizes = model.ids(pa.array(texts, pa.string()))
    return [x.tolist() + [queries.END_ID] for x in np.split(ids, np.cumsum(sizes)[:-1])]


def test_pieces_against_whole_texts(library):
    model = tf.Encoder(PATH)
    assert model.by_piece and not tf.Encoder(public_tokenizers.path(queries.TOKENIZER)).by_piece
    rng = random.Random(1)
    texts = HOSTILE + ["".join(rng.choice(HOSTILE)[:rng.randint(1, 20)] + rng.choice(["", " ", "\n", "'"]) for _ in range(30))
                       for _ in range(200)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 0x2ff), rng.randint(0x300, 0xd7ff), rng.randint(0x10000, 0x1ffff), 32])) for _ in range(60))
              for _ in range(200)]
    texts += ["".join(rng.choice("abXYZ019.,'!#-_<|>\" \t\x0b\x1c\x7f") for _ in range(80)) for _ in range(300)]
    texts += ["J\u030cA\u0301 h\u0331H\u0331 i\u0307I\u0307", "", "   "]
    assert ids_of(model, texts) == [library(t) for t in texts]
    assert ids_of(tf.Encoder(public_tokenizers.path(queries.TOKENIZER)), ["a b", ""])[1] == [queries.END_ID]


def test_few_pieces_held(library, monkeypatch):
    monkeypatch.setattr(tf, "PIECES_HELD", 20)
    model = tf.Encoder(PATH)
    texts = [f"word{i % 31} and {i % 7}, more" for i in range(300)]
    for at in range(0, 300, 10):
        assert ids_of(model, texts[at:at + 10]) == [library(t) for t in texts[at:at + 10]]


def slow_rows(rows, library):
    out, at = [], 0
    for doc_id, text in rows:
        ids = library(text)
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_given_table(spark, library):
    rows = sorted(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect())
    got = queries.op11_token_files(spark, "/root/testdata/sf0.001").orderBy("start").collect()
    assert [tuple(x) for x in got] == slow_rows(rows, library)


def test_edges(spark, edge_docs, library, monkeypatch):
    monkeypatch.setattr(tf, "BLOCK_IDS", 500)
    monkeypatch.setattr(tf, "BLOCKS_A_FILE", 2)
    path = scratch_path(spark, "ids")
    tf.write_ids(edge_docs, path, PATH, 2)
    tie = F.xxhash64(F.coalesce("text", F.lit("")))
    rows = edge_docs.orderBy(F.asc_nulls_first("doc_id"), tie).select("doc_id", "text").collect()
    got = tf.read_checksums(spark, path).orderBy("start").collect()
    assert [tuple(x) for x in got] == slow_rows(rows, library)
    every = [i for _, t in rows for i in library(t)]
    assert [i for x in tf.read_ids(spark, path).orderBy("start").collect() for i in x.ids] == every
    parts = tf.read_range(spark, path, 700, 150_000).orderBy("start").collect()
    assert parts[0].start == 700 and [i for x in parts for i in x.ids] == every[700:150_000]
    assert not tf.read_range(spark, path, 5, 5).collect()
    code = {x.id: x["count"] for x in spark.read.parquet(f"{path}/code").collect()}
    assert code == {i: every.count(i) for i in set(every)}


def test_empty(spark, empty_docs):
    path = scratch_path(spark, "ids")
    tf.write_ids(empty_docs, path, PATH, 2)
    assert tf.read_checksums(spark, path).collect() == [] and tf.read_ids(spark, path).collect() == []


def test_hot_id_spreads(spark):
    """A third of the rows with one id, all alike, and a third without an id: about equal shards."""
    df = spark.range(24_000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("doc_id"),
                                    F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    rows = df.select("doc_id", F.coalesce("doc_id", F.lit(tf.NULL_ID)).alias("at"), F.xxhash64("text").alias("tie"),
                     F.monotonically_increasing_id().alias("salt"))
    sizes = sorted(x["count"] for x in tf._dealt(rows, tf.shard_bounds(rows, 8), []).groupBy("shard").count().collect())
    assert len(sizes) == 8 and sizes[-1] < 2 * sizes[4]
