"""Quality by importance resampling over hashed n-grams.

Words and punctuation runs, and pairs of neighbours, are hashed into ``BUCKETS``; all pairs of a word
and itself are one n-gram, so that repetition is learned whatever is repeated. Two generative
models are bags of these: the raw model counts every document, the target model the documents that
are labelled good. A document's importance weight is the ratio of its probabilities under the two,
so its log is a sum over its n-grams. Gumbel top-k then samples without replacement in proportion to
the weights: k documents with the largest log weight plus a Gumbel variable from a hash of the id.

The target model is fitted on at most ``TARGET_ROWS`` labelled rows, those of the smallest hashes, and
the cut that gives k on as many others; the
raw counts and the scores cover whole texts of all documents. k is found exactly by four counting
passes over 16 bits each of the keys, so no list of keys is sorted in one place.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, best_cut, free_name, slices, stored, strings

BUCKETS = 1 << 14
TARGET_ROWS = 20_000
TOKEN = re.compile(r"\w+|[^\w\s]+")
SEED = 7


class Hashes(dict):
    """CRC-32 of words, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = out = crc32(word.encode())
        return out


def ngram_buckets(text: str, hashes: Hashes, buckets: int = BUCKETS) -> np.ndarray:
    """Bucket of each word and each pair of neighbours."""
    words = TOKEN.findall(text)
    one = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    two = one[:-1] * np.uint64(0x9E3779B1) + one[1:] * np.uint64(0x85EBCA77) + np.uint64(1)
    two[one[:-1] == one[1:]] = 0
    both = np.concatenate([one, two])
    # the high bits of a product by an odd constant: 0 to 2 ** 20 - 1, then to the buckets
    return (((both * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)) % np.uint64(buckets)).astype(np.int64)


def ngram_counts(docs: DataFrame, target_ids: DataFrame, id_col: str, text_col: str, buckets: int = BUCKETS) -> np.ndarray:
    """[raw counts, target counts]: over all documents, and over those in ``target_ids`` (bounded)."""
    marked = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
              .join(F.broadcast(target_ids.select(F.col("doc_id").alias("target_id")).distinct()),
                    F.col("doc_id") == F.col("target_id"), "left")
              .select("text", F.col("target_id").isNotNull().alias("target")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, total = Hashes(), np.zeros((2, buckets), np.int64)
        for batch in batches:
            for part in slices(batch):
                for text, target in zip(strings(part.column(0)), part.column(1).to_pylist()):
                    own = np.bincount(ngram_buckets(text, hashes, buckets), minlength=buckets)
                    total[0] += own
                    if target:
                        total[1] += own
        some = np.flatnonzero(total[0])
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[0, some]),
                                              pa.array(total[1, some])], names=["bucket", "raw", "target"])

    parts = marked.mapInArrow(run, "bucket int, raw long, target long")
    out = np.zeros((2, buckets), np.int64)
    for bucket, raw, target in parts.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect():
        out[:, bucket] = raw, target          # at most one row per bucket
    return out


def log_ratios(counts: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """log(target probability / raw probability) of each bucket, both smoothed."""
    p = (counts + smooth) / (counts.sum(axis=1, keepdims=True) + smooth * counts.shape[1])
    return np.log(p[1]) - np.log(p[0])


def add_log_weight(docs: DataFrame, ratios: np.ndarray, column: str, text_col: str = "text",
                   keep: list[str] | None = None) -> DataFrame:
    """``docs`` with each text's log importance weight; 0 for a null or empty text."""
    table = docs.sparkSession.sparkContext.broadcast(ratios)         # one number per bucket

    def setup():
        hashes, ratio = Hashes(), table.value
        return lambda part: [pa.array([float(ratio[ngram_buckets(t, hashes, len(ratio))].sum())
                                       for t in strings(part.column(text_col))], pa.float64())]

    return add_columns(docs, setup, [T.StructField(column, T.DoubleType())], text_col, keep)


TARGET_FIFTHS, CUT_FIFTHS = (1, 2, 3), (4,)


def learnable(labels: DataFrame, label: str, rows: int, fifths: tuple[int, ...]) -> DataFrame:
    """(doc_id, label) of at most ``rows`` labelled documents, those of the smallest hashes, of some
    fifths by the CRC-32 of the id's text; fifth 0 is held out from all learning. A document with more
    than one label has the largest."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
             .filter("doc_id is not null and label is not null")
             .filter((F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5).isin(*fifths)))
    return (known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
            .groupBy("doc_id").agg(F.max("label").alias("label")))


def quality_ratios(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   rows: int = TARGET_ROWS, buckets: int = BUCKETS) -> np.ndarray:
    """Log ratio of each bucket: documents labelled good against all documents."""
    good = learnable(labels, "quality", rows, TARGET_FIFTHS).filter("label = 1")
    return log_ratios(ngram_counts(docs, good, id_col, text_col, buckets))


def gumbel(key: Column, seed: int = SEED) -> Column:
    """A standard Gumbel variable from a hash of ``key``."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 12).cast("double") + 0.5) * F.lit(2.0 ** -52)
    return -F.log(-F.log(u))


def kth_largest(df: DataFrame, column: str, k: int) -> int | None:
    """The k-th largest value of a long column (its smallest if k is larger; None for no value or k = 0)."""
    if k <= 0:
        return None
    sign = F.col(column).bitwiseXOR(F.lit(-(1 << 63)))       # order of unsigned numbers
    prefix, left = F.lit(True), k
    out = 0
    for shift in (48, 32, 16, 0):
        digit = F.shiftrightunsigned(sign, shift).bitwiseAND(F.lit(0xFFFF))
        found = sorted(df.filter(prefix & F.col(column).isNotNull()).groupBy(digit.alias("d")).count().collect(), reverse=True)
        if not found:                                        # at most 65,536 rows
            return None
        for d, n in found:
            if left <= n or (d, n) == tuple(found[-1]):
                break
            left -= n
        out = out << 16 | d
        prefix = F.shiftrightunsigned(sign, shift) == F.lit(out if out < 1 << 63 else out - (1 << 64))
    return (out ^ (1 << 63)) - (1 << 64) if (out ^ (1 << 63)) >> 63 else out ^ (1 << 63)


FIXED_POINT = 1 << 20


def sample_weights(scored: DataFrame, weight: str, id_col: str, k: int, seed: int = SEED,
                   key: str = "gumbel_key") -> DataFrame:
    """The rows with the k largest keys, log weight plus Gumbel variable, to a millionth; rows that tie
    with the k-th stay too, so a row that repeats an id stays or goes with its copies."""
    keyed = scored.withColumn(key, F.col(weight) + gumbel(F.col(id_col).cast("long"), seed))
    rank = free_name(keyed, "rank")
    whole = F.floor(F.col(key) * F.lit(float(FIXED_POINT))).cast("long")
    least = kth_largest(keyed.select(whole.alias(rank)), rank, k)
    return keyed.filter(F.lit(False) if least is None else whole >= F.lit(least))


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int | None = None,
             rows: int = TARGET_ROWS, buckets: int = BUCKETS, seed: int = SEED, keep: list[str] | None = None,
             weight: str = "log_weight", key: str = "gumbel_key") -> DataFrame:
    """The sampled rows: columns ``keep`` (default: the id) with the log weight and the Gumbel key.

    ``size`` is k. Without it k is the number of documents above the weight that best parts the rows
    labelled 1 from those labelled 0, among rows that the target model wasn't fitted to; if either kind
    is missing, all documents.
    A null or empty text has log weight 0. Repeated rows of an id share a key and stay or go together;
    rows with a null id do too. An empty table gives none. Names that clash are the caller's to choose,
    by ``weight`` and ``key``.
    """
    keep = [id_col] if keep is None else keep
    ratios = quality_ratios(docs, labels, id_col, text_col, rows, buckets)
    base = docs.select(*dict.fromkeys([*keep, id_col, text_col]))
    scored = stored(add_log_weight(base, ratios, weight, text_col, list(dict.fromkeys([*keep, id_col]))), "quality")
    if size is None:
        known = learnable(labels, "quality", rows, CUT_FIFTHS)
        own = scored.select(F.col(id_col).cast("long").alias("doc_id"), F.col(weight).alias("weight"))
        pairs = own.join(F.broadcast(known), "doc_id").distinct()            # at most `rows` documents
        cut = best_cut([(r.weight, r.label) for r in pairs.collect()])
        size = scored.count() if cut is None else scored.filter(F.col(weight) >= cut).count()
    return sample_weights(scored, weight, id_col, size, seed, key).select(*keep, weight, key)


def drop_low_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that ``resample`` draws, unchanged."""
    weight = free_name(docs, "log_weight")
    key = free_name(docs, "gumbel_key")
    return resample(docs, labels, id_col, text_col, keep=docs.columns, weight=weight, key=key, **how).select(docs.columns)
