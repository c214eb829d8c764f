"""Token counts through a digest cache.

A text's key is the SHA-256 of its normalised content, and the cache has a row (tokenizer, digest,
n_tokens) for each content that some version of a tokenizer has counted. A run joins its distinct
digests to the cache, encodes the texts it doesn't find there, once each, and appends their counts.

Normalising may not change a count. These tokenizers see every byte, so it only makes null the empty
text. The version is the digest of the tokenizer's file and of the library's version: another file or
library never meets old counts.
"""
from __future__ import annotations

import hashlib
import os

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, id_and_text, strings

CACHE_SCHEMA = "tokenizer string, digest string, n_tokens long"
LIMIT = 512


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file and the library that reads it."""
    library = _library(path)
    module = __import__(library)
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + f"{library} {module.__version__}".encode()).hexdigest()[:32]


def _library(path: str) -> str:
    kinds = {".json": "tokenizers", ".model": "sentencepiece"}
    kind = os.path.splitext(path)[1]
    if kind not in kinds:
        raise ValueError(f"no library for {path}: {', '.join(kinds)} are known")
    return kinds[kind]


def counter(path: str):
    """A function from texts to their numbers of tokens, without begin, end or other added tokens."""
    if _library(path) == "sentencepiece":
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(model.encode(t)) for t in texts]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"       # one thread per task
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()

    def count(texts: list[str]) -> list[int]:
        out = []
        for at in range(0, len(texts), 32):              # encodings are many times their text
            out += [len(e) for e in model.encode_batch_fast(texts[at:at + 32], add_special_tokens=False)]
        return out
    return count


def read_cache(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer version; none where the folder doesn't exist yet."""
    try:
        cache = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        cache = spark.createDataFrame([], CACHE_SCHEMA)
    # two runs at once may both have appended a content: their counts are equal
    return cache.filter(F.col("tokenizer") == version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def add_misses(docs: DataFrame, cache_path: str, tokenizer_path: str) -> None:
    """Encode each distinct content that the cache doesn't have, and append its count.

    Copies fold into one row before the shuffle, so a text that a third of the rows share is one row
    per task. The vocabulary file goes to the executors as a Spark file.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer_path)
    name = os.path.basename(tokenizer_path)
    spark.sparkContext.addFile(tokenizer_path)
    texts = (docs.groupBy("digest").agg(F.first("content").alias("text"))
             .join(read_cache(spark, cache_path, version), "digest", "left_anti"))

    def setup():
        count = counter(SparkFiles.get(name))
        return lambda part: [pa.array(count(strings(part.column("text"))), pa.int64())]

    counted = add_columns(texts, setup, [T.StructField("n_tokens", T.LongType())], keep=["digest"])
    (counted.select(F.lit(version).alias("tokenizer"), "digest", "n_tokens")
     .write.mode("append").parquet(cache_path))


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row, counted through the cache at ``cache_path``.

    Null texts are empty and have no tokens. Repeated rows come back as often; a null doc_id stays
    null. An empty table gives none. Other columns are not looked at.
    """
    content = id_and_text(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("content"))
    content = content.withColumn("digest", F.sha2(F.col("content").cast("binary"), 256))
    add_misses(content, cache_path, tokenizer_path)
    cache = read_cache(docs.sparkSession, cache_path, tokenizer_version(tokenizer_path))
    rows = content.select("doc_id", "digest", F.octet_length("content").cast("long").alias("n_bytes"))
    return rows.join(cache, "digest").select("doc_id", "n_bytes", "n_tokens",
                                             (F.col("n_tokens") > limit).alias("over_limit"))
