"""Feature vectors: pluggable extraction and an incremental cache.

Below the cache's folder, a fill is three things, written in this order:

``vectors/fill=<id>/``   (key, model_version, content_hash, batch_id, seq, features)
``keys/fill=<id>/``      the same rows without their vectors: the index that fills look keys up in
``fills/``               one row (fill, model_version, seq, rows, bits, replaces): the fill is there from now
                         on. ``bits`` is a Bloom filter of its keys, at most ``MOST_BITS`` bits whatever the
                         fill's size.

A fill that broke off has no row in ``fills`` and is never read. ``seq`` counts the fills of a model
version; a key's current row is the one of the largest, and ``read_cache`` returns these alone. Filling
computes the index rows that have no current row, or one of another content: running it again computes
nothing, adding images computes only those, and an image that changes back is computed again. Only keys
and content hashes are read to find that out; inputs are read for rows that are computed, vectors never.
``compact_cache`` writes the current rows of all fills as one fill, which replaces them.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_folder, ship_package, stored


# extractor: pandas frame of input columns -> (n x dim) float array
Extractor = Callable[[pd.DataFrame], np.ndarray]
_LOADED: dict[str, Extractor] = {}


def _factory_key(name: str, factory: Callable[[], Extractor], dim: int) -> str:
    """Identity of a loaded model: the factory's pickled form, with all that it closes over."""
    return hashlib.sha256(cloudpickle.dumps((name, dim, factory))).hexdigest()


def _loaded(key: str, factory: Callable[[], Extractor]) -> Extractor:
    """Load a model once per Python worker process (workers are reused across tasks)."""
    if key not in _LOADED:
        _LOADED[key] = factory()
    return _LOADED[key]


def extract_features(df: DataFrame, factory: Callable[[], Extractor], name: str,
                     key_col: str, input_cols: list[str], dim: int,
                     keep_cols: list[str] | None = None) -> DataFrame:
    """(key, *keep_cols, features array<float>) for every row of df, computed in Arrow
    batches; ``keep_cols`` pass through unchanged (no join back)."""
    ship_package(df.sparkSession)
    keep = [c for c in (keep_cols or []) if c != key_col]
    schema = ", ".join([f"{c} {df.schema[c].dataType.simpleString()}" for c in [key_col, *keep]]
                       + ["features array<float>"])
    key = _factory_key(name, factory, dim)

    def run(batches):
        fn = _loaded(key, factory)
        for pdf in batches:
            if len(pdf) == 0:
                continue
            vecs = np.asarray(fn(pdf[input_cols]), dtype=np.float32).reshape(len(pdf), dim)
            out = pdf[[key_col, *keep]].copy()
            out["features"] = list(vecs)
            yield out

    cols = list(dict.fromkeys([key_col, *input_cols, *keep]))
    return df.select(*cols).mapInPandas(run, schema)


def text_histogram_factory(dim: int = 64) -> Callable[[], Extractor]:
    """Deterministic stand-in extractor for tests: byte histogram of the whole text (or
    of raw image bytes), folded to ``dim`` buckets and normalised by length."""
    def factory() -> Extractor:
        def fn(pdf: pd.DataFrame) -> np.ndarray:
            data = [t if isinstance(t, (bytes, bytearray)) else (t or "").encode("utf-8") for t in pdf.iloc[:, 0]]
            size = np.array([len(t) for t in data], dtype=np.int64)
            raw = np.frombuffer(b"".join(data), dtype=np.uint8) % dim
            cell = np.repeat(np.arange(len(data)) * dim, size) + raw
            counts = np.bincount(cell, minlength=len(data) * dim).reshape(len(data), dim)
            return counts / np.maximum(size, 1)[:, None]
        return fn
    return factory


def missing_keys(index: DataFrame, cache: DataFrame, index_key: str, cache_key: str) -> DataFrame:
    """Index rows without a cached vector (left anti join)."""
    c = cache.select(F.col(cache_key).alias(index_key))
    return index.join(c, index_key, "left_anti")


KEY_COLUMNS = "key {key_type}, model_version string, content_hash string, batch_id string, seq bigint"
FILLS_SCHEMA = "fill string, model_version string, seq bigint, rows bigint, bits binary, replaces array<string>"
BITS_A_KEY, MOST_BITS, PROBES = 12, 1 << 23, 4
FILTERS = 64                                 # fills whose filters are tried; with more, every key is looked up


def live_fills(spark: SparkSession, path: str, model_version: str | None = None, bits: bool = False) -> list:
    """Rows (fill, model_version, seq, rows[, bits]) of the fills that no compaction has replaced, by seq: a few
    numbers for each. Only a missing folder counts as an empty cache."""
    try:
        fills = spark.read.schema(FILLS_SCHEMA).parquet(f"{path}/fills")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    if model_version is not None:
        fills = fills.filter(F.col("model_version") == model_version)
    rows = fills.select("fill", "model_version", "seq", "rows", "replaces", *(["bits"] if bits else [])).collect()
    gone = {f for r in rows for f in r["replaces"] or []}
    return sorted((r for r in rows if r["fill"] not in gone), key=lambda r: (r["seq"], r["fill"]))


def _read_fills(spark: SparkSession, path: str, what: str, fills: list, schema: str) -> DataFrame:
    if not fills:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{what}/fill={r['fill']}" for r in fills])


def read_keys(spark: SparkSession, path: str, key_type: str = "string", model_version: str | None = None) -> DataFrame:
    """The key index: every row of the live fills, without vectors."""
    return _read_fills(spark, path, "keys", live_fills(spark, path, model_version), KEY_COLUMNS.format(key_type=key_type))


def read_cache_rows(spark: SparkSession, path: str, key_type: str = "string", model_version: str | None = None) -> DataFrame:
    """Every row of the live fills with its vector, superseded ones too."""
    schema = KEY_COLUMNS.format(key_type=key_type) + ", features array<float>"
    return _read_fills(spark, path, "vectors", live_fills(spark, path, model_version), schema)


def _newest(keys: DataFrame) -> DataFrame:
    """(key, model_version, _newest(seq, batch_id, content_hash), _rows)."""
    return keys.groupBy("key", "model_version").agg(
        F.max(F.struct("seq", "batch_id", "content_hash")).alias("_newest"), F.count(F.lit(1)).alias("_rows"))


def read_cache(spark: SparkSession, path: str, key_type: str = "string",
               model_version: str | None = None) -> DataFrame:
    """The current row of each key and model version (of two fills of one number, that of the larger batch id).

    Vectors are not shuffled: superseded rows are found in the key index and left out by an anti join, which
    the planner broadcasts while they are few; with one fill a version there are none."""
    rows = read_cache_rows(spark, path, key_type, model_version)
    versions = [r["model_version"] for r in live_fills(spark, path, model_version)]
    if len(versions) == len(set(versions)):
        return rows
    keys = read_keys(spark, path, key_type, model_version)
    many = _newest(keys).filter("_rows > 1").select(F.col("key").alias("_key"), F.col("model_version").alias("_version"), "_newest")
    old = (keys.join(many, F.col("key").eqNullSafe(F.col("_key")) & (F.col("model_version") == F.col("_version")))
           .filter(F.struct("seq", "batch_id", "content_hash") < F.col("_newest"))
           .select("_key", "_version", F.col("seq").alias("_seq"), F.col("batch_id").alias("_batch")))
    return rows.join(old, F.col("key").eqNullSafe(F.col("_key")) & (F.col("model_version") == F.col("_version"))
                     & (F.col("seq") == F.col("_seq")) & (F.col("batch_id") == F.col("_batch")), "left_anti")


# ---- Bloom filters of keys

def _probes(first: np.ndarray, second: np.ndarray, size: int) -> np.ndarray:
    """Places of each key in a filter of ``size`` bits, a power of two."""
    step = np.arange(PROBES, dtype=np.uint64)[:, None]
    return (first.view(np.uint64) + step * (second.view(np.uint64) | np.uint64(1))) & np.uint64(size - 1)


def _two_hashes(key: str) -> list:
    return [F.xxhash64(key).alias("_h1"), F.xxhash64(F.lit("second"), key).alias("_h2")]


def build_filter(keys: DataFrame, rows: int) -> bytes:
    """A filter of the keys: each task gives the words it sets, which an aggregation joins. It has a power
    of two of bits, ``MOST_BITS`` at most; a larger fill's filter lets more keys pass to the look-up."""
    size = min(MOST_BITS, 1 << max(10, (rows * BITS_A_KEY - 1).bit_length()))

    def run(batches):
        bits = np.zeros(size, bool)
        for batch in batches:
            bits[_probes(batch.column(0).to_numpy(), batch.column(1).to_numpy(), size)] = True
        words = np.packbits(bits).view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at])], names=["at", "word"])

    out = np.zeros(size // 64, np.int64)
    for at, word in (keys.select(*_two_hashes("key")).mapInArrow(run, "at long, word long")
                     .groupBy("at").agg(F.bit_or("word")).collect()):
        out[at] = word
    return out.tobytes()


def with_filters(keys: DataFrame, key_col: str, filters: list[bytes]) -> DataFrame:
    """The keys with ``_may``: false where no filter has the key."""
    names = keys.columns
    hashed = keys.select(*names, *_two_hashes(key_col))

    def run(batches):
        sets = [np.unpackbits(np.frombuffer(f, np.uint8)) for f in filters]
        for batch in batches:
            h1, h2 = (batch.column(len(names) + i).to_numpy() for i in (0, 1))
            may = np.zeros(batch.num_rows, bool)
            for bits in sets:
                may |= bits[_probes(h1, h2, len(bits))].all(axis=0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(may)], names=[*names, "_may"])

    return hashed.mapInArrow(run, T.StructType([*keys.schema.fields, T.StructField("_may", T.BooleanType())]))


# ---- filling

def uncached_keys(spark: SparkSession, index: DataFrame, cache_path: str, key_col: str, model_version: str,
                  key_type: str = "string", content_hash_col: str | None = None) -> DataFrame:
    """(key_col, _content_hash) of the index keys without a current row for this model version (and, with
    ``content_hash_col``, of this content). A NULL hash is a content, and a NULL key a key. A key that the
    index has more than once is taken once, with the smallest hash. Of the index only these two columns are
    read, of the cache only its key index; keys that no fill's filter has are not looked up there."""
    ship_package(spark)
    chash = F.col(content_hash_col).cast("string") if content_hash_col else F.lit(None).cast("string")
    keyed = (index.select(F.col(key_col).cast(key_type).alias(key_col), chash.alias("_content_hash"))
             .groupBy(key_col).agg(F.min("_content_hash").alias("_content_hash")))
    fills = live_fills(spark, cache_path, model_version, bits=True)
    if not fills:
        return keyed
    keys = _read_fills(spark, cache_path, "keys", fills, KEY_COLUMNS.format(key_type=key_type))
    cached = keys.select("key", "content_hash") if len(fills) == 1 else _newest(keys).select("key", "_newest.content_hash")
    cached = cached.withColumnsRenamed({"key": "_key", "content_hash": "_cached"})
    same = F.col(key_col).eqNullSafe(F.col("_key"))
    if content_hash_col:
        same = same & F.col("_content_hash").eqNullSafe(F.col("_cached"))
    if len(fills) > FILTERS:
        return keyed.join(cached, same, "left_anti")
    flagged = with_filters(keyed, key_col, [bytes(r["bits"]) for r in fills])
    known = flagged.filter("_may").join(cached, same, "left_anti")
    return flagged.filter("not _may").union(known).drop("_may")


def _commit(spark: SparkSession, path: str, fill: str, model_version: str, seq: int, key_type: str, replaces: list[str]) -> int:
    """Write the key index of a fill's vectors, then the row that makes it one. Returns its number of rows."""
    schema = KEY_COLUMNS.format(key_type=key_type)
    here = [{"fill": fill}]
    _read_fills(spark, path, "vectors", here, schema).write.parquet(f"{path}/keys/fill={fill}")
    keys = _read_fills(spark, path, "keys", here, schema)
    rows = keys.count()
    row = (fill, model_version, seq, rows, bytearray(build_filter(keys, rows)), replaces)
    spark.createDataFrame([row], FILLS_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/fills")
    return rows


def add_vectors(spark: SparkSession, vectors: DataFrame, cache_path: str, model_version: str, key_type: str = "string",
                batch_id: str | None = None) -> int:
    """Append ready vectors (key, content_hash, features), keys distinct, as one fill. Returns their number."""
    import uuid

    ship_package(spark)
    fill = uuid.uuid4().hex
    seq = 1 + max((r["seq"] for r in live_fills(spark, cache_path, model_version)), default=0)
    (vectors.select(F.col("key").cast(key_type).alias("key"), F.lit(model_version).alias("model_version"),
                    F.col("content_hash").cast("string").alias("content_hash"), F.lit(batch_id or fill).alias("batch_id"),
                    F.lit(seq).cast("bigint").alias("seq"), F.col("features").cast("array<float>").alias("features"))
     .write.parquet(f"{cache_path}/vectors/fill={fill}"))
    return _commit(spark, cache_path, fill, model_version, seq, key_type, [])


def _inputs_of(index: DataFrame, todo: DataFrame, key_col: str, input_cols: list[str], key_type: str,
               content_hash_col: str | None) -> DataFrame:
    """(key_col, _content_hash, *input_cols), a row for each of ``todo``. Join and grouping are by the same
    columns, none of which is null, so inputs are shuffled once."""
    chash = F.col(content_hash_col).cast("string") if content_hash_col else F.lit(None).cast("string")
    ids = ["_key", "_no_key", "_hash", "_no_hash"]

    def with_ids(df: DataFrame) -> DataFrame:
        return df.withColumns({"_key": F.coalesce(key_col, F.lit("0").cast(key_type)), "_no_key": F.col(key_col).isNull(),
                               "_hash": F.coalesce("_content_hash", F.lit("")), "_no_hash": F.col("_content_hash").isNull()})

    given = with_ids(index.select(F.col(key_col).cast(key_type).alias(key_col), chash.alias("_content_hash"),
                                  F.struct(*input_cols).alias("_inputs")))
    first = given.join(with_ids(todo).select(*ids), ids, "left_semi").groupBy(*ids).agg(F.min("_inputs").alias("_inputs"))
    return first.select(F.when(~F.col("_no_key"), F.col("_key")).alias(key_col),
                        F.when(~F.col("_no_hash"), F.col("_hash")).alias("_content_hash"), "_inputs.*")


def fill_cache(spark: SparkSession, index: DataFrame, cache_path: str, key_col: str,
               input_cols: list[str], factory: Callable[[], Extractor], model_version: str,
               dim: int, key_type: str = "string", content_hash_col: str | None = None,
               fetch: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Compute and append vectors for the index's ``uncached_keys``; returns their number. Inputs are the
    index's ``input_cols`` in the rows of such a key and hash (the smallest, where they differ), or what
    ``fetch`` adds to (key_col, _content_hash) rows. When no key is missing neither is read, and nothing written."""
    todo = stored(uncached_keys(spark, index, cache_path, key_col, model_version, key_type, content_hash_col), "uncached")
    if todo.isEmpty():
        return 0
    if fetch is not None:
        rows = fetch(todo)
    else:
        rows = _inputs_of(index, todo, key_col, input_cols, key_type, content_hash_col)
    vecs = extract_features(rows, factory, model_version, key_col, input_cols, dim, keep_cols=["_content_hash"])
    return add_vectors(spark, vecs.select(F.col(key_col).alias("key"), F.col("_content_hash").alias("content_hash"), "features"),
                       cache_path, model_version, key_type)


def compact_cache(spark: SparkSession, path: str, model_version: str, key_type: str = "string") -> int:
    """Write the current rows of a version's fills, as they are, as one fill that replaces them. Returns how many
    superseded rows it leaves out. The old folders stay for readers that have begun; see ``drop_replaced``. A
    fill committed meanwhile is not replaced."""
    import uuid

    ship_package(spark)
    fills = live_fills(spark, path, model_version)
    if len(fills) < 2:
        return 0
    fill = uuid.uuid4().hex
    read_cache(spark, path, key_type, model_version).hint("rebalance").write.parquet(f"{path}/vectors/fill={fill}")
    kept = _commit(spark, path, fill, model_version, fills[-1]["seq"], key_type, [r["fill"] for r in fills])
    return sum(r["rows"] for r in fills) - kept


def drop_replaced(spark: SparkSession, path: str) -> int:
    """Delete the folders of replaced fills; returns their number. For when no reader has begun before the
    compaction."""
    rows = spark.read.schema(FILLS_SCHEMA).parquet(f"{path}/fills").select("replaces").collect()
    gone = sorted({f for r in rows for f in r["replaces"] or []})
    for fill in gone:
        for what in ("vectors", "keys"):
            delete_folder(spark, f"{path}/{what}/fill={fill}")
    return len(gone)
