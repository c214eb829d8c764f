"""Quartile bucket digests of whole texts, and how alike two digests are.

A text's byte triplets (three spacings in each window of four bytes) are hashed into 128 buckets.
The digest has two bits for each bucket, the quartile of its count among the 128 counts, after a byte
for the length on a logarithmic scale and a byte for the ratios of the quartiles. Texts that share
most of their bytes keep most of their quartiles, wherever the bytes stand.

Two digests differ by a score of at most ``MOST``: quartile steps (three steps count six), length
steps and ratio steps. Likeness is one less its share of ``MOST``.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import id_and_text, slices, strings

BUCKETS = 128
SPACINGS = ((1, 2), (1, 3), (2, 3))
MOST = 256
LENGTH_MOST = 48                             # most that lengths alone may add
FIRST = -(1 << 63)                           # where a null id sorts


def bucket_counts(text: bytes) -> np.ndarray:
    """How many of the text's byte triplets fall in each bucket; a text under four bytes is padded."""
    own = np.frombuffer(text.ljust(4, b"\0"), np.uint8)
    out = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(own) - 3, 1 << 20):       # windows of four, a bounded piece at a time
        b = own[at:at + (1 << 20) + 3].astype(np.uint32)
        n = len(b) - 3
        for salt, (j, k) in enumerate(SPACINGS):
            mixed = (b[:n] | (b[j:n + j] << np.uint32(8)) | (b[k:n + k] << np.uint32(16))) + np.uint32((salt + 1) << 24)
            out += np.bincount((mixed * np.uint32(2654435761)) >> np.uint32(25), minlength=BUCKETS)
    return out


def digest(text: bytes) -> str:
    """68 hex digits: length, quartile ratios, and the quartile of each bucket. Empty: all zero."""
    if not text:
        return "0" * 68
    counts = bucket_counts(text)
    q1, q2, q3 = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    code = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    length = min(255, 1 + round(8 * float(np.log2(len(text)))))
    ratios = (int(15 * q1 / q3) << 4 | int(15 * q2 / q3)) if q3 else 0
    four = code.reshape(-1, 4)
    body = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    return f"{length:02x}{ratios:02x}" + body.astype(np.uint8).tobytes().hex()


def difference(a: str, b: str) -> int:
    """From 0, for equal digests, to ``MOST``."""
    x, y = (np.frombuffer(bytes.fromhex(d), np.uint8).astype(np.int64) for d in (a, b))
    shift = np.array([0, 2, 4, 6])
    step = np.abs(((x[2:, None] >> shift) & 3) - ((y[2:, None] >> shift) & 3))
    body = int(step.sum() + 3 * (step == 3).sum())
    ratio = abs((x[1] >> 4) - (y[1] >> 4)) + abs((x[1] & 15) - (y[1] & 15))
    return int(min(MOST, body + min(LENGTH_MOST, abs(x[0] - y[0])) + ratio))


def likeness(a: str, b: str) -> float:
    return 1.0 - difference(a, b) / MOST


def with_next(docs: DataFrame, compute: Callable[[Iterator[tuple]], Iterator[tuple]], schema: T.StructType) -> DataFrame:
    """``compute`` over each run of (doc_id, text, has_own_row), in ascending order of doc_id.

    The ids are cut into ranges at approximate quantiles (ids only are read for that). Each text is
    shuffled once, to its range; the first document of a range also goes to the range before it, as
    the last row there, so that every document meets its successor; the very first goes to the last
    range. Ties of an id are ordered by text, and a null id sorts before all others.
    """
    spark = docs.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = id_and_text(docs).withColumn("at", F.coalesce("doc_id", F.lit(FIRST)))
    shares = [i / n for i in range(1, n)] or [0.5]
    low, cuts = rows.agg(F.min("at"), F.percentile_approx("at", shares, 100 * n)).first()
    bounds = sorted({x for x in cuts or [] if x > low})       # the smallest id of each range but the first
    firsts = np.array([low if low is not None else FIRST, *bounds], np.int64)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy()
            bucket = np.searchsorted(firsts, at, side="right") - 1
            leads = np.flatnonzero(firsts[bucket] == at)
            rows = np.concatenate([np.arange(len(at)), leads])
            tail = np.arange(len(rows)) >= len(at)
            own = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [*own.columns, pa.array(np.where(tail, (bucket[rows] - 1) % len(firsts), bucket[rows]).astype(np.int32)),
                 pa.array(tail)], names=["doc_id", "text", "at", "bucket", "tail"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read():
            for batch in batches:
                for part in slices(batch):
                    yield from zip(part.column(0).to_pylist(), strings(part.column(1)), part.column(2).to_pylist())

        held: list[tuple] = []
        for row in compute(read()):
            held.append(row)
            if len(held) == 1000:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], out)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], out)

    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(schema)
    return (rows.mapInArrow(dealt, "doc_id long, text string, at long, bucket int, tail boolean")
            .repartitionById(len(firsts), F.col("bucket")).sortWithinPartitions("tail", "at", "text")
            .select("doc_id", "text", "tail").mapInArrow(run, schema))


def digest_neighbours(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint, edited_sha256, edited_fingerprint, near_edited, near_next).

    The edited text is the document with its last floor(n_chars / 2) code points replaced by the
    first as many (or all) of the next document by id; the last document's next is the first. A null
    text is empty, a single document is its own successor, repeated rows come back as often (a copy's
    successor is the next copy), and an empty table gives none. Other columns are not looked at.
    """
    schema = T.StructType().add("doc_id", "long").add("n_chars", "long").add("fingerprint", "string").add(
        "edited_sha256", "string").add("edited_fingerprint", "string").add("near_edited", "double").add("near_next", "double")

    def compute(rows: Iterator[tuple]) -> Iterator[tuple]:
        before = None
        for doc_id, text, tail in rows:
            own = digest(text.encode())
            if before is not None:
                last_id, last, known = before
                half = len(last) // 2
                edited = (last[:len(last) - half] + text[:half]).encode()
                changed = digest(edited)
                yield (last_id, len(last), known, hashlib.sha256(edited).hexdigest(), changed,
                       likeness(known, changed), likeness(known, own))
            if tail:                          # more of them are copies of the next range's first id
                break
            before = doc_id, text, own
        for _ in rows:
            pass

    return with_next(docs, compute, schema)
