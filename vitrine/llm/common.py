"""What the operators share: Arrow batches in bounded slices, scratch tables, id and text columns."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

SLICE_BYTES = 8 << 20                       # text handled at once in a Python worker


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) of any table; other columns, whatever their names, are left out."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called that."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def slices(batch: pa.RecordBatch, text_col: str = "text",
           most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``most`` bytes of text (a longer text comes alone)."""
    if not batch.num_rows:
        return
    import pyarrow.compute as pc

    size = pc.fill_null(pc.binary_length(batch.column(text_col)), 0)
    total = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, done + most, side="right")))
        yield batch.slice(at, end - at)
        at = end


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null is the empty text."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def add_columns(df: DataFrame, setup: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
                fields: list[T.StructField], text_col: str = "text",
                keep: list[str] | None = None) -> DataFrame:
    """``df`` with computed columns, one task's rows at a time and without a shuffle.

    ``setup`` runs once per task and returns a function from a slice of rows to the arrays of
    ``fields``. Columns not in ``keep`` (default: all) are not sent back.
    """
    keep = df.columns if keep is None else keep
    schema = T.StructType([df.schema[c] for c in keep] + fields)
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = setup()
        for batch in batches:
            for part in slices(batch, text_col):
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + compute(part), names=names)

    return df.mapInArrow(run, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: computed once, lineage cut."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def best_cut(scores: list[tuple[float, int]]) -> float | None:
    """Halfway between the scores of the two neighbours that part good from bad with the fewest errors
    (as shares of either); the lowest such place. None without both kinds."""
    known = sorted(scores)
    value, label = np.array([s for s, _ in known]), np.array([y for _, y in known])
    if not len(known) or label.min() == label.max():
        return None
    good_lost = np.cumsum(label) / label.sum()
    bad_kept = 1 - np.cumsum(1 - label) / (1 - label).sum()
    error = (good_lost + bad_kept)[:-1]
    error[value[1:] == value[:-1]] = np.inf              # no place between equal scores
    error = np.concatenate([[1.0], error])               # or below all
    at = int(np.argmin(error))
    return float(value[0] - 1 if at == 0 else (value[at - 1] + value[at]) / 2)
