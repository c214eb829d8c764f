"""Sinks: per-label JSON, enriched JSON, vector text, label list, model weights, landing.

Every sink is a DataFrame writer (tasks write their own files in parallel); nothing is
gathered on the driver. Where a single-file shape is wanted (a label list, a JSON array
per label) the rows are bounded by the call (K labels; a per-label cap).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.vectors import to_csv
from ..operators.catalog import first_n_per_label


LABEL_FOLDER = "label_folder"


def write_json_by_label(df: DataFrame, path: str, label_col: str = "label",
                        mode: str = "overwrite") -> None:
    """JSON lines, one folder per label (``label=<value>``); NULL fields are omitted,
    so an absent key stays absent."""
    df.write.mode(mode).partitionBy(label_col).json(path)


def write_json_arrays_by_label(df: DataFrame, path: str, n: int, order_cols: list[str],
                               label_col: str = "label", hidden: tuple[str, ...] = (),
                               mode: str = "overwrite") -> None:
    """One JSON *array* per label (text file per label folder) of the label's first ``n`` rows by
    ``order_cols``, without the ``hidden`` columns. A label's array is one value, so n bounds it; ``write_json_by_label`` writes
    whole labels. The input is evaluated once."""
    capped = first_n_per_label(df, label_col, n, order_cols)
    payload = F.struct(*[c for c in df.columns if c != label_col and c not in hidden])
    arr = F.transform(F.array_sort(F.collect_list(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)],
                                                           payload.alias("_p")))),
                      lambda s: s["_p"])
    (capped.groupBy(label_col).agg(F.to_json(arr).alias("value"))
     .write.mode(mode).partitionBy(label_col).text(path))


def write_vectors_text(df: DataFrame, path: str, key_col: str = "key",
                       features_col: str = "features", mode: str = "overwrite") -> None:
    """``key<TAB>v1,v2,...`` text lines."""
    (df.select(F.concat_ws("\t", F.col(key_col).cast("string"), to_csv(features_col)).alias("value"))
     .write.mode(mode).text(path))


def write_label_list(labels: DataFrame, path: str, id_col: str = "label_id",
                     label_col: str = "label", mode: str = "overwrite") -> None:
    """One label per line in class-id order, one file (the list has K rows)."""
    (labels.orderBy(id_col).select(F.col(label_col).alias("value"))
     .coalesce(1).write.mode(mode).text(path))


def write_model(model_table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """(label_id, label, weights, bias) as parquet."""
    model_table.coalesce(1).write.mode(mode).parquet(path)


def land_by_label(df: DataFrame, path: str, label_col: str = "label", fmt: str = "parquet",
                  mode: str = "overwrite") -> None:
    """Label-partitioned landing of a manifest (or image rows with a ``content`` column).

    ``REBALANCE(label)``: rows are hash-partitioned by label and AQE, from the shuffle's
    own statistics, splits a hot label into advisory-size tasks and merges small labels.
    Each label folder therefore gets few files of sensible size, a hot label still spans
    many tasks, and no sampling job recomputes the input (as range partitioning would).
    The folder is named by ``LABEL_FOLDER``; the label itself stays a column of the files, as a
    folder name can't tell ``007`` from a number or an empty label from none."""
    (df.withColumn(LABEL_FOLDER, F.col(label_col).cast("string")).hint("rebalance", label_col)
     .write.mode(mode).partitionBy(LABEL_FOLDER).format(fmt).save(path))


def read_landing(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """What ``land_by_label`` wrote, with the columns it was given."""
    return spark.read.schema(schema).format(fmt).load(path).select(schema.names)
