"""Stable training / testing / validation split of an image (or document) index."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import fixed_values as FV
from ..functions.hashing import hash_percentage, split_of
from ..functions.text import variant_group_key
from .ranking import index_within_group

SPLITS = ["training", "testing", "validation"]


def assign_split(df: DataFrame, key_col: str = "key",
                 validation_pct: float = FV.DEFAULT_VALIDATION_PCT,
                 testing_pct: float = FV.DEFAULT_TESTING_PCT) -> DataFrame:
    """Adds group_key (``_nohash_`` suffix dropped), pct and split. Row-local: no shuffle,
    and a row's split never changes when other rows are added."""
    return (df.withColumn("group_key", variant_group_key(key_col))
            .withColumn("pct", hash_percentage("group_key"))
            .withColumn("split", split_of("pct", validation_pct, testing_pct)))


def split_counts(df: DataFrame, label_col: str = "label",
                 small_threshold: int = FV.SMALL_FOLDER_THRESHOLD) -> DataFrame:
    """Per label: total, per-split counts, ``small`` (< threshold) and the class count.

    One aggregation (partial on the map side); the class count is a window over the
    per-label result, which has one row per label."""
    per = (df.groupBy(label_col)
           .agg(F.count(F.lit(1)).alias("n_images"),
                *[F.sum((F.col("split") == s).cast("bigint")).alias(f"n_{s}") for s in SPLITS]))
    return (per.withColumn("small", F.col("n_images") < small_threshold)
            .withColumn("n_classes", F.count(F.lit(1)).over(Window.partitionBy())))


def indexed_split_lists(df: DataFrame, label_col: str = "label", key_col: str = "key") -> DataFrame:
    """Long form of the per-label, per-split lists: (label, split, key, idx)."""
    return index_within_group(df.select(label_col, "split", key_col), [label_col, "split"], [key_col])


def check_class_count(index: DataFrame, label_col: str = "label") -> int:
    """Number of labels with at least one image; training needs two or more."""
    n = index.select(label_col).distinct().count()
    if n == 0:
        raise ValueError("no labelled images found")
    if n == 1:
        raise ValueError("only one label found: classification needs at least two")
    return n
