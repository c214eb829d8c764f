"""Class-id lookups: id -> label list, and the two-hop id -> uid -> human name."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_label(df: DataFrame, labels: DataFrame, id_col: str = "label_id",
                 out_col: str = "label") -> DataFrame:
    """Left lookup class id -> label; an unknown id gives '' (never drops the row)."""
    lk = labels.select(F.col("label_id").alias(id_col), F.col("label").alias("_lab"))
    return df.join(lk, id_col, "left").withColumn(out_col, F.coalesce("_lab", F.lit(""))).drop("_lab")


def two_hop_labels(class_uids: DataFrame, uid_names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(class_id, label) through uid -> name, and the class uids that have no name
    (the error report; the lookup itself keeps only resolvable ids)."""
    names = uid_names.select("uid", "name")
    resolved = class_uids.join(names, "uid").select("class_id", F.col("name").alias("label"))
    missing = class_uids.join(names, "uid", "left_anti").select("class_id", "uid")
    return resolved, missing
