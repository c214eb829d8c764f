"""Scoring with a trained final layer: logits, softmax, top-k, labels.

A model is a table (label_id, label, weights array<double>, bias double) with K rows.
It is brought to the driver once and sent to the executors in a broadcast variable; the linear
layer is one matrix product for each Arrow batch. Scoring is row-local: no join, no shuffle.

Where only the best classes are wanted, ``SoftmaxModel.top`` multiplies block by block of classes and keeps,
for every row, the largest logit so far, the sum of exponentials below it and the best k: k scores a
row leave Python, and a task holds ``ROWS`` x ``CLASSES`` logits whatever the number of classes.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as FV
from ..functions import vectors as V
from ..session import ship_package


ROWS, CLASSES = 1024, 4096                   # of a block of logits
SPARE = 4
TOP_TYPE = "array<struct<score:double,class_id:int>>"


def _best(z: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest of each row and their ids, largest first; of equal ones the higher id first. ``ids`` falls
    from left to right among equal logits."""
    if k < 8:
        z, values, places = z.copy(), [], []
        rows = np.arange(len(z))
        for _ in range(min(k, z.shape[1])):
            at = z.argmax(axis=1)                        # the first of equal ones
            values.append(z[rows, at])
            places.append(at)
            z[rows, at] = -np.inf
        at = np.stack(places, axis=1)
        return np.stack(values, axis=1), np.take_along_axis(ids, at, axis=1)
    at = np.argsort(-z, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(z, at, axis=1), np.take_along_axis(ids, at, axis=1)


def top_scores(x: np.ndarray, weights: np.ndarray, bias: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(softmax scores, class ids) of the k best classes of each row of ``x``, from blocks of classes; of equal
    scores the higher class first. Logits that differ may round to one score: ``SPARE`` more classes than
    asked for are kept by logit until the scores are known."""
    n, wanted, k = len(x), k, min(k + SPARE, len(weights))
    largest, total = np.full(n, -np.inf), np.zeros(n)
    value, ids = np.zeros((n, 0)), np.zeros((n, 0), np.int32)
    for low in range(0, len(weights), CLASSES):
        z = x @ weights[low:low + CLASSES].T + bias[low:low + CLASSES]
        new = np.maximum(largest, z.max(axis=1))
        total = total * np.exp(largest - new) + np.exp(z - new[:, None]).sum(axis=1)
        largest = new
        own, at = _best(z[:, ::-1], np.broadcast_to(np.arange(low + z.shape[1] - 1, low - 1, -1, dtype=np.int32), z.shape), k)
        # later blocks have the higher ids, so they come first
        value, ids = _best(np.concatenate([own, value], axis=1), np.concatenate([at, ids], axis=1), k)
    score = np.exp(value - largest[:, None]) / total[:, None]
    order = np.lexsort((-ids, -score), axis=1)[:, :wanted]
    return np.take_along_axis(score, order, axis=1), np.take_along_axis(ids, order, axis=1)


@dataclass
class SoftmaxModel:
    labels: list[str]
    weights: list[list[float]]   # K x D
    bias: list[float]            # K

    @property
    def num_classes(self) -> int:
        return len(self.labels)

    @classmethod
    def from_table(cls, table: DataFrame) -> "SoftmaxModel":
        rows = table.orderBy("label_id").collect()
        return cls([r["label"] for r in rows], [list(r["weights"]) for r in rows],
                   [float(r["bias"]) for r in rows])

    def to_table(self, spark: SparkSession) -> DataFrame:
        data = [(i, lab, [float(v) for v in w], float(b))
                for i, (lab, w, b) in enumerate(zip(self.labels, self.weights, self.bias))]
        return spark.createDataFrame(
            data, "label_id int, label string, weights array<double>, bias double")

    def logits(self, features: Column | str) -> Column:
        """array<double> of K logits; NULL for a NULL vector."""
        spark = SparkSession.getActiveSession()
        ship_package(spark)
        model = spark.sparkContext.broadcast((np.asarray(self.weights, dtype=np.float64),
                                              np.asarray(self.bias, dtype=np.float64)))

        @F.pandas_udf("array<double>")
        def layer(vectors: pd.Series) -> pd.Series:
            weights, bias = model.value
            out = pd.Series([None] * len(vectors), dtype=object)
            known = vectors.notna().to_numpy()
            if known.any():
                z = np.stack(vectors[known].to_numpy()).astype(np.float64) @ weights.T + bias
                out[known] = pd.Series(list(z), index=out.index[known], dtype=object)
            return out

        return layer(features)

    def top(self, features: Column | str, k: int) -> Column:
        """array<struct<score, class_id>> of the k best classes by softmax score, of equal ones the higher class
        first; NULL for a NULL vector. Only these leave Python."""
        spark = SparkSession.getActiveSession()
        ship_package(spark)
        model = spark.sparkContext.broadcast((np.asarray(self.weights, dtype=np.float64), np.asarray(self.bias, dtype=np.float64)))
        k = min(k, self.num_classes)

        @F.arrow_udf(TOP_TYPE)
        def best(vectors: pa.Array) -> pa.Array:
            weights, bias = model.value
            known = vectors.is_valid().to_numpy(zero_copy_only=False)
            rows = vectors.filter(pa.array(known))
            flat = rows.flatten().to_numpy(zero_copy_only=False)
            if len(flat) != len(rows) * weights.shape[1]:
                raise ValueError(f"a vector that doesn't have {weights.shape[1]} entries")
            x = flat.reshape(len(rows), weights.shape[1])
            found = [top_scores(x[at:at + ROWS].astype(np.float64), weights, bias, k) for at in range(0, len(x), ROWS)]
            score = np.concatenate([f[0].ravel() for f in found]) if found else np.zeros(0)
            ids = np.concatenate([f[1].ravel() for f in found]) if found else np.zeros(0, np.int32)
            pairs = pa.StructArray.from_arrays([pa.array(score), pa.array(ids, pa.int32())], names=["score", "class_id"])
            starts = np.concatenate([[0], np.cumsum(known * k)]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(starts), pairs, mask=pa.array(~known))

        return best(features)

    def label_of(self, class_id: Column | str) -> Column:
        """class id -> label; ids outside the list give '' (as the label lookup does)."""
        lab = F.array(*[F.lit(x) for x in self.labels])
        cid = F.col(class_id) if isinstance(class_id, str) else class_id
        return F.coalesce(F.get(lab, cid), F.lit(""))


def fixed_weight(c: int, d: int) -> float:
    """Deterministic test model: ((c*31 + d*17) mod 13 - 6) / 10."""
    return (((c * 31 + d * 17) % 13) - 6) / 10


def fixed_model(labels: list[str], dim: int) -> SoftmaxModel:
    k = len(labels)
    return SoftmaxModel(list(labels), [[fixed_weight(c, d) for d in range(dim)] for c in range(k)],
                        [0.0] * k)


def score(df: DataFrame, model: SoftmaxModel, features_col: str = "features") -> DataFrame:
    """Adds ``logits`` and ``probs`` (array<double>, one per class)."""
    return (df.withColumn("logits", model.logits(features_col))
            .withColumn("probs", V.softmax("logits")))


def score_top(df: DataFrame, model: SoftmaxModel, k: int, features_col: str = "features") -> DataFrame:
    """Adds ``top``: the k best classes and their softmax scores, without the others'."""
    return df.withColumn("top", model.top(features_col, k))


def _top(scored: DataFrame, k: int) -> Column:
    """The k best, from ``top`` where the rows have it, else from ``probs``."""
    return F.slice("top", 1, k) if "top" in scored.columns else V.top_k("probs", k)


def scores_long(scored: DataFrame, model: SoftmaxModel, key_cols: list[str]) -> DataFrame:
    """One row per (key, class): label_id, label, score."""
    return (scored.select(*key_cols, F.posexplode("probs").alias("label_id", "score"))
            .withColumn("label", model.label_of("label_id")))


def top_labels(scored: DataFrame, model: SoftmaxModel, key_cols: list[str], k: int) -> DataFrame:
    """Top-k per row by score (row-local: no window, no shuffle)."""
    return (scored.select(*key_cols, F.posexplode(_top(scored, k)).alias("pos", "t"))
            .select(*key_cols, (F.col("pos") + 1).alias("rank"),
                    F.col("t.class_id").alias("label_id"), F.col("t.score").alias("score"))
            .withColumn("label", model.label_of("label_id")))


def first_two(scored: DataFrame, model: SoftmaxModel, prefix: str = "label") -> DataFrame:
    """Ranks 1 and 2 as columns label1, score1, label2, score2 (no pivot shuffle)."""
    two = _top(scored, 2)
    first, second = F.get(two, F.lit(0)), F.get(two, F.lit(1))
    return (scored
            .withColumn(f"{prefix}1", model.label_of(first["class_id"]))
            .withColumn("score1", first["score"])
            .withColumn(f"{prefix}2", model.label_of(second["class_id"]))
            .withColumn("score2", second["score"]))


def default_labels() -> list[str]:
    return list(FV.SHIPPED_LABELS)
