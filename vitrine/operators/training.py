"""Softmax-regression training and evaluation on feature vectors.

* ``gradient`` — one gradient of the mean softmax cross-entropy. Each task folds its rows
  into a K x (D+1) partial sum with NumPy (``mapInPandas``), a binary row for each block of
  classes; these rows are added in a tree of two levels, a block at a time.
* ``train_lbfgs`` — the default trainer: ``pyspark.ml`` multinomial logistic regression
  (distributed L-BFGS over tree aggregation).
* ``train_descent`` — a few steps of gradient descent over all rows, a job a step.
* ``train_sgd`` — the mini-batch gradient-descent schedule (steps, batch, rate, eval
  interval): the class-balanced batches of all steps are drawn by hash and joined to their
  vectors once, and one barrier job runs all steps (``schedule``).
* ``evaluate`` — accuracy and mean cross-entropy per split.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from .. import fixed_values as FV
from ..functions import vectors as V
from ..session import ship_package
from . import schedule as SCH
from .augment import Augmentation, augment_images, augment_params, augment_tensors
from .augment import values as tensor_values
from .guards import literal_broadcast
from .scoring import SoftmaxModel

BLOCK_BYTES = 4 << 20                        # of a block of classes in a partial sum
PARTIAL_SCHEMA = "block int, share int, n bigint, sums binary"


def block_classes(dim: int) -> int:
    """Classes whose sums make a block."""
    return max(1, BLOCK_BYTES // (8 * (dim + 1)))


def _partials_fn(weights, bias, features_col: str, class_col: str, shares: int):
    """One task's sums: a binary row of K_b x (D + 1) numbers, bias first, for each block of classes."""
    W = np.asarray(weights, dtype=np.float64)
    b = np.asarray(bias, dtype=np.float64)
    k, d = W.shape

    def fold(batches):
        from pyspark import TaskContext

        G, n = np.zeros((k, d + 1)), 0
        for pdf in batches:
            if len(pdf) == 0:
                continue
            X = np.stack(pdf[features_col].to_numpy()).astype(np.float64)
            y = pdf[class_col].to_numpy().astype(np.int64)
            Z = X @ W.T + b
            Z -= Z.max(axis=1, keepdims=True)
            P = np.exp(Z)
            P /= P.sum(axis=1, keepdims=True)
            P[np.arange(len(y)), y] -= 1.0           # softmax - one_hot
            G[:, 1:] += P.T @ X
            G[:, 0] += P.sum(axis=0)
            n += len(y)
        if n == 0:
            return
        share = TaskContext.get().partitionId() % shares
        step = block_classes(d)
        for at in range(0, k, step):
            yield pd.DataFrame({"block": [at // step], "share": [share], "n": [n], "sums": [G[at:at + step].tobytes()]})
    return fold


def _added(partials: DataFrame, keys: list[str]) -> DataFrame:
    """The sums of rows with equal keys, added as they stream by: a task holds one block at a time."""
    out_share = "share" in keys

    def run(batches):
        here, n, sums = None, 0, None

        def done():
            return pd.DataFrame({"block": [here[0]], "share": [here[1] if out_share else 0], "n": [n], "sums": [sums.tobytes()]})

        for pdf in batches:
            for block, share, count, raw in pdf.itertuples(index=False, name=None):
                key = (block, share) if out_share else (block,)
                if key != here:
                    if here is not None:
                        yield done()
                    here, n, sums = key, 0, 0.0
                n, sums = n + count, sums + np.frombuffer(raw)
        if here is not None:
            yield done()

    return partials.repartition(*keys).sortWithinPartitions(*keys, "n").mapInPandas(run, PARTIAL_SCHEMA)


def checked_class(class_col: str, num_classes: int):
    """The class id; a row whose id is NULL or not one of the classes fails the job, as leaving it
    out would change the result."""
    c = F.col(class_col)
    wrong = F.raise_error(F.concat(F.lit(f"{class_col} is not a class below {num_classes}: "),
                                   F.coalesce(c.cast("string"), F.lit("NULL")))).cast("int")
    return F.when(c.between(0, num_classes - 1), c.cast("int")).otherwise(wrong).alias(class_col)


def gradient(df: DataFrame, model: SoftmaxModel, features_col: str = "features",
             class_col: str = "true_id") -> DataFrame:
    """(class_id, dim, grad): mean gradient of the cross-entropy; dim -1 is the bias."""
    ship_package(df.sparkSession)
    rows = df.select(features_col, checked_class(class_col, model.num_classes))
    dim, tasks = np.asarray(model.weights).shape[1], rows.rdd.getNumPartitions()
    partials = rows.mapInPandas(_partials_fn(model.weights, model.bias, features_col, class_col, max(1, int(tasks ** 0.5))),
                                PARTIAL_SCHEMA)
    step = block_classes(dim)

    def unpack(batches):
        for pdf in batches:
            for block, _, n, raw in pdf.itertuples(index=False, name=None):
                sums = np.frombuffer(raw).reshape(-1, dim + 1) / n
                for at in range(0, len(sums), 64):
                    some = sums[at:at + 64]
                    yield pd.DataFrame({"class_id": np.repeat(np.arange(len(some)) + block * step + at, dim + 1).astype(np.int32),
                                        "dim": np.tile(np.arange(-1, dim), len(some)).astype(np.int32), "grad": some.ravel()})

    return _added(_added(partials, ["block", "share"]), ["block"]).mapInPandas(unpack, "class_id int, dim int, grad double")


def gradient_step(df: DataFrame, model: SoftmaxModel, learning_rate: float = FV.LEARNING_RATE,
                  features_col: str = "features", class_col: str = "true_id") -> DataFrame:
    """(class_id, dim, grad, weight): the gradient and the weights after one step,
    as a DataFrame (no driver round trip)."""
    g = gradient(df, model, features_col, class_col)
    w0 = model.to_table(df.sparkSession).select(
        F.col("label_id").alias("class_id"),
        F.posexplode(F.concat(F.array(F.col("bias")), F.col("weights"))).alias("pos", "w0"))
    # K x (D+1) rows built from the model literal: a size fixed by the model
    w0 = literal_broadcast(w0.select("class_id", (F.col("pos") - 1).cast("int").alias("dim"), "w0"))
    return (g.join(w0, ["class_id", "dim"])
            .select("class_id", "dim", "grad",
                    (F.col("w0") - F.lit(learning_rate) * F.col("grad")).alias("weight")))


def init_model(labels: list[str], dim: int, seed: int = 0,
               stddev: float = FV.INIT_STDDEV) -> SoftmaxModel:
    """Truncated-normal (|z| < 2 sigma) weights, zero bias."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, stddev, size=(len(labels), dim))
    bad = np.abs(w) > 2 * stddev
    while bad.any():
        w[bad] = rng.normal(0.0, stddev, size=bad.sum())
        bad = np.abs(w) > 2 * stddev
    return SoftmaxModel(list(labels), w.tolist(), [0.0] * len(labels))


def train_lbfgs(df: DataFrame, labels: list[str], features_col: str = "features",
                class_col: str = "true_id", max_iter: int = 100, reg_param: float = 0.0,
                tol: float = 1e-6) -> SoftmaxModel:
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    data = df.select(array_to_vector(F.col(features_col)).alias("fv"),
                     F.col(class_col).cast("double").alias("y"))
    lr = LogisticRegression(featuresCol="fv", labelCol="y", family="multinomial",
                            maxIter=max_iter, regParam=reg_param, tol=tol,
                            standardization=False, fitIntercept=True)
    fitted = lr.fit(data)
    W = fitted.coefficientMatrix.toArray()
    b = fitted.interceptVector.toArray()
    k = len(labels)
    if W.shape[0] < k:                       # classes above the largest seen id
        W = np.vstack([W, np.zeros((k - W.shape[0], W.shape[1]))])
        b = np.concatenate([b, np.full(k - len(b), -1e9)])
    return SoftmaxModel(list(labels), W.tolist(), b.tolist())


def train_descent(df: DataFrame, init: SoftmaxModel, steps: int, learning_rate: float = FV.LEARNING_RATE,
                  features_col: str = "features", class_col: str = "true_id") -> SoftmaxModel:
    """The model after steps of gradient descent, each by the mean gradient over every row of ``df``."""
    model = init
    for _ in range(steps):
        w = np.concatenate([np.asarray(model.bias)[:, None], np.asarray(model.weights)], axis=1)
        for c, d, g in gradient(df, model, features_col, class_col).collect():       # K x (D+1) numbers
            w[c, d + 1] -= learning_rate * g
        model = SoftmaxModel(list(model.labels), w[:, 1:].tolist(), w[:, 0].tolist())
    return model


def evaluate(df: DataFrame, model: SoftmaxModel, group_cols: list[str],
             features_col: str = "features", class_col: str = "true_id") -> DataFrame:
    """n, accuracy (argmax, lowest index wins) and mean cross-entropy per group."""
    z = df.withColumn("_z", model.logits(features_col))
    z = z.withColumn("_pred", V.argmax("_z")).withColumn(
        "_xent", V.log_sum_exp("_z") - F.get("_z", F.col(class_col)))
    return (z.groupBy(*group_cols)
            .agg(F.count(F.lit(1)).alias("n"),
                 F.avg((F.col("_pred") == F.col(class_col)).cast("double")).alias("accuracy"),
                 F.avg("_xent").alias("mean_xent")))


def augmented_draws(draws: DataFrame, pixels: DataFrame, key_col: str, augment: Augmentation, seed: str, factory,
               model_version: str, dim: int, features_col: str) -> DataFrame:
    """(step, true_id, features): fresh vectors of the drawn images, each augmented by its draw. ``pixels`` are
    tensors, or nested arrays."""
    from .features import extract_features

    kind = pixels.schema["pixels"].dataType
    images = augment_params(draws.join(pixels.select(key_col, "pixels"), key_col), "draw_id", seed, augment)
    keep = ["draw_id", "step", "class_id"]
    if isinstance(kind, ArrayType):          # nested arrays
        seen = augment_images(images, "pixels", augment, keep_cols=keep)
        flat = F.flatten(F.flatten("augmented")) if isinstance(kind.elementType.elementType, ArrayType) else F.flatten("augmented")
    else:
        seen, flat = augment_tensors(images, "pixels", augment, keep_cols=keep), tensor_values("augmented")
    vecs = extract_features(seen.select(*keep, flat.alias("flat")), factory, model_version,
                            "draw_id", ["flat"], dim, keep_cols=["step", "class_id"])
    return vecs.select("step", F.col("class_id").alias("true_id"), F.col("features").alias(features_col))


def train_sgd(spark: SparkSession, pool: DataFrame, features: DataFrame, labels: list[str],
              steps: int = FV.TRAINING_STEPS, batch: int = FV.TRAIN_BATCH,
              learning_rate: float = FV.LEARNING_RATE, eval_interval: int = FV.EVAL_INTERVAL,
              validation_batch: int = FV.VALIDATION_BATCH, test_batch: int = FV.TEST_BATCH,
              seed: str = "sgd", key_col: str = "key", features_col: str = "features",
              init: SoftmaxModel | None = None, pixels: DataFrame | None = None,
              augment: Augmentation | None = None, extractor_factory=None,
              model_version: str = "aug") -> tuple[SoftmaxModel, DataFrame]:
    """Mini-batch gradient descent. ``pool`` is the indexed split list
    (label, split, key, idx); ``features`` is the cached (key, features) table. Returns
    the model and a metrics table (step, train_accuracy, cross_entropy,
    validation_accuracy, test_accuracy) with a row every ``eval_interval`` steps and at
    the last step; the final test accuracy is on the last row.

    Where augmented images vary, each training draw's image is augmented from ``pixels`` (key,
    pixels) and passed through ``extractor_factory``; validation and test always use the cached
    vectors. The batches of all steps are drawn and joined to their vectors at once, and one
    job runs the whole schedule (``schedule.run_schedule``). A class that ``labels`` doesn't
    have, or a draw without a vector, fails it."""
    from .sampling import balanced_draws
    from .splits import check_class_count

    distort = augment is not None and augment.varies
    if distort and (pixels is None or extractor_factory is None):
        raise ValueError("augmentation needs pixels and an extractor")
    ship_package(spark)
    check_class_count(pool.filter(F.col("split") == "training"), "label")
    dim = len(features.select(features_col).first()[0])
    model = init or init_model(labels, dim)
    feats = features.select(key_col, features_col)
    measured = [s for s in range(steps) if s % eval_interval == 0 or s + 1 == steps]

    def draws(n: int, size: int, split: str, what: str) -> DataFrame:
        d = balanced_draws(spark, pool, n * size, split, f"{seed}:{what}", labels)
        return d.withColumn("turn", F.expr(f"cast(draw_id div {size} as int)")).withColumnRenamed("key", key_col)

    def cached(n: int, size: int, split: str, what: str) -> DataFrame | None:
        """(turn, true_id, features) of n batches; none where the split has no images."""
        if pool.filter(F.col("split") == split).isEmpty():
            return None
        d = draws(n, size, split, what).join(feats, key_col)
        return d.select("turn", F.col("class_id").alias("true_id"), F.col(features_col).alias("features"))

    if distort:
        drawn = draws(steps, batch, "training", "train").withColumnRenamed("turn", "step")
        train = augmented_draws(drawn, pixels, key_col, augment, f"{seed}:augment", extractor_factory, model_version, dim, "features")
        train = train.withColumnRenamed("step", "turn")
    else:
        train = cached(steps, batch, "training", "train")
    at = F.array(*map(F.lit, measured))
    parts = [(SCH.TRAIN, batch, train, F.col("turn")),
             (SCH.VALIDATION, validation_batch, cached(len(measured), validation_batch, "validation", "validation"), F.get(at, F.col("turn"))),
             (SCH.TEST, test_batch, cached(1, test_batch, "testing", "test"), F.lit(steps - 1))]
    rows = [df.select(step.alias("step"), F.lit(part).alias("part"), "true_id", "features") for part, _, df, step in parts if df is not None]
    every = rows[0]
    for more in rows[1:]:
        every = every.union(more)
    model, metrics = SCH.run_schedule(every, model, steps, {part: size for part, size, df, _ in parts if df is not None},
                                      learning_rate, measured)
    mdf = spark.createDataFrame(
        metrics, "step int, train_accuracy double, cross_entropy double, "
                 "validation_accuracy double, test_accuracy double")
    return model, mdf
