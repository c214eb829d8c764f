"""A mini-batch schedule in one job: one stage that runs all steps.

The rows of all batches are sorted by step, so a task reads its share as a stream and adds up one Arrow batch
after another: what it holds doesn't grow with the step. The training rows of a measured step come twice, for its
gradient and, behind that, to be measured by the weights after it. Small batches are one task's work. Larger ones are dealt to the tasks of a barrier stage: in a step every
task takes the gradient's sum over its rows, the tasks exchange their sums (``allGather``), add them up in
one order, and move their own copy of the model alike. What a step measured is sent along with the next
step's sums. The first task returns the model and the measures. Spark runs a barrier stage whole again if it
loses a task, from the same rows.

An exchange carries K x (D + 1) numbers from every task by way of the driver, and Spark looks for its end
once a second: it pays where a batch is ``TASK_BYTES`` or more, and the tasks must all have a slot at once.
"""
from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from ..session import ship_package
from .scoring import SoftmaxModel

TRAIN, VALIDATION, TEST, AGAIN = range(4)    # a step's rows come in this order; AGAIN: those of TRAIN, to be measured
TASK_BYTES = 64 << 20                        # of a batch's vectors, for one task
MOST_TASKS = 256


def schedule_tasks(spark, batch: int, dim: int) -> int:
    """How many tasks share a batch: by its vectors' size, at most the slots there are."""
    return max(1, min(MOST_TASKS, spark.sparkContext.defaultParallelism, -(-batch * dim * 8 // TASK_BYTES)))


def _pieces(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[tuple[int, int], np.ndarray, np.ndarray]]:
    """((step, part), vectors, classes) of each run of equal step and part in an Arrow batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        step, part, y = (batch.column(c).to_numpy() for c in range(3))
        flat = batch.column(3).flatten().to_numpy(zero_copy_only=False)
        if len(flat) != len(y) * dim:
            raise ValueError(f"a vector that doesn't have {dim} entries")
        cuts = np.flatnonzero((np.diff(step) != 0) | (np.diff(part) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(y)]):
            yield (int(step[a]), int(part[a])), flat[a * dim:b * dim].astype(np.float64).reshape(-1, dim), y[a:b]


def _probabilities(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Logits less their largest, of vectors and K x (D + 1) weights with the bias first."""
    z = x @ w[:, 1:].T + w[:, 0]
    return z - z.max(axis=1, keepdims=True)


def gradient_sum(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    p = np.exp(_probabilities(x, w))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(len(y)), y] -= 1.0
    return np.concatenate([p.sum(axis=0)[:, None], p.T @ x], axis=1)


def measured_sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """[rows, hits, summed cross-entropy]; of equal logits the first class is taken."""
    z = _probabilities(x, w)
    own = z[np.arange(len(y)), y]
    return np.array([len(y), (z.argmax(axis=1) == y).sum(), (np.log(np.exp(z).sum(axis=1)) - own).sum()], np.float64)


def run_schedule(rows: DataFrame, init: SoftmaxModel, steps: int, sizes: dict[int, int], learning_rate: float,
                 measured: list[int], tasks: int | None = None) -> tuple[SoftmaxModel, list[tuple]]:
    """The model after ``steps`` of gradient descent from ``init``, and for each measured step (step, train
    accuracy, cross-entropy, validation accuracy, test accuracy), from the weights after it.

    ``rows`` are (step, part, true_id, features): the training batch of every step, the validation batch of
    each measured step and, with the last step, the test batch. ``sizes`` has the rows of a batch of each
    part; another number of them at a step fails the job, as a batch that lost rows would change the result. A
    part without batches has no accuracy.
    """
    spark = rows.sparkSession
    ship_package(spark)
    w0 = np.concatenate([np.asarray(init.bias, np.float64)[:, None], np.asarray(init.weights, np.float64)], axis=1)
    k, width = w0.shape
    tasks = tasks or schedule_tasks(spark, max(sizes.values()), width - 1)
    last, want = steps - 1, set(measured)

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import BarrierTaskContext, TaskContext

        context = BarrierTaskContext.get() if tasks > 1 else TaskContext.get()

        def total(sums: np.ndarray) -> np.ndarray:
            """The sums of all tasks, added in one order."""
            if tasks == 1:
                return sums
            told = context.allGather(base64.b64encode(sums.tobytes()).decode())
            return np.sum([np.frombuffer(base64.b64decode(m)) for m in told], axis=0)

        w, found, pending = w0.copy(), [], None
        pieces = _pieces(batches, width - 1)
        ahead = next(pieces, None)

        def folded(step: int, part: int, fold, sums: np.ndarray) -> np.ndarray:
            """The sums over the stream's rows of this step and part, which it leaves behind."""
            nonlocal ahead
            while ahead is not None and ahead[0] == (step, part):
                sums = sums + fold(*ahead[1:], w)
                ahead = next(pieces, None)
            return sums

        def measures(sums: np.ndarray, step: int) -> None:
            for part in (TRAIN, VALIDATION, TEST):
                due = sizes.get(part, 0) if part != TEST or step == last else 0
                if sums[part, 0] != due:
                    raise ValueError(f"{sums[part, 0]:.0f} of {due} rows of a batch at step {step}")
            rate = [float(s[1] / s[0]) if s[0] else None for s in sums]
            found.append((step, rate[TRAIN], float(sums[TRAIN, 2] / sums[TRAIN, 0]), rate[VALIDATION], rate[TEST]))

        for step in range(steps):
            partial = folded(step, TRAIN, lambda x, y, w: np.concatenate([[len(y)], gradient_sum(x, y, w).ravel()]), np.zeros(1 + w.size))
            partial = np.concatenate([partial, np.ravel(pending if pending is not None else [])])
            told = total(partial)
            if pending is not None:
                measures(told[1 + w.size:].reshape(3, 3), step - 1)
                pending = None
            if told[0] != sizes[TRAIN]:
                raise ValueError(f"{told[0]:.0f} of {sizes[TRAIN]} rows of a batch at step {step}")
            w = w - learning_rate * told[1:1 + w.size].reshape(w.shape) / told[0]
            if step in want:
                found_in = {part: folded(step, part, measured_sums, np.zeros(3)) for part in (VALIDATION, TEST, AGAIN)}
                pending = np.array([found_in[part] for part in (AGAIN, VALIDATION, TEST)])
            while ahead is not None and ahead[0][0] == step:         # of a step that isn't measured
                ahead = next(pieces, None)
        if ahead is not None:
            raise ValueError(f"rows of step {ahead[0][0]}, beyond the last")
        if pending is not None:
            measures(total(pending.ravel()).reshape(3, 3), last)
        if context.partitionId() == 0:
            yield pa.RecordBatch.from_arrays([pa.array([json.dumps(found)]), pa.array([w.tobytes()])], names=["measures", "weights"])

    # dealt without a key: which task has which rows doesn't matter. Floats are dealt as they are
    kind = "array<float>" if rows.schema["features"].dataType == ArrayType(FloatType()) else "array<double>"
    twice = (F.col("part") == TRAIN) & F.col("step").isin(measured)
    dealt = (rows.select(F.col("step").cast("int").alias("step"), F.col("part").cast("int").alias("part"),
                         F.col("true_id").cast("int").alias("true_id"), F.col("features").cast(kind).alias("features"))
             .withColumn("part", F.explode(F.when(twice, F.array(F.lit(TRAIN), F.lit(AGAIN))).otherwise(F.array("part"))))
             .repartition(tasks).sortWithinPartitions("step", "part", "true_id", "features"))
    # Spark runs a barrier stage again only where a shuffle follows it: the one row is shuffled
    result = dealt.mapInArrow(descend, "measures string, weights binary", barrier=tasks > 1).repartition(1).collect()[0]
    w = np.frombuffer(bytes(result["weights"])).reshape(k, width)
    model = SoftmaxModel(list(init.labels), w[:, 1:].tolist(), w[:, 0].tolist())
    return model, [tuple(m) for m in json.loads(result["measures"])]
