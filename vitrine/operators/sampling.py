"""Reproducible class-balanced draws with replacement.

Each draw picks a label among the labels whose split is non-empty, then an image among the
label's. Both choices are 60 bits of a sha1 hash of (seed, draw id, stream), wrapped by the
number of labels or images (a bias of at most that number / 2 ** 60), so a draw is a pure
function of its id: the draws table is ``spark.range(n)`` plus columns, any task can recompute
any draw, and the result can be checked by SQL. The draws then meet the indexed list by an
equi-join on (label, idx). ``index_range`` draws the image number below a bound first, as a
trainer with numbers up to 65,536 does; images of a label beyond it are then never drawn.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.hashing import hash60
from ..functions.vectors import wrap_index


def class_table(pool: DataFrame, split: str, labels: list[str] | None = None) -> DataFrame:
    """(label, class_id, n, label_pos) for labels with at least one image in the split.

    class_id is the label's position in ``labels`` (the model's class list) or, without
    a list, its rank by name over all labels in the index. A label that the list doesn't
    have is an error: its images would never be drawn."""
    sizes = (pool.filter(F.col("split") == split)
             .groupBy("label").agg(F.count(F.lit(1)).alias("n")))
    if labels is not None:
        known = pool.sparkSession.createDataFrame(list(enumerate(labels)), "class_id int, label string")
        unknown = sizes.join(known, "label", "left_anti").select("label").orderBy("label").limit(10).collect()
        if unknown:
            raise ValueError(f"labels that the class list doesn't have: {[r['label'] for r in unknown]}")
        sizes = sizes.join(known, "label")
    else:
        all_labels = pool.select("label").distinct().withColumn(
            "class_id", (F.dense_rank().over(Window.orderBy("label")) - 1).cast("int"))
        sizes = sizes.join(all_labels, "label")
    # one row per class: the global window is over a class-sized table
    return sizes.withColumn("label_pos", F.row_number().over(Window.orderBy("class_id")).cast("bigint") - 1)


DRAWS = "draw_id bigint, class_id int, label string, image_index bigint, idx bigint, key string"


def balanced_draws(spark: SparkSession, pool: DataFrame, n_draws: int, split: str, seed: str,
                   labels: list[str] | None = None, index_range: int | None = None) -> DataFrame:
    """(draw_id, class_id, label, image_index, idx, key) for n_draws draws."""
    classes = class_table(pool, split, labels)
    n_classes = classes.count()                     # one row per class
    if n_classes == 0:
        return spark.createDataFrame([], DRAWS)
    image = hash60(seed, "draw_id", "image")
    draws = (spark.range(n_draws).withColumnRenamed("id", "draw_id")
             .withColumn("label_pos", F.pmod(hash60(seed, "draw_id", "label"), F.lit(n_classes)))
             .withColumn("image_index", image if index_range is None else F.pmod(image, F.lit(index_range))))
    picked = (draws.join(classes, "label_pos")
              .withColumn("idx", wrap_index("image_index", F.col("n")).cast("bigint")))
    members = pool.filter(F.col("split") == split).select("label", "idx", "key")
    return (picked.join(members, ["label", "idx"])
            .select("draw_id", "class_id", "label", "image_index", "idx", "key"))
