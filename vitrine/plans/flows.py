"""End-to-end flows: the three jobs of the original workflow, composed from the operators.

1. ``land_training_images``  catalogue -> labelled, de-duplicated image manifest with URLs
   and landed-asset paths -> label-partitioned landing.
2. ``export_length_json`` / ``validate_exports``  catalogue -> capped per-label JSON
   arrays (unknown attribute text quarantined) -> scored top-2 labels + rule warnings
   -> enriched JSON (rows that could not be scored pass through unchanged).
3. ``train_from_index``  image index -> stable split -> feature cache fill -> softmax
   training -> per-split metrics, model table and label list.
4. ``validate_colors``  per-colour JSON arrays -> scored top-2 colours + warning against
   the file's colour -> enriched JSON (all colours in one pass).

Each flow is one lazy plan per sink; nothing is gathered on the driver except the model
(K x D) and scalar counts.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import fixed_values as FV
from .. import sinks
from ..operators import assets as A
from ..operators import catalog as C
from ..operators import features as FE
from ..operators import joins as J
from ..operators import rules as R
from ..operators import scoring as SC
from ..operators import splits as S
from ..operators import training as T
from ..sources import files as SRC
from ..sources.tables import Catalogue


def land_training_images(cat: Catalogue, out_path: str,
                         attribute_type_id: int = FV.ATTR_TYPE_CATEGORY, modulus: int = 16,
                         prefix: str | None = None) -> DataFrame:
    """Job 1: labelled images of published products, landed by label. Returns the
    manifest as written (read back from ``out_path``)."""
    rows = C.with_image_url(C.labelled_images(cat, attribute_type_id, modulus), prefix)
    manifest = A.attach_assets(rows.withColumnRenamed("varchar_value", "label"), cat.landed_assets)
    landed = manifest.select("product_id", "image_id", "image_url", "image_path", "has_asset", "label")
    sinks.land_by_label(landed, out_path)
    return sinks.read_landing(manifest.sparkSession, out_path, landed.schema)


def export_length_json(cat: Catalogue, out_path: str, desc_like: str = "%Dress%",
                       cap: int = 200, modulus: int = 16) -> tuple[DataFrame, DataFrame]:
    """Job 2a: dress-length manifest -> one JSON array per enum label with at most ``cap``
    landed images each (ordered by product, image). Returns (exported, quarantined)."""
    rows = C.with_image_url(C.labelled_images(cat, FV.ATTR_TYPE_DRESS_LENGTH, modulus,
                                              desc_like=desc_like))
    good, bad = A.split_quarantine(rows.withColumn("label", A.enum_label("varchar_value")))
    landed = A.with_image_path_only(A.attach_assets(good, cat.landed_assets))
    known = A.label_in(landed, "label", FV.DRESS_LENGTH_ENUM_ORDER)
    records = known.select(F.col("product_id").alias("productId"), F.col("image_id").alias("_image"),
                            F.col("image_url").alias("imageUrl"),
                            F.col("image_path").alias("imagePath"),
                            F.lit(0).alias("colorNormalId"),
                            F.col("label").alias("dressLengthValue"), "label")
    sinks.write_json_arrays_by_label(records, out_path, cap, ["productId", "_image"], hidden=("_image",))
    return C.first_n_per_label(records, "label", cap, ["productId", "_image"]).drop("_image"), bad


def validate_exports(spark: SparkSession, json_path: str, features: DataFrame,
                     model: SC.SoftmaxModel, out_path: str,
                     rules: dict[str, list[str]] | None = None) -> DataFrame:
    """Job 2b: read the per-label JSON arrays, score the records that have an image path
    and a feature vector (``features``: imagePath, features), keep the top two labels,
    set ``warning`` by the rule table, and write every record back as JSON."""
    recs = SRC.read_json_arrays(spark, json_path).drop("source_file")
    out = check_lengths(recs, features, model, rules)
    sinks.write_json_by_label(out.withColumn("label", F.col("dressLengthValue")), out_path, "label")
    return out


def check_lengths(recs: DataFrame, features: DataFrame, model: SC.SoftmaxModel,
                  rules: dict[str, list[str]] | None = None) -> DataFrame:
    """Every record once, with cvResult, cvScore, cvResult2, cvScore2 and warning where its imagePath
    has a vector. Records are scored in place: several may share an image."""
    vectors = R.one_vector(features.filter("imagePath is not null"), "imagePath")
    top = SC.first_two(SC.score_top(J.spread_join(recs, vectors, "imagePath", "left"), model, 2), model, "cvResult")
    checked = R.length_warning(top, "dressLengthValue", "cvResult1", rules)
    added = {"cvResult": F.col("cvResult1"), "cvScore": R.score_text("score1"), "cvScore2": R.score_text("score2")}
    out = R.only_scored(checked.withColumns(added), ["cvResult", "cvScore", "cvResult2", "cvScore2", "warning"])
    return out.select(*recs.columns, "cvResult", "cvScore", "cvResult2", "cvScore2", "warning")


@dataclass
class TrainingResult:
    model: SC.SoftmaxModel
    metrics: DataFrame
    added_vectors: int


def train_from_index(spark: SparkSession, index: DataFrame, cache_path: str, model_path: str,
                     labels_path: str, input_cols: list[str], factory, model_version: str,
                     dim: int, key_col: str = "key", max_iter: int = 100,
                     validation_pct: float = FV.DEFAULT_VALIDATION_PCT,
                     testing_pct: float = FV.DEFAULT_TESTING_PCT) -> TrainingResult:
    """Job 3: ``index`` is (label, key, *input_cols). Splits by hash, fills the feature
    cache for missing keys, trains on the training split, evaluates every split, and
    writes the model and the label list (class id = rank of the label name)."""
    split = S.assign_split(index, key_col, validation_pct, testing_pct)
    S.check_class_count(split, "label")
    added = FE.fill_cache(spark, split, cache_path, key_col, input_cols, factory, model_version, dim)
    classes = (split.select("label").distinct()
               .withColumn("label_id", (F.dense_rank().over(Window.orderBy("label")) - 1).cast("int")))
    labels = [r["label"] for r in classes.orderBy("label_id").collect()]      # K names
    vectors = (FE.read_cache(spark, cache_path, model_version=model_version)
               .select(F.col("key").alias(key_col), "features"))
    data = (split.select(key_col, "label", "split")
            .join(classes, "label")
            .join(vectors, key_col)
            .withColumnRenamed("label_id", "true_id"))
    model = T.train_lbfgs(data.filter(F.col("split") == "training"), labels, max_iter=max_iter)
    metrics = T.evaluate(data, model, ["split"])
    sinks.write_model(model.to_table(spark), model_path)
    sinks.write_label_list(classes, labels_path)
    return TrainingResult(model, metrics, added)


COLOR_FILE_PATTERN = r"([^/]+?)product\.json$"     # <Colour>product.json
COLOR_RECORD_SCHEMA = "imageName string"


def validate_colors(spark: SparkSession, json_path: str, features: DataFrame,
                    model: SC.SoftmaxModel, out_path: str, literal: bool = True,
                    file_pattern: str = COLOR_FILE_PATTERN,
                    schema: str = COLOR_RECORD_SCHEMA) -> DataFrame:
    """Colour check over per-colour JSON arrays: the expected colour is the file's name
    (``<Colour>product.json``); records whose ``imageName`` has a vector (``features``:
    imageName, features) get color1/score1/color2/score2 (2-decimal text) and ``warning``
    (color1 != lower(expected) when ``literal``, else normalised labels differ); the
    other records pass through unchanged. All colours are checked in one pass."""
    recs = (SRC.read_json_arrays(spark, json_path, schema)
            .withColumn("_expected", F.regexp_extract("source_file", file_pattern, 1))
            .drop("source_file"))
    out = check_colors(recs, "_expected", features, model, literal)
    sinks.write_json_by_label(out.withColumn("colour", F.col("_expected")).drop("_expected"),
                              out_path, "colour")
    return out.drop("_expected")


def check_colors(recs: DataFrame, expected_col: str, features: DataFrame, model: SC.SoftmaxModel,
                 literal: bool = True) -> DataFrame:
    """Every record once, with color1, score1, color2, score2 and warning against its own expected
    colour where its imageName has a vector."""
    vectors = R.one_vector(features.filter("imageName is not null"), "imageName")
    top = SC.first_two(SC.score_top(J.spread_join(recs, vectors, "imageName", "left"), model, 2), model, "color")
    checked = R.color_warning(top, expected_col, "color1", literal=literal)
    text = {"score1": R.score_text("score1"), "score2": R.score_text("score2")}
    out = R.only_scored(checked.withColumns(text), ["color1", "score1", "color2", "score2", "warning"])
    return out.select(*recs.columns, "color1", "score1", "color2", "score2", "warning")
