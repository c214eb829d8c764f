"""The three end-to-end flows on the smallest test tables."""
import os

from pyspark.sql import functions as F

from vitrine import fixed_values as FV
from vitrine.operators import features as FE
from vitrine.operators import scoring as SC
from vitrine.plans import flows
from vitrine.sources import files as SRC
from vitrine.sources.tables import Catalogue, read_table

SF = "/root/testdata/sf0.001"


def test_land_training_images(spark, tmp_dir):
    cat = Catalogue.from_tables(spark, SF)
    out = flows.land_training_images(cat, os.path.join(tmp_dir, "landing"))
    assert out.count() == 1919
    assert out.filter(F.col("has_asset") != F.col("image_path").isNotNull()).count() == 0


def test_export_and_validate(spark, tmp_dir):
    cat = Catalogue.from_tables(spark, SF)
    json_dir = os.path.join(tmp_dir, "json")
    exported, quarantined = flows.export_length_json(cat, json_dir, desc_like="%ring%", cap=20)
    n_exp = exported.count()
    per_label = {r.label: r["count"] for r in exported.groupBy("label").count().collect()}
    assert n_exp > 0 and max(per_label.values()) <= 20 and quarantined.count() > 0
    # stand-in vectors derived by Spark from the exported URLs
    recs = SRC.read_json_arrays(spark, json_dir).select("imagePath", "imageUrl")
    vec_path = os.path.join(tmp_dir, "vec")
    FE.fill_cache(spark, recs.withColumnRenamed("imagePath", "k"), vec_path, "k", ["imageUrl"],
                  FE.text_histogram_factory(16), "v", 16)
    feats = FE.read_cache(spark, vec_path).select(F.col("key").alias("imagePath"), "features")
    model = SC.fixed_model(FV.SHIPPED_LABELS, 16)
    out = flows.validate_exports(spark, json_dir, feats, model, os.path.join(tmp_dir, "validated"))
    rows = out.collect()
    assert len(rows) == n_exp
    assert all(r.cvResult in FV.SHIPPED_LABELS and r.warning is not None for r in rows)
    back = spark.read.json(os.path.join(tmp_dir, "validated"))
    assert back.count() == n_exp


def test_train_from_index(spark, tmp_dir):
    docs = read_table(spark, SF, "documents").select(
        F.col("lang").alias("label"), F.col("doc_id").cast("string").alias("key"), "text")
    res = flows.train_from_index(spark, docs, os.path.join(tmp_dir, "cache"), os.path.join(tmp_dir, "model"),
                                 os.path.join(tmp_dir, "labels"), ["text"], FE.text_histogram_factory(32),
                                 "v1", 32, max_iter=20)
    assert res.added_vectors == docs.count()
    labels = [r.label for r in SRC.read_label_list(spark, os.path.join(tmp_dir, "labels")).orderBy("label_id").collect()]
    assert labels == res.model.labels == sorted(labels)
    m = {r.split: r for r in res.metrics.collect()}
    assert set(m) <= {"training", "testing", "validation"} and m["training"].accuracy > 0
    assert SC.SoftmaxModel.from_table(spark.read.parquet(os.path.join(tmp_dir, "model"))).labels == labels


def test_validate_colors(spark, tmp_dir):
    import json as _json
    src = os.path.join(tmp_dir, "colors")
    os.makedirs(src)
    with open(os.path.join(src, "Blackproduct.json"), "w") as f:
        _json.dump([{"imageName": "a.jpg", "brand": "x"}, {"imageName": "missing.jpg"}], f)
    with open(os.path.join(src, "Ivory_Creamproduct.json"), "w") as f:
        _json.dump([{"imageName": "b.jpg"}], f)
    labels = ["black", "ivory cream", "red"]
    model = SC.fixed_model(labels, 4)
    feats = spark.createDataFrame([("a.jpg", [1.0, 0.0, 0.0, 0.0]), ("b.jpg", [0.0, 1.0, 0.0, 0.0])],
                                  "imageName string, features array<float>")
    out = flows.validate_colors(spark, src, feats, model, os.path.join(tmp_dir, "out"),
                                schema="imageName string, brand string")
    rows = {r.imageName: r for r in out.collect()}
    assert set(rows) == {"a.jpg", "missing.jpg", "b.jpg"}
    assert rows["missing.jpg"].color1 is None and rows["missing.jpg"].warning is None
    assert rows["a.jpg"].brand == "x" and rows["a.jpg"].color1 in labels
    assert rows["a.jpg"].warning == (rows["a.jpg"].color1 != "black")
    assert rows["b.jpg"].warning == (rows["b.jpg"].color1 != "ivory_cream")   # literal compare
    back = spark.read.json(os.path.join(tmp_dir, "out"))
    assert back.count() == 3
