"""Sink -> source round trips over data Spark derives from the test tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import fixed_values as FV
from .. import sinks
from ..functions.text import normalize_label
from ..operators import rules as R
from ..operators import scoring as SC
from ..session import scratch_path
from ..sources import files as SRC
from ..sources.tables import STANDIN_SQL_CTES, Catalogue, read_table
from . import catalog_queries as CQ
from . import scoring_queries as SQ

SQL: dict[str, str] = {}


def json_label_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capped per-label manifest -> JSON per label -> read back with the manifest schema."""
    records = CQ.landed_lengths(spark, sf_dir).select(
        F.col("product_id").alias("productId"), F.col("image_id").alias("_image"),
        F.col("image_url").alias("imageUrl"),
        F.col("image_path").alias("imagePath"),
        F.lit(0).alias("colorNormalId"),
        F.col("label").alias("dressLengthValue"),
        F.col("label"))
    path = scratch_path(spark, "json-export")
    sinks.write_json_arrays_by_label(records, path, CQ.CAP_PER_LABEL, ["productId", "_image"], hidden=("_image",))
    back = SRC.read_json_arrays(spark, path, array_files=True, other_keys=False)
    return back.select("productId", "imageUrl", "imagePath", "colorNormalId", "dressLengthValue",
                       "label", F.col("imagePath").isNotNull().alias("has_path"))


SQL["json_label_export"] = CQ.SQL["capped_per_label"].replace(
    "SELECT label, product_id, image_id, image_url, image_path FROM (",
    "SELECT product_id AS productId, image_url AS imageUrl, image_path AS imagePath, "
    "0 AS colorNormalId, label AS dressLengthValue, label, image_path IS NOT NULL AS has_path FROM (")


def validated_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated predictions with 2-decimal score text -> JSON by source label -> back."""
    t = SC.first_two(SQ.scored(spark, sf_dir), SQ.model(), "cvResult")
    out = (R.length_warning(t, "source_label", "cvResult1")
           .select("vec_id", "source_label", F.col("cvResult1").alias("cvResult"),
                   R.score_text("score1").alias("cvScore"), F.col("cvResult2"),
                   R.score_text("score2").alias("cvScore2"), "warning"))
    path = scratch_path(spark, "validated-json")
    sinks.write_json_by_label(out, path, "source_label")
    schema = "vec_id bigint, cvResult string, cvScore string, cvResult2 string, cvScore2 string, warning boolean"
    back = spark.read.schema(schema).json(path)
    return back.select("vec_id", "source_label", "cvResult", "cvScore", "cvResult2", "cvScore2", "warning")


SQL["validated_json"] = SQ.SQL["validated_predictions"].replace(
    f"""SELECT two.vec_id, truth.source_label, label1, round(score1, {SQ.DEC}) AS score1, label2,
       round(score2, {SQ.DEC}) AS score2,""",
    """SELECT two.vec_id, truth.source_label, label1 AS cvResult, printf('%.2f', score1) AS cvScore,
       label2 AS cvResult2, printf('%.2f', score2) AS cvScore2,""")


def label_list_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class list from the catalogue's dress-length texts -> label file -> read back."""
    cat = Catalogue.from_tables(spark, sf_dir)
    labels = (cat.product_attribute.filter(F.col("attribute_type_id") == FV.ATTR_TYPE_DRESS_LENGTH)
              .select(normalize_label("varchar_value").alias("label")).distinct()
              .withColumn("label_id", (F.dense_rank().over(Window.orderBy("label")) - 1).cast("int")))
    path = scratch_path(spark, "labels")
    sinks.write_label_list(labels, path)
    return SRC.read_label_list(spark, path)


SQL["label_list_roundtrip"] = f"""WITH {STANDIN_SQL_CTES},
l AS (SELECT DISTINCT regexp_replace(lower(varchar_value), '[^a-z0-9]+', ' ', 'g') AS label
      FROM product_attribute WHERE attribute_type_id = {FV.ATTR_TYPE_DRESS_LENGTH})
SELECT CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS label_id, label FROM l"""


def landing_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asset-attached manifest landed partitioned by label, read back."""
    m = CQ.asset_attach(spark, sf_dir).select("product_id", "image_id", "image_url",
                                              "image_path", "label")
    path = scratch_path(spark, "landing")
    sinks.land_by_label(m, path, "label")
    return sinks.read_landing(spark, path, m.schema)


SQL["landing_by_label"] = CQ.SQL["asset_attach"].replace(
    "SELECT product_id, image_id, label, id_mod, image_url, file_name, has_asset,\n"
    "       CASE WHEN has_asset",
    "SELECT product_id, image_id, label, image_url,\n"
    "       CASE WHEN has_asset")


# ---------------------------------------------------------------- two-hop class lookup
NAMELESS = 7                                 # of so many parts one has no name line


def _lookup_files(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Spark-derived lookup files in the classifier formats, a record for each part:
    ``target_class`` / ``target_class_string`` line pairs for all of them, and ``uid<TAB>name`` lines
    for those whose key ``NAMELESS`` doesn't divide (the others make the error report)."""
    part = read_table(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias("c"), "p_name")
    uid = F.concat(F.lit("n"), F.lpad(F.col("c").cast("string"), 8, "0"))
    names_path, map_path = scratch_path(spark, "synsets"), scratch_path(spark, "class-map")
    part.filter(F.col("c") % NAMELESS != 0).select(F.concat_ws("\t", uid, "p_name").alias("value")).write.text(names_path)
    (part.select(F.concat(F.lit("entry {\n  target_class: "), F.col("c").cast("string"),
                          F.lit('\n  target_class_string: "'), uid, F.lit('"\n}')).alias("value"))
     .write.text(map_path))
    return names_path, map_path


def label_two_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import lookup as LK
    names_path, map_path = _lookup_files(spark, sf_dir)
    ok, _ = LK.two_hop_labels(SRC.read_class_uids(spark, map_path), SRC.read_synset_names(spark, names_path))
    return ok


def label_two_hop_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import lookup as LK
    names_path, map_path = _lookup_files(spark, sf_dir)
    _, missing = LK.two_hop_labels(SRC.read_class_uids(spark, map_path), SRC.read_synset_names(spark, names_path))
    return missing


SQL["label_two_hop"] = f"""
SELECT CAST(p_partkey AS INTEGER) AS class_id, p_name AS label FROM part WHERE p_partkey % {NAMELESS} <> 0"""
SQL["label_two_hop_missing"] = f"""
SELECT CAST(p_partkey AS INTEGER) AS class_id, 'n' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS uid
FROM part WHERE p_partkey % {NAMELESS} = 0"""


# ---------------------------------------------------------------- record checks
def _path_vectors(spark: SparkSession, sf_dir: str, key_col: str, key) -> DataFrame:
    """Vectors by file: those of the embeddings, so that images without one are not scored."""
    emb = SQ.features(spark, sf_dir).select("vec_id", "features")
    return emb.select(key(F.col("vec_id")).alias(key_col), "features")


def _scores_sql(extra: str) -> str:
    """label1, score1, label2, score2 of each vector, then ``extra``."""
    return f"""WITH {SQ.LOGITS_SQL},
ranked AS (SELECT vec_id, score, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, class_id DESC) AS place,
                  {SQ._case('class_id', FV.SHIPPED_LABELS)} AS label FROM p),
two AS (SELECT a.vec_id, a.label AS label1, printf('%.2f', a.score) AS score1, b.label AS label2, printf('%.2f', b.score) AS score2
        FROM ranked a JOIN ranked b USING (vec_id) WHERE a.place = 1 AND b.place = 2), {extra}"""


def validated_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all orders' lines as JSON arrays, several to an image, many without an image file or
    a vector, with a key of their own; read back, scored in place and checked: each record once."""
    from . import flows as FL

    lines = read_table(spark, sf_dir, "lineitem")
    order = F.col("l_orderkey")
    source = F.element_at(F.array(*[F.lit(x) for x in FV.DRESS_LENGTH_CHECK_ORDER]), (F.col("l_partkey") % 5 + 1).cast("int"))
    records = lines.select(
        F.col("l_partkey").cast("bigint").alias("productId"),
        F.when(order % 7 != 0, F.concat(F.lit("img/"), order.cast("string"))).alias("imagePath"),
        source.alias("dressLengthValue"), F.col("l_linenumber").alias("line"), order.cast("bigint").alias("order"),
        F.col("l_returnflag").alias("returnFlag"), F.concat(F.lit("f"), F.pmod(order, F.lit(16)).cast("string")).alias("file"))
    path = scratch_path(spark, "check-export")
    sinks.write_json_by_label(records, path, "file")
    recs = SRC.read_json_arrays(spark, path, array_files=False).drop("source_file")
    vectors = _path_vectors(spark, sf_dir, "imagePath", lambda v: F.concat(F.lit("img/"), v.cast("string")))
    out = FL.check_lengths(recs, vectors, SQ.model())
    return out.select(F.col("order").alias("order_id"), F.col("line").cast("bigint").alias("line"), "productId", "imagePath",
                      "dressLengthValue", "returnFlag", "cvResult", "cvScore", "cvResult2", "cvScore2", "warning")


def _accepted_sql() -> str:
    return " ".join(f"WHEN '{s}' THEN label1 NOT IN ({', '.join(map(repr, a))})" for s, a in FV.LENGTH_RULES.items())


SQL["validated_export"] = _scores_sql(f"""
recs AS (SELECT CAST(l_orderkey AS BIGINT) AS order_id, CAST(l_linenumber AS BIGINT) AS line, CAST(l_partkey AS BIGINT) AS "productId",
                CASE WHEN l_orderkey % 7 <> 0 THEN 'img/' || l_orderkey END AS "imagePath",
                {SQ._case('l_partkey % 5', FV.DRESS_LENGTH_CHECK_ORDER)} AS "dressLengthValue", l_returnflag AS "returnFlag" FROM lineitem)
SELECT r.*, label1 AS "cvResult", score1 AS "cvScore", label2 AS "cvResult2", score2 AS "cvScore2",
       CASE WHEN label1 IS NOT NULL THEN CASE "dressLengthValue" {_accepted_sql()} END END AS warning
FROM recs r LEFT JOIN two ON r."imagePath" = 'img/' || two.vec_id""")


CHECK_COLORS = FV.COLOR_PALETTE[:3]


def color_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-colour JSON files from the customers, an image in every colour's file; each record is checked
    against its own file's colour, and keeps the keys that the check doesn't know."""
    from . import flows as FL

    cust = read_table(spark, sf_dir, "customer")
    recs = cust.select(F.concat(F.col("c_custkey").cast("string"), F.lit(".jpg")).alias("imageName"),
                       F.col("c_mktsegment").alias("brand"),
                       F.explode(F.array(*[F.lit(c) for c in CHECK_COLORS])).alias("colour"))
    path = scratch_path(spark, "check-colours")
    sinks.write_json_by_label(recs, path, "colour")
    back = (SRC.read_json_arrays(spark, path, FL.COLOR_RECORD_SCHEMA, array_files=False).drop("source_file")
            .withColumnRenamed("colour", "_expected"))
    vectors = _path_vectors(spark, sf_dir, "imageName", lambda v: F.concat(v.cast("string"), F.lit(".jpg")))
    return FL.check_colors(back, "_expected", vectors, _color_model()).withColumnRenamed("_expected", "expected")


def _color_model() -> SC.SoftmaxModel:
    return SC.fixed_model([c.lower() for c in FV.COLOR_PALETTE[:SQ.K]], SQ.DIM)


SQL["color_validation"] = _scores_sql(f"""
named AS (SELECT vec_id, {SQ._case('c1', [c.lower() for c in FV.COLOR_PALETTE[:SQ.K]])} AS color1, score1,
                 {SQ._case('c2', [c.lower() for c in FV.COLOR_PALETTE[:SQ.K]])} AS color2, score2
          FROM (SELECT *, list_position({FV.SHIPPED_LABELS}, label1) - 1 AS c1, list_position({FV.SHIPPED_LABELS}, label2) - 1 AS c2
                FROM two)),
recs AS (SELECT c_custkey || '.jpg' AS "imageName", c_mktsegment AS brand, unnest({CHECK_COLORS}) AS expected, c_custkey FROM customer)
SELECT "imageName", brand, expected, color1, score1, color2, score2, color1 <> lower(expected) AS warning
FROM recs LEFT JOIN named ON named.vec_id = recs.c_custkey""")


# ---------------------------------------------------------------- image folders
LISTED_ROWS = 2_000                          # customers' lines in a file, about


def image_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that Spark writes from the customers, a folder for each market segment and a file for every
    ``LISTED_ROWS`` customers or so of it, listed as image folders are, with their bytes attached again by
    path, to the listing and to rows of a path that is not there."""
    cust = read_table(spark, sf_dir, "customer")
    path = scratch_path(spark, "images")
    share = F.pmod(F.xxhash64("c_custkey"), F.lit(max(1, cust.count() // (5 * LISTED_ROWS))))
    (cust.select(F.col("c_mktsegment").alias("folder"), F.col("c_custkey").cast("string").alias("value"), share.alias("share"))
     .repartition("folder", "share").drop("share").write.partitionBy("folder").text(path))
    listing = SRC.list_images(spark, path, extensions=["txt"])
    absent = listing.groupBy("label", "dir").agg(F.concat(F.lit(path), F.lit("/none/"), F.first("dir")).alias("path"),
                                                 F.lit("part-none").alias("base_name"), F.lit(0).cast("bigint").alias("length"))
    rows = listing.unionByName(absent)
    whole = SRC.attach_image_bytes(rows, spark, path, "path", extensions=["txt"])
    return (whole.groupBy("label", "dir").agg(F.sum("length").alias("n_bytes"),
                                              F.sum(F.octet_length("content").cast("bigint")).alias("n_content"),
                                              F.count(F.when(F.col("content").isNull(), 1)).alias("n_absent"),
                                              F.min(F.col("base_name").startswith("part-")).alias("is_part")))


SQL["image_listing"] = """
SELECT regexp_replace(lower('folder=' || c_mktsegment), '[^a-z0-9]+', ' ', 'g') AS label, 'folder=' || c_mktsegment AS dir,
       CAST(sum(length(CAST(c_custkey AS VARCHAR)) + 1) AS BIGINT) AS n_bytes,
       CAST(sum(length(CAST(c_custkey AS VARCHAR)) + 1) AS BIGINT) AS n_content, CAST(1 AS BIGINT) AS n_absent, true AS is_part
FROM customer GROUP BY c_mktsegment"""


QUERIES = {
    "label_two_hop": label_two_hop,
    "label_two_hop_missing": label_two_hop_missing,
    "json_label_export": json_label_export,
    "validated_json": validated_json,
    "validated_export": validated_export,
    "color_validation": color_validation,
    "image_listing": image_listing,
    "label_list_roundtrip": label_list_roundtrip,
    "landing_by_label": landing_by_label,
}
