"""Label normalisation and hash splits on the test tables, with oracle SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as FV
from ..functions.text import base_name, cache_path, join_path, label_from_path, normalize_label
from ..operators import splits as S
from ..sources.tables import STANDIN_SQL_CTES, Catalogue, read_table

SQL: dict[str, str] = {}


def document_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in image index: label = language folder, key = source/doc_id."""
    docs = read_table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        F.col("lang").alias("label"),
        F.concat_ws("/", F.col("source"), F.col("doc_id").cast("string")).alias("key"))


INDEX_SQL = ("idx_ AS (SELECT doc_id, lang AS label, source || '/' || CAST(doc_id AS VARCHAR) AS key "
             "FROM documents)")
SPLIT_SQL = f"""
sp AS (SELECT *, regexp_replace(key, '_nohash_.*$', '') AS group_key FROM idx_),
pc AS (SELECT *, CAST(('0x' || right(sha1(group_key), 4))::INTEGER AS DOUBLE)
                 * (CAST(100 AS DOUBLE) / CAST(65535.0 AS DOUBLE)) AS pct FROM sp),
splitted AS (SELECT *, CASE WHEN pct < {float(FV.DEFAULT_VALIDATION_PCT)} THEN 'validation'
                            WHEN pct < {float(FV.DEFAULT_VALIDATION_PCT + FV.DEFAULT_TESTING_PCT)}
                                 THEN 'testing'
                            ELSE 'training' END AS split FROM pc)"""


def label_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = Catalogue.from_tables(spark, sf_dir)
    attr = (cat.product_attribute.select(F.lit("attribute").alias("origin"),
                                         F.col("varchar_value").alias("raw"))
            .filter(F.col("raw").isNotNull()).distinct())
    pages = read_table(spark, sf_dir, "pages").select(F.lit("page").alias("origin"),
                                                      F.col("url").alias("raw"))
    return (attr.unionByName(pages)
            .withColumn("label", normalize_label("raw")))


SQL["label_normalize"] = f"""WITH {STANDIN_SQL_CTES},
src AS (SELECT DISTINCT 'attribute' AS origin, varchar_value AS raw FROM product_attribute
        WHERE varchar_value IS NOT NULL
        UNION ALL SELECT 'page', url FROM pages)
SELECT origin, raw, regexp_replace(lower(raw), '[^a-z0-9]+', ' ', 'g') AS label FROM src"""


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.assign_split(document_index(spark, sf_dir), "key")


SQL["hash_split"] = f"WITH {INDEX_SQL}, {SPLIT_SQL}\nSELECT * FROM splitted"


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.split_counts(hash_split(spark, sf_dir), "label")


SQL["split_counts"] = f"""WITH {INDEX_SQL}, {SPLIT_SQL},
per AS (SELECT label, count(*) AS n_images,
               CAST(sum(CAST(split = 'training' AS BIGINT)) AS BIGINT) AS n_training,
               CAST(sum(CAST(split = 'testing' AS BIGINT)) AS BIGINT) AS n_testing,
               CAST(sum(CAST(split = 'validation' AS BIGINT)) AS BIGINT) AS n_validation
        FROM splitted GROUP BY label)
SELECT *, n_images < {FV.SMALL_FOLDER_THRESHOLD} AS small, count(*) OVER () AS n_classes FROM per"""


def split_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.indexed_split_lists(hash_split(spark, sf_dir), "label", "key")


SQL["split_lists"] = f"""WITH {INDEX_SQL}, {SPLIT_SQL}
SELECT label, split, key,
       row_number() OVER (PARTITION BY label, split ORDER BY key) - 1 AS idx FROM splitted"""


def variant_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants of a key share its split: each document's key with two ``_nohash_`` endings."""
    keys = document_index(spark, sf_dir).withColumn("variant", F.explode(F.array(F.lit("_nohash_0"), F.lit("_nohash_b_nohash_1"))))
    return S.assign_split(keys.withColumn("key", F.concat("key", "variant")).drop("variant"), "key")


SQL["variant_split"] = f"""WITH idx_ AS (
  SELECT doc_id, lang AS label, source || '/' || CAST(doc_id AS VARCHAR) || unnest(['_nohash_0', '_nohash_b_nohash_1']) AS key
  FROM documents), {SPLIT_SQL}
SELECT * FROM splitted"""


def image_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of files below label folders, the cache file of each, and folder and name parsed back."""
    docs = read_table(spark, sf_dir, "documents")
    path = join_path(F.lit("images"), "lang", F.concat("source", F.lit("-"), F.col("doc_id").cast("string"), F.lit(".jpg")))
    paths = docs.select("doc_id", path.alias("path"))
    return paths.select("doc_id", "path", cache_path("path").alias("cache"), label_from_path("path").alias("label"),
                        base_name("path").alias("name"))


SQL["image_paths"] = """
SELECT doc_id, 'images/' || lang || '/' || source || '-' || doc_id || '.jpg' AS path,
       'images/' || lang || '/' || source || '-' || doc_id || '.jpg.txt' AS cache, lang AS label,
       source || '-' || doc_id || '.jpg' AS name FROM documents"""


QUERIES = {
    "variant_split": variant_split,
    "image_paths": image_paths,
    "label_normalize": label_normalize,
    "hash_split": hash_split,
    "split_counts": split_counts,
    "split_lists": split_lists,
}
