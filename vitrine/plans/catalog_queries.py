"""Catalogue queries on the test tables, each with its DuckDB oracle SQL."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as FV
from ..functions.urls import DEFAULT_PREFIX, file_name, image_url, role_suffix_map
from ..operators import assets as A
from ..operators import catalog as C
from ..sources.tables import STANDIN_SQL_CTES, Catalogue

# literal parameters of the test workload (FIXTURES.md part 2)
MODULUS = 16
DESC_LIKE = "%ring%"
CATEGORY = "PROMO"
CAP_PER_LABEL = 200
ROW_CAP = 5000


def url_sql(col: str, suffix: str = FV.IMAGE_ROLE_SUFFIX["CPRI"]) -> str:
    return (f"CASE WHEN {col} >= 0 THEN '{DEFAULT_PREFIX}' || "
            f"regexp_replace(lpad(CAST({col} % 100000000 AS VARCHAR), 8, '0'), "
            rf"'(..)(..)(..)(..)', '/\1/\2/\3/\4/') || 'final/' || CAST({col} AS VARCHAR) "
            f"|| '-' || {suffix if suffix.startswith('r.') else repr(suffix)} END")


def enum_sql(col: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FV.DRESS_LENGTH_ENUM.items())
    return f"CASE {col} {whens} END"


def _sql(body: str) -> str:
    return f"WITH {STANDIN_SQL_CTES},\n{body}"


# ---------------------------------------------------------------- published_manifest
def published_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = Catalogue.from_tables(spark, sf_dir)
    rows = C.labelled_images(cat, FV.ATTR_TYPE_CATEGORY, MODULUS)
    return (C.with_image_url(rows)
            .select("product_id", "image_id", F.col("varchar_value").alias("label"),
                    FV.BUCKET_COLUMN, "image_url"))


# a product is eligible if it is in the published state and some channel row of it is live
ELIGIBLE_SQL = """
eligible AS (
  SELECT product_id FROM product
  WHERE state_id = {state} {like}
    AND product_id IN (SELECT product_id FROM channel WHERE publish_flag = 'Y' AND current_flag = 'Y'))
"""
PUBLISHED_CORE_SQL = ELIGIBLE_SQL + """,
labels_of AS (SELECT product_id, varchar_value AS label FROM product_attribute WHERE attribute_type_id = {attr}
              INTERSECT SELECT product_id, varchar_value FROM product_attribute SEMI JOIN eligible USING (product_id)),
core AS (
  SELECT product_id, image_id, label, product_id % {mod} AS id_mod
  FROM (SELECT DISTINCT product_id, image_id FROM product_image) NATURAL JOIN labels_of)
"""


def _core(attr: int, like: str | None = None) -> str:
    like_sql = f"AND product_desc LIKE '{like}'" if like else ""
    return PUBLISHED_CORE_SQL.format(mod=MODULUS, attr=attr, like=like_sql, state=FV.PUBLISHED_STATE_ID)


SQL = {}
SQL["published_manifest"] = _sql(_core(FV.ATTR_TYPE_CATEGORY) + f"""
SELECT product_id, image_id, label, id_mod, {url_sql('image_id')} AS image_url FROM core""")


# ---------------------------------------------------------------- colorway_manifest
def colorway_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = Catalogue.from_tables(spark, sf_dir)
    rows = C.colorway_images(cat, CATEGORY, MODULUS)
    return C.with_image_url(rows).withColumnRenamed("product_type_name", "label")


SQL["colorway_manifest"] = _sql(f"""
wanted AS (SELECT product_id, product_type_id, product_desc, vendor_code FROM product
           WHERE state_id = {FV.PUBLISHED_STATE_ID} AND category = '{CATEGORY}'),
colour_of AS (SELECT DISTINCT product_id, product_colorway_id FROM upc
              WHERE product_id IN (SELECT product_id FROM wanted)
                AND product_colorway_id IN (SELECT product_colorway_id FROM product_colorway)),
shown AS (SELECT c.product_id, i.image_id, i.product_id % {MODULUS} AS id_mod
          FROM colour_of c, product_colorway_image l, image i
          WHERE l.product_colorway_id = c.product_colorway_id AND i.product_image_id = l.product_image_id),
described AS (SELECT w.product_id, w.product_desc, w.vendor_code, t.product_type_name AS label,
                     t.short_description, t.product_type_description
              FROM product_type t, wanted w WHERE t.product_type_id = w.product_type_id)
SELECT DISTINCT product_id, product_desc, vendor_code, image_id, label, short_description, product_type_description,
       id_mod, {url_sql('image_id')} AS image_url
FROM described NATURAL JOIN shown""")


# ---------------------------------------------------------------- dress-length export
def _length_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = Catalogue.from_tables(spark, sf_dir)
    rows = C.labelled_images(cat, FV.ATTR_TYPE_DRESS_LENGTH, MODULUS, desc_like=DESC_LIKE)
    return C.with_image_url(rows).withColumn("label", A.enum_label("varchar_value"))


def attribute_label_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = A.split_quarantine(_length_rows(spark, sf_dir))
    return good


def unmapped_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = A.split_quarantine(_length_rows(spark, sf_dir))
    return bad


_LENGTH_SELECT = (f"SELECT product_id, image_id, label AS varchar_value, id_mod, "
                  f"{url_sql('image_id')} AS image_url, {enum_sql('label')} AS label FROM core")
SQL["attribute_label_manifest"] = _sql(_core(FV.ATTR_TYPE_DRESS_LENGTH, DESC_LIKE) + f"""
SELECT * FROM ({_LENGTH_SELECT}) WHERE label IS NOT NULL""")
SQL["unmapped_labels"] = _sql(_core(FV.ATTR_TYPE_DRESS_LENGTH, DESC_LIKE) + f"""
SELECT * FROM ({_LENGTH_SELECT}) WHERE label IS NULL""")


def _asset_path_sql(label: str, fname: str) -> str:
    return (f"CASE WHEN has_asset THEN '{A.DEFAULT_ASSET_ROOT}/' || "
            f"replace(replace({label}, '%', '%25'), '/', '%2F') || '/' || {fname} END")


def landed_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = attribute_label_manifest(spark, sf_dir)
    cat = Catalogue.from_tables(spark, sf_dir)
    landed = A.with_image_path_only(A.attach_assets(good, cat.landed_assets))
    return A.label_in(landed, "label", FV.DRESS_LENGTH_ENUM_ORDER)


def capped_per_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    capped = C.first_n_per_label(landed_lengths(spark, sf_dir), "label", CAP_PER_LABEL, ["product_id", "image_id"])
    return capped.select("label", "product_id", "image_id", "image_url", "image_path")


SQL["capped_per_label"] = _sql(_core(FV.ATTR_TYPE_DRESS_LENGTH, DESC_LIKE) + f""",
good AS (SELECT * FROM ({_LENGTH_SELECT}) WHERE label IS NOT NULL),
att AS (SELECT g.*, split_part(g.image_url, '/', -1) AS file_name,
               (SELECT count(*) > 0 FROM landed_assets la
                WHERE la.file_name = split_part(g.image_url, '/', -1)) AS has_asset
        FROM good g),
landed AS (SELECT label, product_id, image_id, image_url,
                  {_asset_path_sql('label', 'file_name')} AS image_path
           FROM att WHERE has_asset AND lower(label) IN
             ({", ".join(repr(x.lower()) for x in FV.DRESS_LENGTH_ENUM_ORDER)}))
SELECT label, product_id, image_id, image_url, image_path FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY product_id, image_id) AS rn
  FROM landed) WHERE rn <= {CAP_PER_LABEL}""")


def capped_then_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = Catalogue.from_tables(spark, sf_dir)
    rows = C.joined_rows_with_copies(cat, FV.ATTR_TYPE_DRESS_LENGTH, MODULUS, desc_like=DESC_LIKE)
    return C.cap_then_distinct(rows, ROW_CAP, ["product_id", "image_id", "varchar_value", FV.BUCKET_COLUMN])


# every channel row of an eligible product repeats its images
SQL["capped_then_distinct"] = _sql(ELIGIBLE_SQL.format(state=FV.PUBLISHED_STATE_ID, like=f"AND product_desc LIKE '{DESC_LIKE}'") + f""",
live AS (SELECT product_id FROM channel SEMI JOIN eligible USING (product_id)
         WHERE publish_flag = 'Y' AND current_flag = 'Y'),
valued AS (SELECT product_id, varchar_value FROM product_attribute WHERE attribute_type_id = {FV.ATTR_TYPE_DRESS_LENGTH}),
repeated AS (SELECT product_id, image_id, varchar_value, product_id % {MODULUS} AS id_mod
             FROM live NATURAL JOIN valued NATURAL JOIN product_image
             ORDER BY ALL LIMIT {ROW_CAP})
SELECT DISTINCT * FROM repeated""")


# ---------------------------------------------------------------- role_urls
def role_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = Catalogue.from_tables(spark, sf_dir)
    ids = cat.product_image.select("image_id").distinct()
    roles = ids.select("image_id", F.explode(role_suffix_map()).alias("role", "suffix"))
    return (roles.withColumn("image_url", image_url("image_id", F.col("suffix")))
            .withColumn("file_name", file_name("image_url")))


SQL["role_urls"] = _sql(f"""
ids AS (SELECT DISTINCT image_id FROM product_image),
roles AS (SELECT * FROM (VALUES {", ".join(f"('{r}', '{s}')" for r, s in FV.IMAGE_ROLE_SUFFIX.items())})
          AS r(role, suffix)),
u AS (SELECT image_id, role, suffix, {url_sql('image_id', 'r.suffix')} AS image_url
      FROM ids CROSS JOIN roles r)
SELECT image_id, role, suffix, image_url, split_part(image_url, '/', -1) AS file_name FROM u""")


# ---------------------------------------------------------------- asset_attach
def asset_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    cat = Catalogue.from_tables(spark, sf_dir)
    manifest = published_manifest(spark, sf_dir)
    return A.attach_assets(manifest, cat.landed_assets)


SQL["asset_attach"] = _sql(_core(FV.ATTR_TYPE_CATEGORY) + f""",
m AS (SELECT product_id, image_id, label, id_mod, {url_sql('image_id')} AS image_url FROM core),
la AS (SELECT DISTINCT file_name FROM landed_assets),
att AS (SELECT m.*, split_part(m.image_url, '/', -1) AS file_name,
               la.file_name IS NOT NULL AS has_asset
        FROM m LEFT JOIN la ON la.file_name = split_part(m.image_url, '/', -1))
SELECT product_id, image_id, label, id_mod, image_url, file_name, has_asset,
       {_asset_path_sql('label', 'file_name')} AS image_path FROM att""")


QUERIES = {
    "published_manifest": published_manifest,
    "colorway_manifest": colorway_manifest,
    "attribute_label_manifest": attribute_label_manifest,
    "unmapped_labels": unmapped_labels,
    "capped_per_label": capped_per_label,
    "capped_then_distinct": capped_then_distinct,
    "role_urls": role_urls,
    "asset_attach": asset_attach,
}
