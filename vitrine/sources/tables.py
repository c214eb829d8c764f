"""Parquet table access and the catalogue views the jobs run on.

The catalogue jobs read a relational catalogue (product, image, attribute, channel, type,
UPC, colourway tables). ``Catalogue`` is a set of DataFrames with exactly the column
names those jobs use. ``Catalogue.from_tables`` builds it from the TPC-H style test tables
(mapping in FIXTURES.md part 2); ``Catalogue.from_jdbc`` / any other constructor can
supply the same views from a real database.

Every view is a lazy projection/filter of a scan, so Catalyst prunes columns and pushes
filters into the parquet reader through them.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as FV

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one table, with the files there are now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# p_type -> dress-length attribute text; PROMO deliberately has no enum (quarantine path)
STANDIN_LENGTH_TEXT = {
    "ECONOMY": "Mini",
    "SMALL": "Above the Knee",
    "STANDARD": "Knee Length",
    "MEDIUM": "Midi/Tea Length",
    "LARGE": "Long/Maxi",
    "PROMO": "Other",
}


def _case_map(col: Column, mapping: dict[str, str]) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr


class Catalogue:
    """The catalogue views. Each view is built on first use only."""

    VIEWS = ("product", "product_attribute", "product_image", "channel", "product_type", "upc",
             "product_colorway", "product_colorway_image", "image", "landed_assets")

    def __init__(self, builders: dict):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in self.VIEWS:
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    @classmethod
    def from_frames(cls, **frames: DataFrame) -> "Catalogue":
        """Views supplied directly (e.g. JDBC subquery scans)."""
        return cls({k: (lambda v=v: v) for k, v in frames.items()})

    @classmethod
    def from_jdbc(cls, spark: SparkSession, profile: dict[str, str], num_partitions: int | None = None,
                  tables: dict[str, tuple[str, str]] | None = None,
                  assets: DataFrame | None = None, image: DataFrame | None = None) -> "Catalogue":
        """Views read from a relational catalogue: each table is a bucketed subquery scan
        (``mod(key, N)`` split into N partitions). ``tables`` maps view -> (table, split
        column). Columns come as the database has them, so that filters reach it; the
        operators narrow the ids they return. The landed-asset listing comes from elsewhere
        (files); ``image`` replaces the image table if given."""
        from .jdbc import CATALOGUE_TABLES, read_table_bucketed

        spec = dict(CATALOGUE_TABLES, **(tables or {}))

        def view(name: str):
            def build() -> DataFrame:
                table, split = spec[name]
                return read_table_bucketed(spark, profile, table, split, num_partitions)
            return build

        builders = {name: view(name) for name in spec}
        if assets is not None:
            builders["landed_assets"] = lambda: assets
        if image is not None:
            builders["image"] = lambda: image
        return cls(builders)

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str) -> "Catalogue":
        def t(name: str) -> DataFrame:
            return read_table(spark, sf_dir, name)

        def product():
            return t("part").select(
                F.col("p_partkey").cast("bigint").alias("product_id"),
                F.col("p_name").alias("product_desc"),
                F.col("p_brand").alias("vendor_code"),
                (F.col("p_size") % 25).cast("bigint").alias("product_type_id"),
                (F.col("p_size") % 3).cast("bigint").alias("state_id"),
                F.col("p_type").alias("category"))

        def product_attribute():
            # entity-attribute-value table: two attribute rows per product
            part = t("part")
            attr_category = part.select(
                F.col("p_partkey").cast("bigint").alias("product_id"),
                F.lit(FV.ATTR_TYPE_CATEGORY).cast("bigint").alias("attribute_type_id"),
                F.col("p_type").alias("varchar_value"))
            attr_length = part.select(
                F.col("p_partkey").cast("bigint").alias("product_id"),
                F.lit(FV.ATTR_TYPE_DRESS_LENGTH).cast("bigint").alias("attribute_type_id"),
                _case_map(F.col("p_type"), STANDIN_LENGTH_TEXT).alias("varchar_value"))
            return attr_category.unionByName(attr_length)

        def product_image():
            return t("lineitem").select(F.col("l_partkey").cast("bigint").alias("product_id"),
                                        F.col("l_orderkey").cast("bigint").alias("image_id"))

        def channel():
            return t("lineitem").select(
                F.col("l_partkey").cast("bigint").alias("product_id"),
                F.when(F.col("l_returnflag") == "A", "Y").otherwise("N").alias("publish_flag"),
                F.when(F.col("l_linestatus") == "O", "Y").otherwise("N").alias("current_flag"))

        def product_type():
            return t("nation").select(
                F.col("n_nationkey").cast("bigint").alias("product_type_id"),
                F.col("n_name").alias("product_type_name"),
                F.col("n_name").alias("short_description"),
                F.col("n_name").alias("product_type_description"))

        def upc():
            return t("lineitem").select(F.col("l_partkey").cast("bigint").alias("product_id"),
                                        F.col("l_orderkey").cast("bigint").alias("product_colorway_id"))

        def product_colorway():
            return t("orders").select(F.col("o_orderkey").cast("bigint").alias("product_colorway_id"))

        def product_colorway_image():
            return t("orders").select(F.col("o_orderkey").cast("bigint").alias("product_colorway_id"),
                                      F.col("o_custkey").cast("bigint").alias("product_image_id"))

        def image():
            return t("customer").select(F.col("c_custkey").cast("bigint").alias("product_image_id"),
                                        F.col("c_nationkey").cast("bigint").alias("product_id"),
                                        F.col("c_custkey").cast("bigint").alias("image_id"))

        def landed_assets():
            return t("orders").filter(F.col("o_orderstatus") == "F").select(
                F.concat(F.col("o_orderkey").cast("string"),
                         F.lit("-" + FV.IMAGE_ROLE_SUFFIX["CPRI"])).alias("file_name"))

        return cls(dict(product=product, product_attribute=product_attribute,
                       product_image=product_image, channel=channel, product_type=product_type,
                       upc=upc, product_colorway=product_colorway,
                       product_colorway_image=product_colorway_image, image=image,
                       landed_assets=landed_assets))


# SQL text of the same views, for the DuckDB oracle (kept beside the DataFrame form).
STANDIN_SQL_CTES = """
product AS (SELECT CAST(p_partkey AS BIGINT) AS product_id, p_name AS product_desc,
                   p_brand AS vendor_code, CAST(p_size % 25 AS BIGINT) AS product_type_id,
                   CAST(p_size % 3 AS BIGINT) AS state_id, p_type AS category FROM part),
product_attribute AS (
  SELECT CAST(p_partkey AS BIGINT) AS product_id, CAST(708 AS BIGINT) AS attribute_type_id,
         p_type AS varchar_value FROM part
  UNION ALL
  SELECT CAST(p_partkey AS BIGINT), CAST(10643 AS BIGINT),
         CASE p_type WHEN 'ECONOMY' THEN 'Mini' WHEN 'SMALL' THEN 'Above the Knee'
                     WHEN 'STANDARD' THEN 'Knee Length' WHEN 'MEDIUM' THEN 'Midi/Tea Length'
                     WHEN 'LARGE' THEN 'Long/Maxi' WHEN 'PROMO' THEN 'Other' END
  FROM part),
product_image AS (SELECT CAST(l_partkey AS BIGINT) AS product_id, CAST(l_orderkey AS BIGINT) AS image_id
                  FROM lineitem),
channel AS (SELECT CAST(l_partkey AS BIGINT) AS product_id,
                   CASE WHEN l_returnflag = 'A' THEN 'Y' ELSE 'N' END AS publish_flag,
                   CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS current_flag FROM lineitem),
product_type AS (SELECT CAST(n_nationkey AS BIGINT) AS product_type_id, n_name AS product_type_name,
                        n_name AS short_description, n_name AS product_type_description FROM nation),
upc AS (SELECT CAST(l_partkey AS BIGINT) AS product_id, CAST(l_orderkey AS BIGINT) AS product_colorway_id
        FROM lineitem),
product_colorway AS (SELECT CAST(o_orderkey AS BIGINT) AS product_colorway_id FROM orders),
product_colorway_image AS (SELECT CAST(o_orderkey AS BIGINT) AS product_colorway_id,
                                  CAST(o_custkey AS BIGINT) AS product_image_id FROM orders),
image AS (SELECT CAST(c_custkey AS BIGINT) AS product_image_id, CAST(c_nationkey AS BIGINT) AS product_id,
                 CAST(c_custkey AS BIGINT) AS image_id
          FROM customer),
landed_assets AS (SELECT CAST(o_orderkey AS VARCHAR) || '-214x261.jpg' AS file_name
                  FROM orders WHERE o_orderstatus = 'F')
"""
