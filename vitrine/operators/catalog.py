"""Catalogue queries: labelled product images from the relational catalogue.

Plan shape (all three jobs): the per-product side (attribute row, product state,
published channel) is reduced first on product-sized data — semi joins and map-side
pre-aggregated DISTINCTs keyed by ``product_id`` — and the image fact is joined to it before
anything else happens to the fact, so only rows of eligible products are shuffled further.
The join is ``skew_split_join``: a product holding more than ``hot_rows`` image rows is
salted over ceil(rows / hot_rows) buckets. The DISTINCT comes after it and is partially
aggregated on the map side, where copies collapse.

Ids are compared as the source has them, so that filters reach the source, and narrowed to
bigint where they are returned.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import fixed_values as FV
from ..functions.urls import image_url, to_id
from ..sources.tables import Catalogue
from .joins import DEFAULT_HOT_ROWS, skew_split_join, spread_join

DEFAULT_MODULUS = 16


def bucket(col: Column | str, modulus: int) -> Column:
    """``mod(product_id, N)`` — sign follows the dividend, as in SQL ``mod``."""
    c = F.col(col) if isinstance(col, str) else col
    return (to_id(c) % F.lit(modulus)).cast("bigint")


def published_products(cat: Catalogue, state_id: int = FV.PUBLISHED_STATE_ID,
                       desc_like: str | None = None) -> DataFrame:
    """product ids in the given state (optional case-sensitive LIKE on the description)
    that have a publish='Y' and current='Y' channel row. Product-sized."""
    p = cat.product.filter(F.col("state_id") == state_id)
    if desc_like is not None:
        p = p.filter(F.col("product_desc").like(desc_like))
    p = p.select("product_id")
    live = (cat.channel
            .filter((F.col("publish_flag") == "Y") & (F.col("current_flag") == "Y"))
            .select("product_id")
            .distinct())                       # partial aggregate before the shuffle
    # the channel join projects no column: under DISTINCT it is an existence test
    return p.join(live, "product_id", "left_semi")


def attribute_values(cat: Catalogue, attribute_type_id: int) -> DataFrame:
    return (cat.product_attribute
            .filter(F.col("attribute_type_id") == attribute_type_id)
            .select("product_id", "varchar_value"))


def labelled_images(cat: Catalogue, attribute_type_id: int = FV.ATTR_TYPE_CATEGORY,
                    modulus: int = DEFAULT_MODULUS, state_id: int = FV.PUBLISHED_STATE_ID,
                    desc_like: str | None = None, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """DISTINCT (product_id, image_id, varchar_value, id_mod) of published products
    carrying the given attribute (the category job: 708; the dress-length job: 10643)."""
    eligible = (attribute_values(cat, attribute_type_id)
                .join(published_products(cat, state_id, desc_like), "product_id", "left_semi")
                .distinct())                          # product-sized
    joined = skew_split_join(cat.product_image.select("product_id", "image_id"), eligible, "product_id", hot_rows)
    return (joined.select(to_id("product_id").alias("product_id"), to_id("image_id").alias("image_id"), "varchar_value",
                          bucket("product_id", modulus).alias(FV.BUCKET_COLUMN)).distinct())


def with_image_url(df: DataFrame, prefix: str | None = None,
                   role: str = FV.DEFAULT_ROLE) -> DataFrame:
    kw = {} if prefix is None else {"prefix": prefix}
    return df.withColumn("image_url", image_url("image_id", FV.IMAGE_ROLE_SUFFIX[role], **kw))


def colorway_images(cat: Catalogue, category, modulus: int = DEFAULT_MODULUS,
                    state_id: int = FV.PUBLISHED_STATE_ID, category_col: str = "category") -> DataFrame:
    """Six-table chain product -> type, -> UPC -> colourway -> colourway image -> image.

    The bucket is of the image row's product id, which need not be the product's. Eligible
    products are found first; the UPC fact is filtered by them, the colourway side by the
    colourways that remain, each before its own DISTINCT. Descriptive product and type
    columns (product-sized) are attached once at the end. No fact is counted first: each of
    the four joins is shuffled for itself, and AQE splits its hot keys.
    """
    prod = cat.product.filter((F.col("state_id") == state_id) & (F.col(category_col) == category))
    details = (prod.select("product_id", "product_desc", "vendor_code", "product_type_id")
               .join(cat.product_type.select("product_type_id", "product_type_name",
                                             "short_description", "product_type_description"),
                     "product_type_id")
               .drop("product_type_id")
               .distinct())
    upc = (spread_join(cat.upc.select("product_id", "product_colorway_id"),
                       details.select("product_id").distinct(), "product_id")
           .distinct())
    wanted = upc.select("product_colorway_id").distinct()
    colorway_image = (cat.product_colorway_image.select("product_colorway_id", "product_image_id")
                      .join(wanted, "product_colorway_id", "left_semi")
                      .join(cat.product_colorway.select("product_colorway_id"), "product_colorway_id",
                            "left_semi"))
    images = (spread_join(colorway_image,
                          cat.image.select("product_image_id", "image_id", F.col("product_id").alias("_owner")),
                          "product_image_id")
              .select("product_colorway_id", "image_id", "_owner")
              .distinct())
    pairs = (spread_join(upc, images, "product_colorway_id")
             .select("product_id", "image_id", bucket("_owner", modulus).alias(FV.BUCKET_COLUMN))
             .distinct())
    return (spread_join(pairs, details, "product_id")
            .select(to_id("product_id").alias("product_id"), "product_desc", "vendor_code",
                    to_id("image_id").alias("image_id"), "product_type_name",
                    "short_description", "product_type_description", FV.BUCKET_COLUMN))


def joined_rows_with_copies(cat: Catalogue, attribute_type_id: int, modulus: int = DEFAULT_MODULUS,
                            state_id: int = FV.PUBLISHED_STATE_ID, desc_like: str | None = None,
                            hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """The distinct rows of the inner join with ``copies``, how often the join repeats each (one
    row per matching channel row, attribute row and image row). Only needed where a row cap is
    applied below the DISTINCT. Copies are counted, never made."""
    p = cat.product.filter(F.col("state_id") == state_id)
    if desc_like is not None:
        p = p.filter(F.col("product_desc").like(desc_like))
    live = (cat.channel
            .filter((F.col("publish_flag") == "Y") & (F.col("current_flag") == "Y"))
            .groupBy("product_id").agg(F.count(F.lit(1)).alias("_n")))
    products = p.groupBy("product_id").agg(F.count(F.lit(1)).alias("_p"))
    dim = (attribute_values(cat, attribute_type_id)
           .groupBy("product_id", "varchar_value").agg(F.count(F.lit(1)).alias("_a"))
           .join(products, "product_id")
           .join(live, "product_id")
           .select("product_id", "varchar_value", (F.col("_a") * F.col("_p") * F.col("_n")).alias("_n")))
    rows = skew_split_join(cat.product_image.select("product_id", "image_id"), dim, "product_id", hot_rows)
    return (rows.groupBy(to_id("product_id").alias("product_id"), to_id("image_id").alias("image_id"), "varchar_value",
                         bucket("product_id", modulus).alias(FV.BUCKET_COLUMN))
            .agg(F.sum("_n").alias("copies")))


def cap_then_distinct(rows: DataFrame, n: int, order_cols: list[str], copies_col: str = "copies") -> DataFrame:
    """ROWNUM-style cap of ``n`` applied below a DISTINCT, in a total order: of distinct ``rows``
    with their numbers of copies, those that have a copy among the first n.

    Every row counts at least once, so the first n rows suffice: ``orderBy().limit()`` plans as
    TakeOrderedAndProject, and the running sum of copies is over those n rows."""
    first = rows.orderBy(*order_cols).limit(n)
    before = (Window.partitionBy().orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1))
    return (first.withColumn("_before", F.coalesce(F.sum(copies_col).over(before), F.lit(0)))
            .filter(F.col("_before") < n).drop("_before", copies_col))


LABEL_SALTS = 64


def first_n_per_label(df: DataFrame, label_col: str, n: int, order_cols: list[str],
                      salts: int = LABEL_SALTS) -> DataFrame:
    """First n rows per label in a total order, whatever n.

    In two steps, so that a hot label is not ranked in one task: the first n of each of
    ``salts`` shares of the label (by a hash of the order columns), then the first n of
    those, at most n * salts rows."""
    order = [F.col(c).asc_nulls_last() for c in order_cols]
    share = F.pmod(F.xxhash64(*order_cols), F.lit(salts)).cast("int")
    some = (df.withColumn("_share", share)
            .withColumn("_rn", F.row_number().over(Window.partitionBy(label_col, "_share").orderBy(*order)))
            .filter(F.col("_rn") <= n).drop("_share", "_rn"))
    return (some.withColumn("_rn", F.row_number().over(Window.partitionBy(label_col).orderBy(*order)))
            .filter(F.col("_rn") <= n).drop("_rn"))
