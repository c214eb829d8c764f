"""Labels, asset paths and the landed-asset attach.

The per-row work of the catalogue jobs (URL, label, file, path) is column expressions; the
image download is re-aimed as a join against the listing of assets that have landed.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as FV
from ..functions.urls import expected_file_name
from .joins import skew_split_join, spread_join

DEFAULT_ASSET_ROOT = "assets"


def _lit_map(mapping: dict[str, str]) -> Column:
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def enum_label(text: Column | str, mapping: dict[str, str] | None = None) -> Column:
    """Attribute text -> enum name by a literal map; unknown text -> NULL (quarantine)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.element_at(_lit_map(mapping or FV.DRESS_LENGTH_ENUM), t)


def split_quarantine(df: DataFrame, label_col: str = "label") -> tuple[DataFrame, DataFrame]:
    """(rows with a label, rows whose label could not be mapped)."""
    return df.filter(F.col(label_col).isNotNull()), df.filter(F.col(label_col).isNull())


def path_label(label: Column | str) -> Column:
    """Label as one folder name: '%' and '/' are percent-encoded, so a label never nests."""
    c = F.col(label) if isinstance(label, str) else label
    return F.replace(F.replace(c, F.lit("%"), F.lit("%25")), F.lit("/"), F.lit("%2F"))


def landed_image_ids(assets: DataFrame, suffix: str = FV.IMAGE_ROLE_SUFFIX[FV.DEFAULT_ROLE]) -> DataFrame:
    """Distinct image ids whose ``<id>-<suffix>`` file is in the asset listing. The id is
    parsed on the listing side and only canonical names count (the exact string match)."""
    id_text = F.substring_index(F.col("file_name"), "-", 1)
    return (assets.select("file_name")
            .withColumn("image_id", id_text.try_cast("bigint"))
            .filter((F.col("image_id") >= 0)
                    & (F.col("file_name") == F.concat(F.col("image_id").cast("string"), F.lit("-" + suffix))))
            .select("image_id").distinct())


def attach_assets(manifest: DataFrame, assets: DataFrame, label_col: str = "label",
                  root: str = DEFAULT_ASSET_ROOT,
                  suffix: str = FV.IMAGE_ROLE_SUFFIX[FV.DEFAULT_ROLE],
                  hot_rows: int | None = None) -> DataFrame:
    """Left join of the manifest to the landed-asset listing on the image id.

    Equivalent to matching the URL's file name against the listing, but the join key is
    the numeric id the manifest already has: no string is built per fact row to join.
    ``image_path`` = root/label/file_name when the asset landed, else NULL; rows are
    never dropped here (a flag, not a filter). The listing side is distinct on the id,
    so the left join cannot multiply manifest rows. Rows without an image id are spread over
    the tasks; AQE splits an image on very many rows, or ``hot_rows`` counts and salts such.
    """
    landed = landed_image_ids(assets, suffix).withColumn("_landed", F.lit(True))
    joined = (spread_join(manifest, landed, "image_id", "left") if hot_rows is None
              else skew_split_join(manifest, landed, "image_id", hot_rows, "left"))
    out = (joined
           .withColumn("file_name", expected_file_name("image_id", suffix)))
    return (out.withColumn("has_asset", F.coalesce(F.col("_landed"), F.lit(False)))
            .withColumn("image_path",
                        F.when(F.col("has_asset"),
                               F.concat_ws("/", F.lit(root), path_label(label_col),
                                           F.col("file_name"))))
            .drop("_landed"))


def with_image_path_only(df: DataFrame) -> DataFrame:
    """Rows whose image landed (not-null image path)."""
    return df.filter(F.col("image_path").isNotNull())


def label_in(df: DataFrame, label_col: str, allowed: list[str]) -> DataFrame:
    """Case-insensitive label membership (literal set, no join)."""
    return df.filter(F.lower(F.col(label_col)).isin([a.lower() for a in allowed]))
