"""Label and path text columns."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as FV


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalize_label(name: Column | str) -> Column:
    """Lower-case; every run of characters outside [a-z0-9] becomes one space (ends kept)."""
    return F.regexp_replace(F.lower(_c(name)), FV.LABEL_NORMALIZE_PATTERN, " ")


def variant_group_key(key: Column | str) -> Column:
    """Drop everything from ``_nohash_`` on, so close variants share a split."""
    return F.regexp_replace(_c(key), FV.NOHASH_PATTERN, "")


def join_path(*parts: Column | str) -> Column:
    """root/label/base_name style path from columns (strings are column names)."""
    return F.concat_ws("/", *[_c(p) for p in parts])


def cache_path(path: Column | str, ext: str = ".txt") -> Column:
    return F.concat(_c(path), F.lit(ext))


def label_from_path(path: Column | str) -> Column:
    """Sub-folder that holds the file: ``.../<label>/<file>`` -> ``<label>``."""
    return F.regexp_extract(_c(path), r"([^/]+)/[^/]+$", 1)


def base_name(path: Column | str) -> Column:
    return F.regexp_extract(_c(path), r"([^/]+)$", 1)
