"""Image URL and file-name columns (sharded asset store layout)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as FV

DEFAULT_PREFIX = "http://images.example"


def to_id(col: Column | str) -> Column:
    """Catalogue NUMBER -> bigint id; values that do not fit become NULL, never wrap."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("bigint")


def image_url(image_id: Column | str, suffix: str | Column = FV.IMAGE_ROLE_SUFFIX[FV.DEFAULT_ROLE],
              prefix: str | Column = DEFAULT_PREFIX) -> Column:
    """``<prefix>/d8d7/d6d5/d4d3/d2d1/final/<id>-<suffix>``.

    The path uses the last 8 digits of the id, zero padded, in pairs; the file name keeps
    the whole id. Negative or NULL ids give NULL (no well-formed path exists for them).
    """
    iid = F.col(image_id) if isinstance(image_id, str) else image_id
    iid = iid.cast("bigint")
    pre = F.lit(prefix) if isinstance(prefix, str) else prefix
    suf = F.lit(suffix) if isinstance(suffix, str) else suffix
    padded = F.lpad((iid % F.lit(FV.URL_SHARD_MODULUS)).cast("string"), FV.URL_SHARD_DIGITS, "0")
    # "/d8d7/d6d5/d4d3/d2d1/" by fixed-position substrings (no regex per row)
    pieces = []
    for start in range(1, FV.URL_SHARD_DIGITS + 1, 2):
        pieces += [F.lit("/"), F.substring(padded, start, 2)]
    url = F.concat(pre, *pieces, F.lit("/" + FV.URL_FINAL_SEGMENT), iid.cast("string"), F.lit("-"), suf)
    return F.when(iid >= 0, url)


def role_suffix_map() -> Column:
    """Literal map role -> size suffix."""
    items = []
    for role, suffix in FV.IMAGE_ROLE_SUFFIX.items():
        items += [F.lit(role), F.lit(suffix)]
    return F.create_map(*items)


def expected_file_name(image_id: Column | str, suffix: str = FV.IMAGE_ROLE_SUFFIX[FV.DEFAULT_ROLE]) -> Column:
    """``<id>-<suffix>``: the last URL segment, built from the id (NULL for negative ids)."""
    iid = (F.col(image_id) if isinstance(image_id, str) else image_id).cast("bigint")
    return F.when(iid >= 0, F.concat(iid.cast("string"), F.lit("-" + suffix)))


def file_name(url: Column | str) -> Column:
    """Last '/' segment of a URL."""
    u = F.col(url) if isinstance(url, str) else url
    return F.substring_index(u, "/", -1)
