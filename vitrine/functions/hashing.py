"""Stable hash columns: split percentage and reproducible uniform draws."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as FV


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def sha1_low16(text: Column | str) -> Column:
    """int(sha1(text), 16) mod 65536 == the last four hex digits as an int."""
    return F.conv(F.substring(F.sha1(_c(text).cast("string")), 37, 4), 16, 10).cast("int")


def hash_percentage(key: Column | str) -> Column:
    """(sha1(key) mod 65536) * (100 / 65535.0), as a double in [0, 100.0015]."""
    return sha1_low16(key).cast("double") * F.lit(FV.HASH_SCALE)


def split_of(percentage: Column | str, validation_pct: float = FV.DEFAULT_VALIDATION_PCT,
             testing_pct: float = FV.DEFAULT_TESTING_PCT) -> Column:
    p = _c(percentage)
    return (F.when(p < F.lit(float(validation_pct)), F.lit("validation"))
            .when(p < F.lit(float(testing_pct + validation_pct)), F.lit("testing"))
            .otherwise(F.lit("training")))


def uniform16(seed: str, draw_id: Column | str, stream: str) -> Column:
    """Reproducible draw in [0, 65536): sha1 of ``seed:draw_id:stream``, low 16 bits."""
    return sha1_low16(F.concat_ws(":", F.lit(seed), _c(draw_id).cast("string"), F.lit(stream)))


def hash60(seed: str, draw_id: Column | str, stream: str) -> Column:
    """Reproducible draw in [0, 2 ** 60): the last 15 hex digits of the sha1 of ``seed:draw_id:stream``."""
    text = F.concat_ws(":", F.lit(seed), _c(draw_id).cast("string"), F.lit(stream))
    return F.conv(F.substring(F.sha1(text), 26, 15), 16, 10).cast("bigint")


def uniform_unit(seed: str, draw_id: Column | str, stream: str) -> Column:
    """Reproducible draw in [0, 1): uniform16 / 65536."""
    return uniform16(seed, draw_id, stream).cast("double") / F.lit(float(FV.HASH_BUCKETS))
