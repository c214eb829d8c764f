"""Business-rule checks of predictions against the catalogue attribute."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as FV
from ..functions.text import normalize_label


def rules_map(rules: dict[str, list[str]] | None = None) -> Column:
    rules = rules or FV.LENGTH_RULES
    items = []
    for s, acc in rules.items():
        items += [F.lit(s), F.array(*[F.lit(a) for a in acc])]
    return F.create_map(*items)


def length_warning(df: DataFrame, source_col: str, predicted_col: str = "label1",
                   rules: dict[str, list[str]] | None = None) -> DataFrame:
    """warning = the top prediction is not an accepted label for the source label.
    Sources without a rule get NULL (the reference leaves the key unset)."""
    acc = F.element_at(rules_map(rules), F.col(source_col))
    return df.withColumn("warning", F.when(acc.isNotNull(),
                                           ~F.array_contains(acc, F.col(predicted_col))))


def color_warning(df: DataFrame, expected_col: str, predicted_col: str = "label1",
                  literal: bool = False) -> DataFrame:
    """warning = predicted != expected. ``literal`` compares against lower(expected)
    exactly; otherwise both sides are normalised (``Ivory_Cream`` == ``ivory cream``)."""
    if literal:
        cond = F.col(predicted_col) != F.lower(F.col(expected_col))
    else:
        cond = normalize_label(predicted_col) != normalize_label(expected_col)
    return df.withColumn("warning", cond)


def score_text(score: Column | str, decimals: int = FV.SCORE_DECIMALS) -> Column:
    """Fixed-point text of a score, rounded half-even on the binary value (0.125 -> 0.12).
    For the JSON sink only; computations keep the numeric score."""
    s = F.col(score) if isinstance(score, str) else score
    return F.replace(F.format_number(s, decimals), F.lit(","), F.lit(""))


def one_vector(features: DataFrame, key_col: str) -> DataFrame:
    """(key, features) with one row a key; of several vectors the one of the largest hash."""
    return features.groupBy(key_col).agg(F.max_by("features", F.xxhash64("features")).alias("features"))


def only_scored(df: DataFrame, columns: list[str], features_col: str = "features") -> DataFrame:
    """``columns`` are NULL where the row has no vector, so an unscored record stays as it came."""
    return df.withColumns({c: F.when(F.col(features_col).isNotNull(), F.col(c)) for c in columns})
