"""Vector columns: CSV text, one-hot, softmax, argmax, log-sum-exp.

All are array expressions evaluated inside the JVM.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_csv(vec: Column | str) -> Column:
    return F.array_join(F.transform(_c(vec), lambda v: v.cast("string")), ",")


def from_csv(text: Column | str, element_type: str = "float") -> Column:
    return F.split(_c(text), ",").cast(f"array<{element_type}>")


def one_hot(class_id: Column | str, num_classes: int) -> Column:
    cid = _c(class_id)
    return F.transform(F.sequence(F.lit(0), F.lit(num_classes - 1)),
                       lambda i: (i == cid).cast("double"))


def wrap_index(index: Column | str, n: Column | str | int) -> Column:
    nn = F.lit(n) if isinstance(n, int) else _c(n)
    return F.pmod(_c(index), nn)


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a lambda column): Catalyst may
    otherwise inline an expensive expression at every reference inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def softmax(z: Column | str) -> Column:
    """exp(z - max z) / sum(exp(z - max z)); z, the shifted exponentials and their sum
    are each computed once per row."""
    def with_z(zz):
        return let(F.transform(zz, lambda v: F.exp(v - F.array_max(zz))),
                   lambda e: let(F.aggregate(e, F.lit(0.0).cast("double"), lambda acc, v: acc + v),
                                 lambda s: F.transform(e, lambda v: v / s)))
    return let(_c(z), with_z)


def log_sum_exp(z: Column | str) -> Column:
    def with_z(zz):
        return let(F.array_max(zz), lambda m: m + F.log(
            F.aggregate(F.transform(zz, lambda v: F.exp(v - m)),
                        F.lit(0.0).cast("double"), lambda acc, v: acc + v)))
    return let(_c(z), with_z)


def argmax(v: Column | str) -> Column:
    """0-based index of the largest element; the lowest index wins ties."""
    vc = _c(v)
    return (F.array_position(vc, F.array_max(vc)) - 1).cast("int")


def top_k(scores: Column | str, k: int) -> Column:
    """array<struct<score, class_id>> of the k best, score descending.

    Ties put the higher class id first — what ``argsort()[-k:][::-1]`` gives on short
    vectors (stable ascending sort, then reversed)."""
    sc = _c(scores)
    pairs = F.transform(sc, lambda s, i: F.struct(s.alias("score"), i.cast("int").alias("class_id")))
    return F.slice(F.sort_array(pairs, asc=False), 1, k)


def reshape(vec: Column | str, rows: int, cols: int) -> Column:
    """Flat vector -> rows x cols nested array (row-major)."""
    vc = _c(vec)
    return F.transform(F.sequence(F.lit(0), F.lit(rows - 1)),
                       lambda r: F.slice(vc, r * cols + 1, cols))
