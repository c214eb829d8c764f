"""All registered queries (callable(spark, sf_dir) -> DataFrame) and their oracle SQL."""
from __future__ import annotations

from ..session import ship_package

from . import catalog_queries, io_queries, model_queries, scoring_queries, split_queries

_MODULES = [catalog_queries, split_queries, scoring_queries, model_queries, io_queries]


def shipped(fn):
    def run(spark, sf_dir):
        ship_package(spark)             # Python stages must import this package
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def queries():
    out = {}
    for m in _MODULES:
        out.update({k: shipped(v) for k, v in m.QUERIES.items()})
    return out


def oracle_sql():
    out = {}
    for m in _MODULES:
        out.update(m.SQL)
    return out
