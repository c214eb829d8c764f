"""Every registered query with an oracle: Spark at sf0.01 == DuckDB SQL on the same parquet
(row count, column names, order-insensitive values with doubles rounded to 6 places)."""
import pytest

import __spark_entry__ as E
from tests.oracle_util import compare
from vitrine.plans import registry

SF = "/root/testdata/sf0.01"
ORACLE = E.oracle_sql()
CORE = registry.queries()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    ok, msg = compare(spark, name, E.queries()[name], ORACLE[name], SF)
    assert ok, msg


def test_every_query_has_its_sql():
    assert set(CORE) == set(registry.oracle_sql()) and set(ORACLE) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["product_id", "image_id", "label", "id_mod", "image_url"]
    assert df.count() == 1919
