"""Every registered query equals its oracle SQL (DuckDB) on the smallest data."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_compare import compare, duck  # noqa: E402

from conftest import SF_SMALL  # noqa: E402
from retail_lake.catalog import oracle_statements, spark_queries  # noqa: E402

# the models, operators and checks of the library; the training-data queries have tests of their own
QUERIES, ORACLE = spark_queries(), oracle_statements()
KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, con, SF_SMALL, key, QUERIES[key], ORACLE[key])
    assert res["status"] == "ok", res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "revenue_share_percentage" in df.columns


def test_no_decimal_in_results(spark, con):
    """Query results carry no DECIMAL on either side (see catalog.DECIMAL_OUTPUTS)."""
    from pyspark.sql.types import DecimalType
    for key in KEYS:
        df = QUERIES[key](spark, SF_SMALL)
        assert not [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)], key
        types = [d[1] for d in con.execute(f"DESCRIBE {ORACLE[key]}").fetchall()]
        assert not [t for t in types if str(t).startswith("DECIMAL")], key
