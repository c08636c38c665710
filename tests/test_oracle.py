"""Every registered query with SQL, value by value against DuckDB."""

import pytest
from compare import check, connect
from conftest import DATA

import __spark_entry__ as entry_point
from strata.plans import stateful

QUERIES, ORACLE = entry_point.QUERIES, entry_point.ORACLE
WRITING = {name for name, fn in QUERIES.items() if fn.__module__ == stateful.__name__}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.fixture(scope="module")
def databases():
    return {scale: connect(f"{DATA}/{scale}") for scale in ("sf0.001", "sf0.01")}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, databases, name):
    scale = "sf0.001" if name in WRITING else "sf0.01"
    df = QUERIES[name](spark, f"{DATA}/{scale}")
    assert check(df, databases[scale], ORACLE[name]) is None


def test_entry_has_rows(spark):
    assert not entry_point.entry(spark).isEmpty()


def test_the_comparison_notices_differences(spark):
    con = connect(f"{DATA}/sf0.001")
    regions = spark.read.parquet(f"{DATA}/sf0.001/region.parquet")
    same = "SELECT * FROM region"
    assert check(regions, con, same) is None
    assert "rows" in check(regions.limit(4), con, same)
    assert "type" in check(regions.selectExpr("cast(r_regionkey as long) r_regionkey", "r_name"), con, same)
    assert "!=" in check(regions.selectExpr("r_regionkey", "lower(r_name) r_name"), con, same)
    assert "columns" in check(regions.select("r_name"), con, same)
