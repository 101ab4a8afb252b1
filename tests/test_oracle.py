"""Every registered query against DuckDB on the smallest tables."""

import re

import duckdb
import pytest

import __spark_entry__ as contract
from meterline.suite.rows import shipped
from tests.comparing import differences, duck

QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, connection, name):
    result = QUERIES[name](spark, sf_dir)
    if name in ORACLE:
        assert differences(result, ORACLE[name], connection) == []
    else:
        assert result.count() > 0


def test_stray_months_of_lines_without_a_ship_date(spark, sf_dir, tmp_path):
    """They have no month, and are trips like others."""
    lines = "SELECT * REPLACE (CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_shipdate END AS l_shipdate) FROM"
    duckdb.execute(f"COPY ({lines} '{sf_dir}/lineitem.parquet') TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)")
    name = "s13_land_stray_months"
    result = QUERIES[name](spark, str(tmp_path))
    assert not result.where("year IS NULL").isEmpty()
    assert differences(result, ORACLE[name], duck(str(tmp_path))) == []


def test_raw_files_of_a_part_compute_no_trip_of_another(spark, sf_dir):
    parts = [shipped(spark, sf_dir, part) for part in range(3)]
    assert "l_shipdate" not in parts[0].columns
    for df in parts:
        text = df._jdf.queryExecution().executedPlan().toString()
        (condition,) = re.findall(r"Filter (.*)", text)
        assert "l_shipdate" in condition and "timestampadd" not in condition


def test_entry_returns_the_hourly_patterns(spark):
    result = contract.entry(spark)
    assert result.columns == [
        "pickup_hour",
        "is_weekend",
        "is_rush_hour",
        "trip_count",
        "avg_duration_min",
        "avg_fare_per_mile",
    ]
    assert result.count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)
