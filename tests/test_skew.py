"""The same checks on tables where one key holds a third of all rows, copies included."""

import os

import duckdb
import pytest

import __spark_entry__ as registry
from compare import TABLES, compare, connect

NAMES = [
    "S7_unique_rows", "S7_surplus_rows", "S8_load_totals", "A1_overview", "A2_monthly", "A3_failure_by_model",
    "A7_capacity_fine", "A8_daily", "Q2_duplicate_keys", "Q7_daily_counts", "Q9_multi_failure_drives",
    "W12_training_set", "R1_weibull_fleet", "R3_kaplan_meier_by_model", "W11_remaining_life", "A14_life_statistics",
    "A15_target_summary", "A18_histogram", "M10_roc_auc",
]


@pytest.fixture(scope="module")
def skewed(small, tmp_path_factory):
    out = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    # A third of the readings come from one device, half of those on one day; some arrive three times.
    con.execute(
        f"""COPY (SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_partkey END AS l_partkey,
        CASE WHEN l_orderkey % 6 = 0 THEN TIMESTAMP '1997-03-03' ELSE l_shipdate END AS l_shipdate)
        FROM '{small}/lineitem.parquet'
        UNION ALL SELECT * FROM '{small}/lineitem.parquet' WHERE l_orderkey % 20 = 1
        UNION ALL SELECT * FROM '{small}/lineitem.parquet' WHERE l_orderkey % 20 = 1)
        TO '{out}/lineitem.parquet' (FORMAT PARQUET)"""
    )
    con.execute(
        f"""COPY (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 5 ELSE user_id END AS user_id)
        FROM '{small}/events.parquet') TO '{out}/events.parquet' (FORMAT PARQUET)"""
    )
    for name in TABLES:
        if name not in ("lineitem", "events"):
            os.symlink(f"{small}/{name}.parquet", f"{out}/{name}.parquet")
    return str(out)


@pytest.mark.parametrize("name", NAMES)
def test_skewed_tables(spark, skewed, name):
    query, sql = registry.queries()[name], registry.oracle_sql()[name]
    assert compare(query(spark, skewed), connect(skewed), sql) is None
