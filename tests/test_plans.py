"""Shape of the physical plans, with broadcasts off so that they look as they do on large tables."""

import re

import pytest

from tallyline.catalog import QUERIES


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(spark, folder, name):
    return QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()


# Windows over one row per partition (W1, A7) or one row per refresh (S9, R7).
TINY_WINDOWS = {"W1_row_index", "A7_flatten_large_groups", "A12_column_blocks", "X4_rate_blocks", "S9_history_append", "R7_snapshot_refresh"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_global_window(no_broadcast, folder, name):
    plan = plan_of(no_broadcast, folder, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in TINY_WINDOWS:
        assert "BroadcastExchange" not in plan
        for line in plan.splitlines():
            if re.search(r"\bWindow \[", line):
                assert not re.search(r"windowspecdefinition\([^,)]* (ASC|DESC)", line), line
    assert "Python" not in plan and "InPandas" not in plan


@pytest.mark.parametrize("name", ["V5_month_to_date_variance", "V6_quarter_to_date_variance", "V8_statement_overview", "V1_ledger_close_actuals", "V2_symmetric_override_actuals", "V3_amortization_split", "V4_plan_facts", "V4_forecast_facts", "V8_overview_of_the_close", "V13_detailed_table", "L5_newest_month_statement", "R4_year_to_date_kpis", "E6_cost_by_category"])
def test_date_range_reaches_the_scan(spark, folder, name):
    scans = [line for line in plan_of(spark, folder, name).splitlines() if "FileScan parquet" in line and "lineitem" in line]
    assert scans and all("l_shipdate" in line.split("PushedFilters:")[1].split("ReadSchema")[0] for line in scans)


def test_scan_reads_only_the_columns_it_needs(spark, folder):
    scan = next(line for line in plan_of(spark, folder, "V5_month_to_date_variance").splitlines() if "FileScan parquet" in line and "lineitem" in line)
    columns = scan.split("ReadSchema: ")[1]
    assert "l_extendedprice" in columns and "l_discount" not in columns and "l_quantity" not in columns


def test_statement_needs_one_aggregation(spark, folder):
    plan = plan_of(spark, folder, "V8_statement_overview")
    assert plan.count("Exchange hashpartitioning") == 1


def test_fewer_shuffles(no_broadcast, folder):
    assert plan_of(no_broadcast, folder, "F14_unnest").count("Exchange hashpartitioning") == 1
    # Newest dates, then the rows equal to them: nothing is ranked, and the rows are dealt by key and date.
    newest = plan_of(no_broadcast, folder, "W3_latest_per_group")
    assert "Window" not in newest and newest.count("FileScan parquet") == 2
