"""Tie-out properties of the financial plans."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyline.catalog import QUERIES
from tallyline.catalog import views
from tallyline.catalog.hierarchy import RULES, described
from tallyline.catalog.registry import Tables
from tallyline.operators.joins import missing_both_ways
from tallyline.operators.totals import overlap_counts
from tallyline.plans import bridge, close, fx, hierarchy, people, pnl, reconcile


@pytest.fixture(scope="module")
def tables(spark, folder):
    return Tables(spark, folder)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_month_equals_year_to_date_in_january(tables):
    facts = views.facts(tables)
    month = close.statement(facts, date(1998, 1, 1), "MTD")
    year = close.statement(facts, date(1998, 1, 1), "YTD")
    assert rows(month) == rows(year)


def test_overview_is_built_from_the_three_windows(tables):
    facts = views.facts(tables)
    wide = close.window_variances(facts, close.statement_windows(date(1999, 11, 1)))
    year = close.statement(facts, date(1999, 11, 1), "YTD")
    assert rows(wide.select("category", *close.window_columns("YTD"))) == rows(year)


def test_category_without_rows_in_the_month_has_no_month_values(spark):
    facts = spark.createDataFrame(
        [("a", date(2020, 1, 1), "actuals", 5.0), ("b", date(2020, 3, 1), "op", 2.0), ("b", date(2020, 3, 1), "op", None)],
        "category string, period date, type string, value double")
    out = {r["category"]: r for r in close.window_variances(facts, close.statement_windows(date(2020, 3, 1))).collect()}
    assert out["a"]["MTD_actuals"] is None and out["a"]["YTD_actuals"] == 5.0
    assert out["b"]["MTD_OP"] == 0.0 and out["b"]["MTD_VOP"] == 0.0


def test_close_lines_find_clearing_under_the_posted_name(spark):
    ledger = spark.createDataFrame([
        ("1", "WATCHED", "PLANT C.I.P. 1", 2021, 3, 9000.0), ("1", "WATCHED", None, 2021, 3, 100.0), ("1", "RENT", "C.I.P.", 2021, 3, 40.0),
        ("1", "RENT", "C.I.P.", 2021, 3, 2.0), ("9", "RENT", None, 2021, 3, 7.0), ("2", "TRAVEL", None, 2021, 4, None), ("2", "TRAVEL", None, 2021, 4, 3.0),
    ], "cost_element string, cost_element_name string, offset_account string, year int, period int, value double")
    out = {(r["cost_element"], r["cost_element_name"]): r for r in close.close_lines(
        ledger, [("RENT", "Rent")], excluded=["9"], clearing="C.I.P.", watched="WATCHED", above=5000).collect()}
    assert set(out) == {("1", "PLANT C.I.P. 1"), ("1", "WATCHED"), ("1", "RENT"), ("2", "TRAVEL")}
    assert (out["1", "WATCHED"]["actual"], out["1", "WATCHED"]["clearing_account"]) == (100.0, 9000.0)
    assert (out["1", "RENT"]["gross"], out["1", "RENT"]["category"]) == (0.0, "Rent")
    assert (out["2", "TRAVEL"]["actual"], out["2", "TRAVEL"]["category"]) == (0.0, "Others")


def test_statement_of_the_newest_month_is_a_slice_of_the_whole_book(tables):
    newest = pnl.newest_month(tables.lineitem, "l_shipdate")
    pl = views.pl(tables)
    assert rows(pnl.newest_statement(pl, newest)) == rows(pnl.statement(pl).filter(F.col("ref_date") == F.lit(newest)))


def test_prior_year_needs_the_account_in_the_month_itself(spark):
    cube = spark.createDataFrame([
        ("r", "c", "p", "Net Sales", "actual", date(2020, 1, 1), 10.0), ("r", "c", "p", "SGM", "actual", date(2020, 1, 1), 4.0),
        ("r", "c", "p", "Net Sales", "actual", date(2021, 1, 1), 12.0),
    ], "region string, channel string, product string, account string, scenario string, ref_date date, result double")
    compared = {(r["account"], r["ref_date"].year): r for r in pnl.compare_scenarios(cube).collect()}
    lines = {(r["account"], r["ref_date"].year): r for r in pnl.report_lines(pnl.post(cube)).collect()}
    assert ("SGM", 2021) not in compared and lines["SGM", 2021]["py"] is None
    assert lines["Net Sales", 2021]["py"] == compared["Net Sales", 2021]["py"] == 10.0


def test_undefined_ratio_becomes_zero_only_at_the_end(spark):
    lines = spark.createDataFrame([("x", None, 0.1, 0.0, None, None)], "account string, actual double, forecast double, budget double, py double, ppy double")
    out = pnl.variances(lines.withColumn("ref_date", F.lit(date(2020, 1, 1))), dims=()).first()
    assert (out["actual"], out["vfcast_usd"], out["vop_perc"]) == (0.0, 0.0, 0.0)


def test_divergence_of_sums_is_sum_of_divergences(spark):
    plan = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0), ("c", 0.0)], "k string, value double")
    got = spark.createDataFrame([("a", 4.0), ("b", 1.0)], "k string, value double")
    out = reconcile.plan_vs_collected(plan, got, ["k"])
    assert {r["k"]: r["divergence"] for r in out.collect()} == {"a": 1.0, "b": -4.0}


def test_identical_sides_have_no_gaps(tables):
    keys = tables.orders.select("o_orderkey")
    assert missing_both_ways(keys, keys, ["o_orderkey"]).count() == 0
    assert {(r["side"], r["found"]): r["n"] for r in overlap_counts(keys, keys, "o_orderkey").collect()}["left", "false"] == 0


def test_segment_and_complement_make_up_the_whole(tables):
    members = hierarchy.classify(described(tables), RULES, "Outdoor", "Tools", unused="DO NOT USE").select("name").distinct()
    part = members.filter(F.col("name") < "Supplier#000000005")
    rest = hierarchy.complement(members, part, "name")
    assert rest.count() + part.count() == members.count() and rest.join(part, "name").count() == 0


def test_gap_report_total_survives_splitting_of_names(spark):
    sales = spark.createDataFrame([("s", "EUR", f"e{i:03d}", "Jan", 1.0) for i in range(30)] + [("s", "USD", "u", "Jan", 9.0)], "segment string, lc string, entity string, month string, value double")
    listed = spark.createDataFrame([("e000",)], "entity string")
    out = hierarchy.gap_report(sales, listed, unit=10.0).collect()
    assert [(r["segment"], r["v"], r["f"], r["n_entities"]) for r in out] == [("s", 29.0, 290.0, 29), ("Total", 29.0, 290.0, 29)]
    for size in (1, 5, 1000):
        names = hierarchy.gap_names(sales, listed, part_items=size).orderBy("part").collect()
        assert ",".join(r["entities"] for r in names) == ",".join(f"e{i:03d}" for i in range(1, 30)) and max(r["n_items"] for r in names) <= size


def test_ratio_table_difference_of_rounded_shares(spark):
    cells = {c: 0.0 for c in [*bridge.TYPES]} | {f"{p}_{o}": 0.0 for o in ("vpy", "vfcst", "vop") for p in bridge.PARTS}
    cells |= {"actual_sales_py": 1000.0, "sales_vpy": 12.5, "sales_vfcst": 10.0, "fcst_sales": 0.0}
    df = spark.range(1).select(F.lit(date(2022, 3, 1)).alias("ref_date"), *[F.lit(v).alias(k) for k, v in cells.items()])
    out = bridge.ratio_table(df, keys=("ref_date",)).first()
    assert (out["sales_vpy_ratio"], out["sales_vfcst_ratio"], out["acqdiv_vfcst_ratio"]) == (0.0125, 120.0 - 20.0, 0.0)


def test_new_heads_and_name_split(spark):
    heads = spark.createDataFrame([("Doe,Ann M", "1", date(2021, 7, 1)), ("Doe,Ann M", "1", date(2021, 8, 1)), ("Roe,Bo", "1", date(2021, 8, 1))], "name string, cost_center string, date date")
    assert [r["name"] for r in people.new_heads(heads, "2021-08-01").collect()] == ["Roe,Bo"]
    assert [tuple(r) for r in people.split_last_first(heads.select("name").distinct(), "name").orderBy("last").collect()] == [("Doe", "Ann"), ("Roe", "Bo")]


def test_weekly_rate_counts_missing_rates_in_the_mean(spark):
    rates = spark.createDataFrame([("E", "Week 1", "Jan", "2021", date(2021, 1, 4), 2.0), ("E", "Week 1", "Jan", "2021", date(2021, 1, 5), None)],
                                  "from_ccy string, week string, month string, year string, date date, inverse_spot_rate double")
    out = fx.weekly_rates(rates).first()
    assert (out["average"], out["week"], out["date_range"]) == (1.0, 1, "2021-01-04 : 2021-01-05")


def test_flagship_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns[:2] == ["category", "vendor"]
    assert set(__spark_entry__.queries()) >= set(QUERIES)
