"""Missing keys, leap days, colliding headers, wide sums, malformed dates and names outside a list."""

from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyline.catalog import ORACLES, QUERIES
from tallyline.functions.periods import calendar_of, from_serial, month_of
from tallyline.operators import columns, joins, reshape, totals, windows
from tallyline.plans import close, ops, people, reconcile


def test_headers_never_collide():
    assert columns.clean_headers(["a", "a_2", "a", "A", "a_2"]) == ["a", "a_2", "a_3", "a_4", "a_2_2"]


def test_interval_columns_are_no_numbers(spark):
    df = spark.sql("SELECT INTERVAL 1 DAY AS i, 1 AS n, 1.50 AS d, map(1, 2) AS m")
    assert columns.numeric_columns(df) == ["n", "d"]


def test_totals_are_wider_than_their_parts(spark):
    df = spark.createDataFrame([("a", 2_000_000_000, 99), ("b", 2_000_000_000, 1)], "k string, n int, t tinyint")
    out = {r["k"]: (r["n"], r["t"]) for r in totals.add_totals(df, "k").collect()}
    assert out["Total"] == (4_000_000_000, 100) and out["a"] == (2_000_000_000, 99)
    dec = totals.add_totals(spark.sql("SELECT 'a' AS k, CAST(9.9 AS DECIMAL(2, 1)) AS d UNION ALL SELECT 'b', CAST(9.9 AS DECIMAL(2, 1))"), "k")
    assert [float(r["d"]) for r in dec.collect() if r["k"] == "Total"] == [19.8]


def test_malformed_months_and_serials_are_missing(spark):
    df = spark.createDataFrame([("2021", "13"), ("x", "1"), ("2021", "02"), (None, "1"), ("2021", None)], "y string, m string")
    assert [r[0] for r in df.select(month_of("y", "m")).collect()] == [None, None, date(2021, 2, 1), None, None]
    serials = spark.createDataFrame([("44197",), ("44197.9",), ("soon",), (None,)], "s string")
    assert [r[0] for r in serials.select(from_serial("s")).collect()] == [date(2021, 1, 1), date(2021, 1, 1), None, None]


def test_leap_days_look_back_to_the_28th(spark):
    days = [(date(2019, 2, 28), 1.0), (date(2020, 2, 28), 10.0), (date(2020, 2, 29), 20.0), (date(2021, 2, 28), 100.0), (date(2024, 2, 29), 7.0), (None, 5.0)]
    df = spark.createDataFrame([("k", *d) for d in days], "k string, day date, v double")
    out = {r["day"]: (r["v"], r["p1"], r["p4"]) for r in reshape.shift_years(df, "day", ["k"], "v", ["p1", "p2", "p3", "p4"]).collect()}
    assert out[date(2020, 2, 28)] == (10.0, 1.0, None) and out[date(2020, 2, 29)] == (20.0, 1.0, None)
    assert out[date(2021, 2, 28)] == (100.0, 10.0, None) and out[date(2024, 2, 29)] == (7.0, None, 20.0) and out[None] == (5.0, None, None)


def test_missing_keys_meet_in_reconciliations(spark):
    wanted = spark.createDataFrame([(None, "a"), ("1", "b"), ("2", "c")], "number string, what string")
    store = spark.createDataFrame([("1",)], "n string")
    checked = reconcile.cross_check(wanted, {"store": (store, "n")})
    assert {r["what"] for r in reconcile.pending(wanted, checked).collect()} == {"a", "c"}
    left, right = spark.createDataFrame([(None,), ("x",), ("y",)], "l string"), spark.createDataFrame([(None,), ("x",), ("x",)], "r string")
    assert {r["k"] for r in joins.common_keys(left, "l", right, "r", "k").collect()} == {None, "x"}


@pytest.mark.parametrize("plan", [
    lambda a, b: joins.without(a, b, ["k"]), lambda a, b: joins.keep_members(a, "k", b, "k"),
    lambda a, b: reconcile.pending(a.withColumnRenamed("k", "number"), b.select(F.col("k").alias("number"), F.lit(0).alias("found")))])
def test_the_right_side_of_a_filtering_join_is_reduced_first(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = spark.createDataFrame([(1, k) for k in range(20)] + [(None, 0)], "k int, v int")
        shape = plan(spark.createDataFrame([(1, 0), (2, 0), (None, 0)], "k int, v int"), many)
        text = shape._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in text and "SortMergeJoin" in text
        assert shape.count() in (1, 2)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("n_values", [3, 200])
def test_spread_has_one_type_rule_and_a_total_of_all_rows(spark, n_values):
    df = spark.createDataFrame([("a", 1, 5), ("a", 9999, 1), ("b", 2, 7)], "k string, name int, n int")
    out = reshape.spread(df, ["k"], "name", list(range(1, n_values + 1)), "n", fill=0.0)
    assert {kind for c, kind in out.dtypes if c != "k"} == {"bigint"}
    with_total = {r["k"]: r["all"] for r in reshape.spread(df, ["k"], "name", list(range(1, n_values + 1)), "n", total="all").collect()}
    assert with_total == {"a": 6, "b": 7}


def test_spread_of_the_names_that_occur(spark):
    df = spark.createDataFrame([("a", "x", 5), ("a", "z", 1), ("b", "y", 7), ("c", None, 1)], "k string, name string, n int")
    out = reshape.spread_found(df, ["k"], "name", "n")
    assert out.columns == ["k", "x", "y", "z"] and out.count() == 3
    with pytest.raises(ValueError):
        reshape.spread_found(df, ["k"], "name", "n", most=2)


def test_results_count_unlisted_years(spark):
    trades = spark.createDataFrame([("s", 2023, 1.0), ("s", 2019, 5.0)], "symbol string, year int, net_usd double")
    assert ops.results_by_symbol(trades, [2023]).first()["overview"] == 6.0


def test_new_heads_look_at_all_other_months(spark):
    rows = spark.createDataFrame([("a", date(2020, 8, 1)), ("b", date(2020, 8, 1)), ("b", date(2015, 1, 1))], "name string, date date")
    assert [r["name"] for r in people.new_heads(rows, "2020-08-01").collect()] == ["a"]


def test_overview_keeps_years_apart(spark):
    facts = spark.createDataFrame([("c", "actuals", date(2020, 1, 1), 1.0), ("c", "actuals", date(2021, 1, 1), 1.0)], "category string, type string, period date, value double")
    assert sorted((r["year"], r["Jan"]) for r in close.overview(facts).collect()) == [(2020, 1.0), (2021, 1.0)]


def test_calendar_covers_the_data(spark):
    days = spark.createDataFrame([(date(2030, 5, 3),), (date(2030, 5, 6),), (None,)], "d date")
    assert [r["data_date"].day for r in calendar_of(days, "d", business_days_only=True).orderBy("data_date").collect()] == [3, 6]
    assert calendar_of(days.filter("d IS NULL"), "d").count() == 0


def test_newest_rows_are_found_without_a_sort(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    plan = windows.latest_per_group(lines, ["l_suppkey"], "l_shipdate")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "Window" not in plan and "Sort " not in plan


@pytest.mark.parametrize("part_items", [1, 7, 10_000])
def test_repeated_items_of_a_hot_group_are_dealt_out(spark, part_items):
    rows = [("hot", "same")] * 500 + [("hot", f"i{k:03}") for k in range(50)] + [("cold", "z"), ("cold", None), (None, "n")]
    df = spark.createDataFrame(rows, "k string, v string").repartition(7)
    out = windows.flatten_text(df, ["k"], "v", "t", part_items=part_items)
    whole = {}
    for r in sorted(out.collect(), key=lambda r: r["part"]):
        assert r["n_items"] <= part_items
        whole.setdefault(r["k"], []).append(r["t"])
    assert {k: ",".join(v) for k, v in whole.items()} == {"hot": ",".join(sorted(v for k, v in rows if k == "hot")), "cold": "z", None: "n"}
    assert {r["k"]: r["n_items"] for r in windows.group_sizes(df, ["k"], "v").collect()} == {"hot": 550, "cold": 1, None: 1}


def test_words_of_repeated_and_missing_ids_equal_the_sql(spark, tmp_path):
    rows = [(1, "a b a"), (1, "a c"), (1, "a c"), (2, "a  b"), (None, "a d"), (None, "d"), (3, None), (4, "")]
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = {tuple(r) for r in QUERIES["F14_unnest"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert got == set(con.execute(ORACLES["F14_unnest"]).fetchall())
