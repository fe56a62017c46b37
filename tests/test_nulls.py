"""Missing-value rules on tiny hand-made tables."""

import datetime

import pytest
from pyspark.sql import functions as F

from tallyline.functions import nulls, periods, text
from tallyline.operators import columns, joins, reshape, rules, totals


def values(df, column):
    return [r[column] for r in df.collect()]


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame([(1, "OPG Core"), (2, None), (3, "Tools")], "id int, name string")


def test_negative_pattern_keeps_missing(words):
    assert values(words.filter(nulls.lacks("name", "OPG")).orderBy("id"), "id") == [2, 3]
    assert values(words.filter(nulls.matches("name", "OPG")), "id") == [1]


def test_negative_membership_keeps_missing(words):
    assert values(words.filter(nulls.none_of("name", ["Tools"])).orderBy("id"), "id") == [1, 2]


def test_two_way_choice_is_missing_for_missing_condition(words):
    chosen = words.orderBy("id").select(nulls.if_else(F.col("name") == "Tools", F.lit("yes"), F.lit("no")).alias("c"))
    assert values(chosen, "c") == ["no", None, "yes"]


def test_sums(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("c", None)], "k string, v double")
    out = {r["k"]: (r["s"], r["l"], r["m"]) for r in df.groupBy("k").agg(
        nulls.strict_sum("v").alias("s"), nulls.loose_sum("v").alias("l"), nulls.mean_over_rows("v").alias("m")).collect()}
    assert out == {"a": (None, 1.0, 0.5), "b": (2.0, 2.0, 2.0), "c": (None, 0.0, None)}


def test_strict_sum_over_a_condition(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", None), ("b", "y", 4.0)], "k string, t string, v double")
    out = df.groupBy("k").agg(nulls.strict_sum_where("v", F.col("t") == "x").alias("x"), nulls.strict_sum_where("v", F.col("t") == "y").alias("y"))
    assert {r["k"]: (r["x"], r["y"]) for r in out.collect()} == {"a": (1.0, None), "b": (None, 4.0)}


def test_undefined_ratios(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (None, 2.0), (3.0, 2.0)], "a double, b double")
    assert values(df.select(nulls.ratio("a", "b").alias("r")), "r") == [0.0, 0.0, 0.0, 1.5]
    assert values(df.select(nulls.ratio_or_null("a", "b").alias("r")), "r") == [None, None, None, 1.5]


def test_numbers_rounding_and_slices(spark):
    df = spark.createDataFrame([("12.5", 25.0), ("abc", 35.0)], "t string, v double")
    assert values(df.select(nulls.to_number("t").alias("n")), "n") == [12.5, None]
    assert values(df.select(nulls.half_even("v", -1).alias("n")), "n") == [20.0, 40.0]
    assert values(df.select(text.slice_text("t", 0, 2).alias("n")), "n") == ["12", "ab"]


def test_pieces_are_missing_beyond_the_end(spark):
    df = spark.createDataFrame([("a-b-c",), ("a",)], "t string")
    assert values(df.select(text.piece("t", "-", 1).alias("p")), "p") == ["b", None]


def test_gather_keeps_missing_cells(spark):
    df = spark.createDataFrame([("a", 1.0, None)], "k string, x double, y double")
    assert sorted(values(reshape.gather(df, ["k"], "n", "v"), "n")) == ["x", "y"]


def test_month_numbers(spark):
    df = spark.createDataFrame([("March",), ("Mars",), (None,)], "m string")
    assert values(df.select(periods.month_number("m").alias("n")), "n") == [3, None, None]


def test_serial_dates_and_month_ends(spark):
    one = spark.createDataFrame([(44562.75,)], "n double")
    assert one.select(periods.from_serial("n").alias("d")).first()["d"] == datetime.date(2022, 1, 1)
    assert one.select(periods.from_serial("n", periods.LATE_ORIGIN).alias("d")).first()["d"] == datetime.date(2022, 1, 2)
    day = spark.createDataFrame([(datetime.date(2024, 2, 29),)], "d date")
    assert day.select(F.add_months("d", -12).alias("d")).first()["d"] == datetime.date(2023, 2, 28)


def test_missing_keys_match_missing_keys(spark):
    a = spark.createDataFrame([("x",), (None,), ("y",)], "k string")
    b = spark.createDataFrame([(None,), ("x",)], "k string")
    assert values(joins.without(a, b, ["k"]), "k") == ["y"]
    assert [(r["k"], r["found_in"]) for r in joins.missing_both_ways(a, b, ["k"]).collect()] == [("y", "left")]
    assert {r["k"]: r["f"] for r in joins.membership(a, "k", b, "k", "f").collect()} == {"x": 1, None: 1, "y": 0}


def test_rules_take_the_first_match_and_the_default_for_missing(words):
    label = rules.categorise("name", [("Core", "first"), ("OPG", "second")], "Others")
    assert values(words.orderBy("id").select(label.alias("c")), "c") == ["first", "Others", "Others"]


def test_override_is_missing_where_the_amount_is(spark):
    df = spark.createDataFrame([(1, "T", 6000.0), (2, "T", None), (3, "T", -6000.0), (4, "S", 6000.0)], "id int, n string, v double")
    name = rules.override_name("n", "v", F.lit("other"), "T", 5000, -5000)
    assert values(df.orderBy("id").select(name.alias("c")), "c") == ["other", None, "other", "S"]


def test_split_measure_reads_the_old_account(spark):
    df = spark.createDataFrame([("HC", 2.0), ("Capex", 5.0)], "a string, v double")
    account, count, amount = rules.split_measure("a", "v", "HC", "C&B")
    assert [tuple(r) for r in df.select(account, count, amount).collect()] == [("C&B", 2.0, 0.0), ("Capex", 0.0, 5.0)]


def test_clean_headers():
    assert columns.clean_headers(["Growth.Initiative", "FY 22 %", "2021", "team", "Team", "SG&A"]) == [
        "growth_initiative", "fy_22_percent", "x2021", "team", "team_2", "sg_a"]


def test_columns_by_pattern_ignore_case():
    assert columns.pick_names(["Q1", "January", "FY", "employee"], contains=["q"], starts_with=["fy"]) == ["Q1", "FY"]


def test_drop_empty_columns(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", None)], "a int, b string, c string")
    assert columns.drop_empty_columns(df).columns == ["a", "b"]


def test_totals_row(spark):
    df = spark.createDataFrame([("a", "x", 1.5, 2), ("b", "y", None, 3)], "k string, l string, v double, n int")
    assert [tuple(r) for r in totals.add_totals(df, "k").collect()][-1] == ("Total", "-", 1.5, 5)


def test_residual_line(spark):
    df = spark.createDataFrame([(1, "all", 10.0), (1, "x", 4.0), (1, "y", 1.0), (2, "x", 3.0), (3, "all", 7.0)], "k int, m string, v double")
    rest = totals.residual_line(df, ["k"], "m", "all", ["x", "y"], "v", "Other").filter("m = 'Other'")
    assert {r["k"]: r["v"] for r in rest.collect()} == {1: 5.0, 3: 7.0}


def test_spread_forms_agree(spark):
    rows = [(k, n, float(k * n)) for k in range(4) for n in range(40) if (k + n) % 3]
    df = spark.createDataFrame(rows, "k int, n int, v double")
    names = list(range(40))
    wide = {r["k"]: r.asDict() for r in reshape.spread(df, ["k"], "n", names, "v", fill=0.0).collect()}
    limit = reshape.CONDITIONAL_CELLS
    try:
        reshape.CONDITIONAL_CELLS = 10
        pivoted = {r["k"]: r.asDict() for r in reshape.spread(df, ["k"], "n", names, "v", fill=0.0).collect()}
        both = reshape.spread(df.withColumn("w", F.col("v") * 2), ["k"], "n", names, ["v", "w"])
    finally:
        reshape.CONDITIONAL_CELLS = limit
    assert wide == pivoted
    assert {"v_0", "w_39"} <= set(both.columns)
