"""Order-dependent and text operators against brute force, with one key that holds a third of the rows."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallyline.operators import joins, reshape, windows
from tallyline.plans import daily, fx, ops, reconcile


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(40)}"
        rows.append((key, i, f"head{i}" if rng.random() < 0.02 else None, rng.randrange(1000) / 4))
    return rows


@pytest.fixture(scope="module")
def table(spark, skewed):
    return spark.createDataFrame(skewed, "key string, pos long, head string, value double").repartition(8)


def test_row_index_counts_through(table, skewed):
    rows = windows.row_index(table, ["key", "pos"], "index", start=2).collect()
    expected = {(r[0], r[1]): i for i, r in enumerate(sorted(skewed, key=lambda r: (r[0], r[1])), 2)}
    assert {(r["key"], r["pos"]): r["index"] for r in rows} == expected


@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 20])
def test_fill_down_for_any_chunk(table, skewed, chunk):
    got = {(r["key"], r["pos"]): r["section"] for r in windows.fill_down(table, ["key"], "pos", "head", "section", chunk=chunk).collect()}
    last, expected = {}, {}
    for key, pos, head, _ in sorted(skewed, key=lambda r: r[1]):
        last[key] = head or last.get(key)
        expected[key, pos] = last[key]
    assert got == expected


@pytest.mark.parametrize("part_items", [10, 100, 100000])
def test_flattened_parts_make_up_the_whole_text(table, skewed, part_items):
    named = table.withColumn("item", F.lpad(F.col("pos").cast("string"), 5, "0"))
    rows = windows.flatten_text(named, ["key"], "item", "text", part_items=part_items).collect()
    assert max(r["n_items"] for r in rows) <= part_items
    parts = {}
    for r in sorted(rows, key=lambda r: (r["key"], r["part"])):
        parts.setdefault(r["key"], []).append(r["text"])
    expected = {}
    for key, pos, *_ in sorted(skewed, key=lambda r: r[1]):
        expected.setdefault(key, []).append(f"{pos:05d}")
    assert {k: ",".join(v) for k, v in parts.items()} == {k: ",".join(v) for k, v in expected.items()}


def test_flattened_text_with_missing_group_key(spark):
    df = spark.createDataFrame([(None, "b"), (None, "a"), ("x", "c"), ("x", None)], "k string, v string")
    assert {r["k"]: r["t"] for r in windows.flatten_text(df, ["k"], "v", "t").collect()} == {None: "a,b", "x": "c"}
    assert len(windows.flatten_text(df, ["k"], "v", "t", part_items=1).collect()) == 3


def test_first_rows_are_cut_before_the_shuffle(table, skewed):
    first = windows.first_rows(table, ["key"], ["pos"], 2)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    seen = {}
    for key, pos, *_ in sorted(skewed, key=lambda r: r[1]):
        seen.setdefault(key, []).append(pos)
    assert sorted((r["key"], r["pos"]) for r in first.collect()) == sorted((k, p) for k, ps in seen.items() for p in ps[:2])


def test_latest_per_group_keeps_ties(table, skewed):
    dated = table.withColumn("day", F.floor(F.col("pos") / 100))
    newest = {}
    for key, pos, *_ in skewed:
        newest[key] = max(newest.get(key, -1), pos // 100)
    expected = sorted((k, p) for k, p, *_ in skewed if p // 100 == newest[k])
    assert sorted((r["key"], r["pos"]) for r in windows.latest_per_group(dated, ["key"], "day").collect()) == expected


def test_containing_any_code(spark):
    rng = random.Random(3)
    texts = [(i, "".join(rng.choice("abc") for _ in range(rng.randrange(0, 12)))) for i in range(400)] + [(400, None)]
    codes = [("ab",), ("cca",), ("bbbb",), ("",), ("a" * 30,), (None,)]
    df = spark.createDataFrame(texts, "id int, t string")
    got = {r["id"] for r in joins.containing_any(df, "t", spark.createDataFrame(codes, "c string"), "c").collect()}
    assert got == {i for i, t in texts if t is not None and any(c and c in t for (c,) in codes)}
    plan = joins.containing_any(df, "t", spark.createDataFrame(codes, "c string"), "c")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_prior_years(spark):
    rows = [("a", date(y, m, 1), float(y * 100 + m)) for y in range(2000, 2005) for m in (1, 2) if (y, m) != (2002, 2)]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    lookup = {(r[1].year, r[1].month): r[2] for r in rows}
    out = reshape.shift_years(df, "d", ["k"], "v", ["py", "ppy"]).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r["py"] == lookup.get((r["d"].year - 1, r["d"].month))
        assert r["ppy"] == lookup.get((r["d"].year - 2, r["d"].month))


def test_tracking_against_a_loop_over_days(spark):
    rng = random.Random(11)
    days = [date(2019, 12, 25) + timedelta(d) for d in range(460)]
    sales = [(r, "c", d, float(rng.randrange(100))) for r in ("hot", "hot", "x", "y") for d in days if rng.random() < 0.6]
    df = spark.createDataFrame([(*s, 0.5, 0.25) for s in sales], "region string, category string, day date, actuals double, qr double, op double")
    forecast = spark.createDataFrame([("hot", "c", 2021, 1, 10.0, 20.0, 5.0), ("hot", "c", 2020, 1, 1.0, 2.0, 3.0)],
                                     "region string, category string, year int, month int, fcast double, budget double, posted double")
    out = daily.track(df, forecast).collect()

    def total(region, test):
        hits = [v for r, _, d, v in sales if r == region and test(d)]
        return sum(hits) if hits else None

    assert len(out) == len({(r, d) for r, _, d, _ in sales})
    for r in out:
        y, m, n = r["year"], r["month"], r["day_no"]
        assert r["py_actuals"] == total(r["region"], lambda d: (d.year, d.month, d.day) == (y - 1, m, n))
        assert r["mtd_actuals"] == total(r["region"], lambda d: (d.year, d.month) == (y, m) and d.day <= n)
        assert r["py_mtd_actuals"] == total(r["region"], lambda d: (d.year, d.month) == (y - 1, m) and d.day <= n)
        if r["region"] == "hot" and (y, m) == (2021, 1):
            assert (r["fcast"], r["py_posted"]) == (10.0, 3.0)
    one = {tuple(r) for r in daily.track_day(df, forecast, date(2021, 1, 9)).collect()}
    assert one == {tuple(r) for r in out if (r["year"], r["month"], r["day_no"]) == (2021, 1, 9)}


def test_sales_vs_billing_with_a_hot_code(spark):
    rng = random.Random(5)
    def side(n):
        return [("hot" if rng.random() < 0.34 else f"c{rng.randrange(30)}", f"b{rng.randrange(5)}", float(rng.randrange(9)), 1.0) for _ in range(n)]
    bills, sold = side(500), side(60)
    schema = "code string, brand string, shipped double, cost double"
    out = reconcile.sales_vs_billing(spark.createDataFrame(bills, schema), spark.createDataFrame(sold, schema)).collect()
    common = {r[0] for r in bills} & {r[0] for r in sold}
    assert {(r["code"], r["brand"]) for r in out} == {(r[0], r[1]) for r in bills + sold if r[0] in common}
    for r in out:
        assert r["shipped_bills"] == sum(x[2] for x in bills if x[:2] == (r["code"], r["brand"]))


def test_compression_keeps_the_rows_of_the_first_account(spark):
    schema = "segment string, region string, lc string, entity string, month string, {} double"
    sales = spark.createDataFrame([("Core", "na", "C1", "e1", "Jan", 5.0), ("Core", "na", "C1", "e2", "Feb", 0.0)], schema.format("netsales"))
    margin = spark.createDataFrame([("Core", "na", "C1", "e1", "Jan", 2.0), ("Core", "na", "C1", "e1", "Feb", 9.0), ("Core", "na", "C1", "e3", "Jan", 1.0)], schema.format("sgm"))
    out = fx.compress_accounts({"netsales": sales, "sgm": margin}, ["segment", "region", "lc", "entity", "month"], ["Jan", "Feb"]).collect()
    assert [(r["entity"], r["region"], r["netsales_Jan"], r["sgm_Jan"], r["sgm_Feb"]) for r in out] == [("e1", "NA", 5.0, 2.0, 0.0)]


def test_policy_table_with_one_long_document(spark):
    rows = []
    for doc, n in (("hot", 300), ("small", 9)):
        for i in range(n):
            head = i % 5 == 0
            control = f"CT{i // 5:05d}: text {i}" if head else f"more {i}"
            rows.append((doc, i, f" Related to C{i // 50}", control, f"test {i}" if i % 5 == 2 else None, None))
    df = spark.createDataFrame(rows, "doc string, position int, criteria string, control string, test string, result string")
    out = ops.policy_table(df).collect()
    assert len(out) == 60 + 2
    row = next(r for r in out if r["doc"] == "hot" and r["policy"] == "CT00003")
    assert row["n_controls"] == 5
    for size in (1, 2, 1000):
        parts = sorted((r for r in ops.control_texts(df, part_items=size).collect() if (r["doc"], r["policy"]) == ("hot", "CT00003")), key=lambda r: r["part"])
        assert " ".join(r["controls"] for r in parts) == "CT00003: text 15 more 16 more 17 more 18 more 19"
    assert (row["criteria"], row["test"], row["result"]) == ("C0", "test 17", "No deviations noted.")
