"""Matrices in blocks of columns, codes by their rarest gram, latest rows in two phases."""

import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators import joins, reshape, rules, windows
from tests.test_digests import shuffled_rows


@pytest.mark.parametrize("size", [1, 7, 256])
def test_blocks_hold_every_cell(spark, size):
    rng = random.Random(size)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *(f"n{k:03}" for k in range(90))]), rng.choice([None, float(rng.randrange(50))])) for _ in range(700)]
    df = spark.createDataFrame(rows, "id string, name string, v double").repartition(4)
    blocks = reshape.spread_blocks(df, ["id"], "name", "v", size)
    sums = {}
    for i, n, v in rows:
        if n is not None and v is not None:
            sums[i, n] = sums.get((i, n), 0) + v
    names = sorted({n for _, n, _ in rows if n is not None})
    got = {(r["id"], r["name"]): (r["v"], r["block"], r["position"]) for r in reshape.block_cells(blocks, ["id"], "v").collect()}
    assert got == {(i, n): (v, names.index(n) // size, names.index(n) % size) for (i, n), v in sums.items()}
    some = ["n003", "n089", "none such"]
    picked = {r["id"]: (r["n003"], r["n089"], r["none such"]) for r in reshape.block_columns(blocks, ["id"], some).collect()}
    assert picked == {i: (sums.get((i, "n003")), sums.get((i, "n089")), None) for i in {i for i, n in sums if n in some}}


def test_ten_thousand_names(spark):
    df = spark.range(10_000).select((F.col("id") % 3).alias("k"), F.format_string("name %05d", "id").alias("name"), F.lit(1).alias("n"))
    blocks = reshape.spread_blocks(df, ["k"], "name", "n")
    assert blocks.manifest.count() == 10_000 and blocks.cells.count() == 3 * 40
    assert {F_size for F_size, in blocks.cells.select(F.size("values")).distinct().collect()} == {256}
    assert blocks.cells.select(F.explode("values").alias("v")).filter("v = 1").count() == 10_000


def test_no_names(spark):
    none = spark.createDataFrame([("a", None, 1.0)], "id string, name string, v double")
    blocks = reshape.spread_blocks(none, ["id"], "name", "v")
    assert blocks.cells.collect() == [] and blocks.manifest.collect() == []


def indexed(df, text, codes, code):
    return joins.containing_any_indexed(df, text, codes, code)


def test_codes_by_their_rarest_gram(spark):
    rng = random.Random(3)
    texts = [(i, "".join(rng.choice("abcü") for _ in range(rng.randrange(0, 12)))) for i in range(400)] + [(400, None)]
    df = spark.createDataFrame(texts, "id int, t string")
    for codes in ([("ab",), ("cca",), ("bbbb",), ("",), ("a" * 30,), (None,)], [("üa",), ("üab",)], [("a",), ("zzz",)], [("",), (None,)], []):
        table = spark.createDataFrame(codes, "c string")
        got = {r["id"] for r in indexed(df, "t", table, "c").collect()}
        assert got == {i for i, t in texts if t is not None and any(c and c in t for (c,) in codes)}, codes
    plan = indexed(df, "t", table, "c")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_codes_that_begin_alike_shuffle_few_grams(spark, monkeypatch):
    monkeypatch.setattr(joins, "COUNTED_BUCKETS", 256)
    texts = 20_000
    df = spark.range(texts).select("id", F.format_string("department/office/building/%06d", F.col("id") * 7919 % 1_000_003).alias("t"))
    codes = spark.range(300).select(F.format_string("department/office/building/%06d", F.col("id") * 3331 % 1_000_003).alias("c")).unionByName(spark.createDataFrame([("9173",)], "c string"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found, old = indexed(df, "t", codes, "c"), joins.containing_any(df, "t", codes, "c")
        assert sorted(r["id"] for r in found.collect()) == sorted(r["id"] for r in old.collect())
        # Both shuffle the distinct texts and the rows of the table; the rest are grams.
        assert shuffled_rows(found) - 2 * texts < 0.1 * (shuffled_rows(old) - 2 * texts)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_latest_rows_of_missing_keys_and_dates(spark, threshold):
    rows = [(None, 3), (None, 3), (None, 1), ("a", None), ("b", 2), ("b", None), *[("hot", k % 50) for k in range(500)]]
    df = spark.createDataFrame(rows, "k string, d int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    got = sorted((tuple(r) for r in windows.latest_per_group(df, ["k"], "d").collect()), key=str)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == sorted([(None, 3), (None, 3), ("b", 2), *[("hot", 49)] * 10], key=str)


def test_rules_of_a_table_equal_the_chain(spark):
    rng = random.Random(9)
    texts = [(k, "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 14)))) for k in range(300)] + [(900, None), (901, "")]
    df = spark.createDataFrame(texts, "id int, t string")
    for listed in ([("ab", "one"), ("b", "two"), ("c a", "three"), ("ccc", "four"), ("zz", "five")], [("cab", "x"), ("", "all"), ("a", "never")], [("abc", "same"), ("bca", "same")], []):
        rows = [(k, kw, label) for k, (kw, label) in enumerate(listed)] + [(50, None, "null")]
        table = spark.createDataFrame(rows, "rank int, keyword string, label string")
        for default in (None, "rest"):
            got = {r["id"]: r["to"] for r in joins.first_match(df, "t", table, "to", default).collect()}
            want = {r["id"]: r["to"] for r in df.select("id", rules.categorise("t", listed, default).alias("to")).collect()}
            assert got == want, (listed, default)


def test_equal_ranks_and_five_thousand_rules(spark):
    df = spark.range(500).select("id", F.format_string("goods no. %05d for resale", F.col("id") * 9).alias("t"))
    many = spark.range(5_000).select(F.floor(F.col("id") / 2).alias("rank"), F.format_string("no. %05d", "id").alias("keyword"), F.format_string("class %d", "id").alias("label"))
    found = joins.first_match(df, "t", many.unionByName(many), "to", "none")
    assert {r["id"]: r["to"] for r in found.collect()} == {k: f"class {9 * k}" if 9 * k < 5_000 else "none" for k in range(500)}
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 60_000
