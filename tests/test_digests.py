"""Tie-out by digests against plain sums, and what it shuffles and reads."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyline.operators import digests
from tallyline.session import scratch_folder

SHAPE = "k1 string, k2 bigint, amount double, units double, leaf string, coarse string"
KEYS, MEASURES, NAMES = ["k1", "k2"], ["amount", "units"], ("old", "new")


def plain(left, right):
    sums = [defaultdict(lambda: [0, 0]) for _ in range(2)]
    for side, rows in zip(sums, (left, right), strict=True):
        for a, b, x, y in rows:
            side[a, b][0] += round((x or 0) * 100)
            side[a, b][1] += round((y or 0) * 100)
    out = set()
    for key in set(sums[0]) | set(sums[1]):
        a, b = (s.get(key) for s in sums)
        if a != b:
            out.add((*key, *[v[k] / 100 if v else None for k in (0, 1) for v in (a, b)], a is not None, b is not None))
    return out


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SHAPE).repartition(parts)


def invented(seed):
    rng = random.Random(seed)
    left = [(rng.choice([None, "a", "b", "hot", "hot", "hot"]), rng.choice([None, *range(60)]), round(rng.uniform(-500, 500), 2), float(rng.randrange(9))) for _ in range(2_000)]
    right = left[:]
    rng.shuffle(right)
    for _ in range(15):
        k = rng.randrange(len(right))
        right[k] = (*right[k][:2], right[k][2] + rng.choice([0.01, -7.5, None, 21_474_836.47, 2 * 21_474_836.29]) if rng.random() < 0 else rng.choice([None, 3.33, right[k][2] + 21_474_836.47]), right[k][3])
    right += [("new", 1, 0.0, 0.0), (None, None, 0.0, 0.0)]
    # Split rows and rows that cancel out leave the sums as they are.
    right = [r for x in right for r in ([(*x[:2], x[2], 0.0), (*x[:2], 0.0, x[3])] if x[1] == 7 else [x])] + [("a", 3, 5.0, 0.0), ("a", 3, -5.0, 0.0)]
    return left, right


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("named", [0, 4_096])
def test_differences_equal_plain_sums(spark, seed, named, monkeypatch):
    monkeypatch.setattr(digests, "NAMED_LEAVES", named)
    left, right = invented(seed)
    want = plain(left, right)
    got = digests.tie_out(frame(spark, left), frame(spark, right, 3), KEYS, MEASURES, NAMES).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 10
    paths = [scratch_folder(spark, "side") for _ in range(2)]
    for path, rows in zip(paths, (left, right), strict=True):
        digests.write_keyed(frame(spark, rows), path, KEYS, MEASURES)
    assert {tuple(r) for r in digests.tie_out_written(spark, *paths, KEYS, MEASURES, NAMES).collect()} == want


def test_swapped_missing_keys_do_not_cancel(spark):
    left, right = [(None, 1, 5.0, 0.0), ("1", None, 0.0, 0.0)], [(None, 1, 0.0, 0.0), ("1", None, 5.0, 0.0)]
    assert {tuple(r) for r in digests.tie_out(frame(spark, left), frame(spark, right), KEYS, MEASURES, NAMES).collect()} == plain(left, right)


def test_empty_sides(spark):
    left, none = invented(3)[0], []
    assert digests.tie_out(frame(spark, none), frame(spark, none), KEYS, MEASURES, NAMES).collect() == []
    assert {tuple(r) for r in digests.tie_out(frame(spark, left), frame(spark, none), KEYS, MEASURES, NAMES).collect()} == plain(left, none)


def shuffled_rows(df):
    """Rows that went into the shuffle by key when the table was computed."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    total, todo = 0, [plan.executedPlan() if plan.nodeName().startswith("AdaptiveSparkPlan") else plan]
    while todo:
        node = todo.pop()
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if node.nodeName() == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        todo += [node.children().apply(k) for k in range(node.children().size())]
    return total


def test_equal_buckets_are_not_shuffled_by_key(spark):
    left = spark.range(50_000).select(F.col("id").cast("string").alias("k1"), (F.col("id") % 7).alias("k2"), (F.col("id") / 4).alias("amount"), F.lit(1.0).alias("units"))
    right = left.withColumn("amount", F.when(F.col("k1") == "4711", F.col("amount") + 1).otherwise(F.col("amount"))).repartition(7)
    changed = digests.tie_out(left, right, KEYS, MEASURES, NAMES)
    assert [tuple(r)[:4] for r in changed.collect()] == [("4711", 4711 % 7, 1177.75, 1178.75)]
    assert 2 <= shuffled_rows(changed) <= 20
    # Equal tables: nothing is left to be read.
    assert shuffled_rows(digests.tie_out(left, left.repartition(3), KEYS, MEASURES, NAMES)) == 0


def test_equal_folders_are_not_read(spark):
    left = spark.range(5_000).select(F.col("id").cast("string").alias("k1"), F.lit(None).cast("bigint").alias("k2"), F.lit(2.5).alias("amount"), F.lit(1.0).alias("units"))
    paths = [scratch_folder(spark, "side") for _ in range(2)]
    for path, rows in zip(paths, (left, left.filter("k1 != '17'")), strict=True):
        digests.write_keyed(rows, path, KEYS, MEASURES)
    found = digests.tie_out_written(spark, *paths, KEYS, MEASURES, NAMES)
    assert [tuple(r) for r in found.collect()] == [("17", None, 2.5, None, 1.0, None, True, False)]
    scans = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in line]
    assert scans and all("coarse" in line.split("PartitionFilters:")[1].split("PushedFilters")[0] and "leaf" in line.split("PushedFilters:")[1] for line in scans)
