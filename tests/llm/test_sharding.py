"""Sharding against plain Python, with weights, odd rows and a hot id."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest

from tallyline.llm import sharding


def plain_shard(key, weights):
    def draw(s):
        spot = int(hashlib.md5(f"{'' if key is None else key}:{s}".encode()).hexdigest()[: sharding.DIGITS], 16)
        return -math.log((spot + 0.5) / 16.0**sharding.DIGITS) / weights[s]

    return min((s for s, w in enumerate(weights) if w), key=draw)


def documents(spark, rows, columns="doc_id bigint, text string, shard string, slot int, place string, __turn int, size double"):
    return spark.createDataFrame([(*r, "x", 7, "y", 3, 0.5) for r in rows], columns)


ODD = [(None, None), (None, "no id"), (1, ""), (2, None), (3, "ünï \U0001f600"), (3, "ünï \U0001f600"), (3, "other"), (4, "w " * 200_000), (-5, "minus")]


def test_plan_of_odd_rows_and_a_hot_id(spark):
    rows = ODD + [(77, "same")] * 3_000 + [(k, f"text {k % 50}") for k in range(100, 6_100)]
    got = sharding.plan(documents(spark, rows).repartition(13), [1.0] * 8).collect()
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), plain_shard(d, [1.0] * 8), plain_shard(d, [1.0] * 9)) for d, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got) == want
    assert all(r.grown_shard in (r.shard, 8) and r.law == "key" for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(((r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size), r.slot))
    for own in slots.values():
        assert [s for _, s in sorted(own, key=lambda x: x[1])] == list(range(len(own)))
        assert [k for k, _ in sorted(own, key=lambda x: x[1])] == sorted(k for k, _ in own)
    assert sharding.plan(documents(spark, rows).limit(0), [1.0] * 8).collect() == []


def test_weights_share_out_the_keys_and_changes_move_few(spark):
    weights = [1.0, 2.0, 0.0, 4.5, 0.5]
    keys = spark.range(40_000).withColumnRenamed("id", "doc_id")
    rows = keys.select("doc_id", sharding.shard_of(keys.doc_id, weights).alias("a"), sharding.shard_of(keys.doc_id, [*weights, 2.0]).alias("more"),
                       sharding.shard_of(keys.doc_id, [1.0, 2.0, 0.0, 0.0, 0.5]).alias("less"), sharding.shard_of(keys.doc_id, [1.0, 3.0, 0.0, 4.5, 0.5]).alias("heavier")).collect()
    assert all(r.a == plain_shard(r.doc_id, weights) for r in rows[:500])
    found = Counter(r.a for r in rows)
    assert found[2] == 0 and all(abs(found[s] / len(rows) - w / 8.0) < 0.01 for s, w in enumerate(weights))
    assert all(r.more in (r.a, 5) for r in rows) and abs(sum(r.more == 5 for r in rows) / len(rows) - 0.2) < 0.01
    assert all(r.less == r.a or r.a == 3 for r in rows) and all(r.heavier in (r.a, 1) for r in rows)


@pytest.mark.parametrize("weights", [[], [0.0, 0.0], [1.0, -1.0]])
def test_weights_that_make_no_sense(spark, weights):
    with pytest.raises(ValueError):
        sharding.shard_of(spark.range(1).id, weights)


def test_a_file_tree_holds_every_row_in_its_shard(spark, tmp_path):
    rows = ODD + [(k, f"text {k}") for k in range(100, 700)]
    docs = documents(spark, rows).drop("shard")
    sharding.write(docs, f"{tmp_path}/out", [1.0, 2.0, 1.0])
    back = spark.read.schema(docs.schema.simpleString()[7:-1].replace(":", " ") + ", shard int").parquet(f"{tmp_path}/out")
    assert Counter((r.doc_id, r.text, r.place, r.shard) for r in back.collect()) == Counter((d, t, "y", plain_shard(d, [1.0, 2.0, 1.0])) for d, t in rows)


def test_no_python_on_the_way(spark, capsys):
    sharding.plan(documents(spark, ODD), [1.0] * 8).explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
