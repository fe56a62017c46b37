"""Ancestors, roll-ups and residuals against plain walks up the links."""

import random

import pytest

from tallyline.operators import ancestry as module
from tallyline.operators.ancestry import ancestry, residuals, roll_up


def plain(edges):
    """pairs with least distance, members on cycles"""
    edges = {(c, p) for c, p in edges if c is not None and p is not None}

    def above(start, links):
        seen, now, distance = {}, {start}, 0
        while now:
            distance += 1
            now = {p for c, p in links if c in now} - set(seen)
            seen |= {p: distance for p in now}
        return seen

    names = {x for e in edges for x in e}
    ring = {n for n in names if n in above(n, edges)}
    left = {(c, p) for c, p in edges if c not in ring}
    return {(n, n, 0) for n in names} | {(n, a, d) for n in names for a, d in above(n, left).items()}, ring


def check(spark, edges):
    found = ancestry(spark.createDataFrame(edges, "child string, parent string"))
    pairs, ring = plain(edges)
    got = [tuple(r) for r in found.pairs.collect()]
    assert set(got) == pairs and len(got) == len(pairs)
    assert sorted(r[0] for r in found.on_cycle.collect()) == sorted(ring)
    return found


def test_ragged_trees_and_several_parents(spark):
    rng = random.Random(4)
    edges = [(f"n{k}", f"n{rng.randrange(max(0, k - 6), k)}") for k in range(1, 120)]
    edges += [(f"n{k}", f"n{rng.randrange(0, k)}") for k in range(50, 70)] + edges[:5] + [(None, "n1"), ("n1", None), ("hot", "root")]
    edges += [(f"leaf{k}", "hot") for k in range(400)]
    check(spark, edges)


@pytest.mark.parametrize("length", [1, 2, 64, 65, 200])
def test_chains_take_few_rounds(spark, monkeypatch, length):
    labels = []
    keep = module.written
    monkeypatch.setattr(module, "written", lambda df, label: labels.append(label) or keep(df, label))
    check(spark, [(f"c{k}", f"c{k + 1}") for k in range(length)])
    assert labels.count("jumps") <= length.bit_length()


def test_cycles_are_reported_and_opened(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("x", "a"), ("y", "x"), ("c", "top"), ("self", "self"), ("s", "self"), ("p", "q"), ("q", "p"), ("lone", "end")]
    edges += [(f"r{k}", f"r{(k + 1) % 37}") for k in range(37)] + [("tail2", "tail1"), ("tail1", "r5")]
    found = check(spark, edges)
    assert ("y", "a", 2) in {tuple(r) for r in found.pairs.collect()}


def test_no_links(spark):
    found = ancestry(spark.createDataFrame([], "child string, parent string"))
    assert found.pairs.collect() == [] and found.on_cycle.collect() == []


def test_roll_up_and_residuals(spark):
    edges = [("b", "a"), ("c", "a"), ("d", "b"), ("e", "b"), ("f", "e"), ("g", "e")]
    links = spark.createDataFrame(edges, "child string, parent string")
    amounts = spark.createDataFrame([("a", 1.0), ("d", 2.0), ("d", 3.0), ("f", 10.0), ("g", None), ("nowhere", 7.0), (None, 9.0)], "name string, v double")
    rolled = {r["name"]: (r.own_v, r.total_v, r.n_below) for r in roll_up(amounts, ancestry(links), "name", ["v"]).collect()}
    assert rolled == {"a": (1, 16, 6), "b": (0, 15, 4), "c": (0, 0, 0), "d": (5, 5, 0), "e": (0, 10, 2), "f": (10, 10, 0), "g": (0, 0, 0)}
    reported = spark.createDataFrame([("a", 20.0), ("b", 15.0), ("c", 1.0), ("e", 11.0), ("f", 10.0), ("d", 5.0)], "name string, v double")
    left = {r["name"]: (r.v, r.children, r.residual, r.n_children) for r in residuals(reported, links, "name", "v").collect()}
    assert left == {"a": (20, 16, 4, 2), "b": (15, 16, -1, 2), "e": (11, 10, 1, 2)}
