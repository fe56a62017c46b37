"""A cube of deltas against the statement of the whole book, and what a refresh reads."""

import random
from collections import Counter
from datetime import date

import pytest

from tallyline.plans import cube_log, pnl
from tallyline.session import scratch_folder

SHAPE = "region string, channel string, product string, account string, scenario string, ref_date date, result double"


def lines(spark, rows):
    return spark.createDataFrame(rows, SHAPE)


def posted(rng, months, count=150):
    accounts = pnl.Accounts().listed()
    return [(rng.choice(["east", None]), rng.choice("xy"), "p", rng.choice(accounts), rng.choice(pnl.SCENARIOS), rng.choice(months), rng.choice([None, float(rng.randrange(-400, 900)) / 4])) for _ in range(count)]


def rows_of(df):
    return Counter(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.fixture(scope="module")
def refreshes():
    rng = random.Random(11)
    old, new = [date(y, m, 1) for y in (2017, 2018, 2019) for m in (1, 2, 6)], [date(2020, m, 1) for m in (1, 2)]
    return {"old": posted(rng, [*old, None], 400), "late": posted(rng, [date(2018, 2, 1)]), "new": posted(rng, new), "wrong": posted(rng, [date(2018, 6, 1), date(2020, 3, 1)])}


def test_after_each_refresh_it_equals_the_whole_book(spark, refreshes):
    path = scratch_folder(spark, "cube")
    cube_log.create(spark, path)
    assert cube_log.statement(spark, path).collect() == []
    live = {}
    steps = [("r1", refreshes["old"]), ("r2", refreshes["wrong"]), ("r3", refreshes["new"]), ("r2", refreshes["late"]), ("r4", []), ("r2", refreshes["late"][:20])]
    for run, rows in steps:
        cube_log.append(lines(spark, rows), path, run)
        live[run] = rows
        whole = pnl.statement(lines(spark, [r for own in live.values() for r in own]))
        shown = cube_log.statement(spark, path)
        assert shown.columns == whole.columns
        got, want = rows_of(shown), rows_of(whole)
        assert (got - want, want - got) == ({}, {}), run


def test_a_refresh_derives_and_reads_only_its_months(spark, refreshes):
    path = scratch_folder(spark, "cube")
    cube_log.create(spark, path)
    first = cube_log.append(lines(spark, refreshes["old"]), path, "r1")
    assert set(first["touched"]) == {"none", *(f"{y}-{m:02}" for y in (2017, 2018, 2019) for m in (1, 2, 6))} == set(first["derived"])
    line = cube_log.append(lines(spark, refreshes["late"]), path, "r2")
    assert (line["touched"], line["derived"]) == (["2018-02"], ["2018-02", "2019-02"])
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = cube_log.derived(spark, path, [first["write"], line["write"]], line["derived"])._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [x.split("PartitionFilters:")[1].split("PushedFilters")[0] for x in plan.splitlines() if "FileScan parquet" in x]
    assert scans and all("2018-02" in s and "2017-02" in s and "-01" not in s and "-06" not in s and "none" not in s for s in scans)


def test_what_was_not_published_is_not_read(spark, refreshes, monkeypatch):
    path = scratch_folder(spark, "cube")
    cube_log.create(spark, path)
    cube_log.append(lines(spark, refreshes["old"]), path, "r1")
    before = rows_of(cube_log.statement(spark, path))
    monkeypatch.setattr(cube_log, "derived", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        cube_log.append(lines(spark, refreshes["late"]), path, "r2")
    monkeypatch.undo()
    assert rows_of(cube_log.statement(spark, path)) == before
    cube_log.append(lines(spark, refreshes["late"]), path, "r2")
    assert rows_of(cube_log.statement(spark, path)) == rows_of(pnl.statement(lines(spark, refreshes["old"] + refreshes["late"])))


def test_one_month_of_the_statement(spark, refreshes):
    path = scratch_folder(spark, "cube")
    cube_log.create(spark, path)
    cube_log.append(lines(spark, refreshes["old"]), path, "r1")
    one = cube_log.statement(spark, path, ["2019-06"])
    assert {r.ref_date for r in one.collect()} == {date(2019, 6, 1)}
    assert rows_of(one) == rows_of(pnl.statement(lines(spark, refreshes["old"])).filter("ref_date = DATE '2019-06-01'"))
