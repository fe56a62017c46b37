"""Readers and writers on small files."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyline.session import scratch_folder
from tallyline.sources import readers, writers


@pytest.fixture
def root(spark):
    return scratch_folder(spark, "test")


def test_text_na_survives_and_empty_is_missing(spark, root):
    rows = spark.createDataFrame([("NA", 1.0), (None, 2.0)], "region string, v double")
    writers.write_delimited(rows, root, "|")
    back = readers.read_delimited(spark, root, "region string, v double", "|")
    assert {(r["region"], r["v"]) for r in back.collect()} == {("NA", 1.0), (None, 2.0)}


def test_files_with_other_columns_are_united(spark, root):
    writers.write_delimited(spark.createDataFrame([(1, "x")], "`Team Name` int, A string"), f"{root}/one")
    writers.write_delimited(spark.createDataFrame([(2.5, 2)], "B double, `Team Name` int"), f"{root}/two")
    out = readers.read_many(spark, root)
    assert {(r["team_name"], r["a"], r["b"]) for r in out.collect()} == {("1", "x", None), ("2", None, "2.5")}
    assert out.filter(F.col("file_name").endswith(".csv")).count() == 2


def test_header_in_the_second_line(spark, root):
    lines = spark.createDataFrame([("Report,,",), ("Team,Growth.Initiative,Value",), ("a,x,1",), ("b,,2",)], "value string")
    lines.coalesce(1).write.text(root)
    out = readers.promote_header(spark, root, row=2)
    assert out.columns == ["team", "growth_initiative", "value"]
    assert sorted(tuple(r) for r in out.collect()) == [("a", "x", "1"), ("b", None, "2")]


def test_newest_source_by_date_then_code(spark):
    names = ["P_20220101_000009.csv", "P_20220301_000002.csv", "P_20220301_000010.csv", "other.csv"]
    files = spark.createDataFrame([(f"in/{n}", n) for n in names], "path string, file string")
    found = readers.newest_source(files, r"_(\d{8})_", r"_(\d{6})\.").first()
    assert (found["file"], found["code"]) == ("P_20220301_000010.csv", 10)


def test_inventory_reads_no_content(spark, root):
    writers.write_delimited(spark.createDataFrame([(1,)], "a int"), f"{root}/NA/Actuals/x.csv")
    files = readers.file_inventory(spark, root, ["team", "scenario"], kinds=[("part", "data")], glob="*.csv")
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]
    assert {(r["team"], r["scenario"], r["kind"]) for r in files.collect()} == {("NA", "Actuals", "data")}


def test_later_runs_replace_from_their_moment_on(spark, root):
    def feed(values):
        return spark.createDataFrame([(date(2022, m, 1), v) for m, v in values], "ref_date date, v int")

    writers.append_run(feed([(1, 10), (2, 20), (3, 30)]), root, "r1", date(2022, 1, 1), "ref_date")
    writers.append_run(feed([(2, 21)]), root, "r2", date(2022, 2, 1), "ref_date")
    writers.append_run(feed([(2, 22)]), root, "r2", date(2022, 2, 1), "ref_date")
    out = readers.read_history(spark, root, "ref_date")
    assert sorted((r["ref_date"].month, r["v"], r["run"]) for r in out.collect()) == [(1, 10, "r1"), (2, 22, "r2")]


def test_audit_flags_files_without_the_column(spark, root):
    writers.write_delimited(spark.createDataFrame([(1, 2)], "Team int, Q1 int"), f"{root}/good")
    writers.write_delimited(spark.createDataFrame([(1, 2)], "Q1 int, Q2 int"), f"{root}/bad")
    out = {r["columns"]: r["lacks_required"] for r in readers.schema_audit(spark, root, "team").collect()}
    assert out == {"team,q1": False, "q1,q2": True}


def test_the_last_write_of_a_run_counts_with_its_moment(spark, root):
    def feed(values):
        return spark.createDataFrame([(date(2022, m, 1), v) for m, v in values], "ref_date date, v int")

    writers.append_run(feed([(1, 10), (2, 20), (3, 30)]), root, "r1", date(2022, 1, 1), "ref_date")
    writers.append_run(feed([(2, 21), (3, 31)]), root, "r2", date(2022, 2, 1), "ref_date")
    writers.append_run(feed([(3, 32)]), root, "r2", date(2022, 3, 1), "ref_date")
    shown = lambda: sorted((r["ref_date"].month, r["v"]) for r in readers.read_history(spark, root, "ref_date").collect())
    assert shown() == [(1, 10), (2, 20), (3, 32)]
    writers.append_run(feed([]), root, "r3", date(2022, 2, 1), "ref_date")
    assert shown() == [(1, 10)]


def test_only_the_top_lines_go_and_quotes_hold_the_separator(spark, root):
    lines = ["Report,,", '"Key, long",Name,"a ""b"""', "a,x,1", "Report,,", '"p,q",,3']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(root)
    out = readers.promote_header(spark, root, row=2)
    assert out.columns == ["key_long", "name", "a_b"]
    assert sorted(tuple(r) for r in out.collect()) == [("Report", None, None), ("a", "x", "1"), ("p,q", None, "3")]


def test_quoted_headers_of_many_files(spark, root):
    for name, lines in {"one": ['"Key, long",Name', '1,"x, y"'], "two": ["Name,Other", "z,2"]}.items():
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/{name}")
    out = readers.read_many(spark, root).drop("file_name")
    assert {tuple(r[c] for c in ("key_long", "name", "other")) for r in out.collect()} == {("1", "x, y", None), (None, "z", "2")}
    audit = {r["columns"]: (r["n_columns"], r["n_lines"]) for r in readers.schema_audit(spark, root, "name").collect()}
    assert audit == {"key, long,name": (2, 1), "name,other": (2, 1)}


def test_long_run_codes(spark):
    names = ["P_20220301_9999999999.csv", "P_20220301_2147483648.csv", "P_20220301_000010.csv"]
    files = spark.createDataFrame([(f"in/{n}", n) for n in names], "path string, file string")
    assert readers.newest_source(files, r"_(\d{8})_", r"_(\d+)\.").first()["file"] == names[0]


def feed_of(spark):
    return lambda values: spark.createDataFrame([(date(2022, m, 1), v) for m, v in values], "ref_date date, v int")


def files_read(spark, root):
    """The Parquet files of the writes that count."""
    live = {r["write"] for r in readers.live_runs(spark, root)}
    files = spark.read.parquet(f"{root}/data").select("write", F.col("_metadata.file_path").alias("f")).distinct().collect()
    return {r["f"] for r in files if r["write"] in live}


def test_a_folded_history_reads_the_same(spark, root):
    feed = feed_of(spark)
    writers.fold_runs(spark, root, "ref_date")
    for k in range(6):
        writers.append_run(feed([(m, 10 * k + m) for m in range(1 + k, 9)]), root, f"r{k}", date(2022, 1 + k, 1), "ref_date")
    writers.append_run(feed([(7, 77)]), root, "r5", date(2022, 7, 1), "ref_date")
    shown = lambda: sorted((r["ref_date"].month, r["v"], r["run"]) for r in readers.read_history(spark, root, "ref_date").collect())
    before, files = shown(), files_read(spark, root)
    writers.fold_runs(spark, root, "ref_date")
    assert shown() == before
    assert len(files_read(spark, root)) < len(files) and not files & files_read(spark, root)
    plan = readers.read_history(spark, root, "ref_date")._jdf.queryExecution().executedPlan().toString()
    assert all("write" in line.split("PartitionFilters:")[1] for line in plan.splitlines() if "PartitionFilters" in line)
    # Later runs replace parts of the base as they would have replaced parts of the runs.
    writers.append_run(feed([(4, 400)]), root, "r6", date(2022, 4, 1), "ref_date")
    assert shown() == [x for x in before if x[0] < 4] + [(4, 400, "r6")]
    writers.append_run(feed([(8, 800)]), root, "r6", date(2022, 8, 1), "ref_date")
    assert shown() == sorted([x for x in before if x[0] < 8] + [(8, 800, "r6")])
    again = shown()
    writers.fold_runs(spark, root, "ref_date")
    assert shown() == again and len(readers.live_runs(spark, root)) == 1
    with pytest.raises(ValueError):
        writers.append_run(feed([(1, 1)]), root, "r3", date(2022, 1, 1), "ref_date")


def test_a_base_is_seen_only_once_it_is_published(spark, root, monkeypatch):
    feed = feed_of(spark)
    for k in range(3):
        writers.append_run(feed([(1 + k, k)]), root, f"r{k}", date(2022, 1 + k, 1), "ref_date")
    shown = lambda: sorted((r["ref_date"].month, r["v"], r["run"]) for r in readers.read_history(spark, root, "ref_date").collect())
    before = shown()
    monkeypatch.setattr(type(spark), "range", lambda *a, **b: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        writers.fold_runs(spark, root, "ref_date")
    monkeypatch.undo()
    assert shown() == before and len(readers.live_runs(spark, root)) == 3
    writers.fold_runs(spark, root, "ref_date")
    assert shown() == before


@pytest.mark.parametrize("split", ["64", "1m"])
def test_headers_under_any_split_size(spark, root, split):
    bodies = {"one": ["Key,Long Name"] + [f"{k},name of {k}" for k in range(60)], "two": ["Other,Key"] + [f"o{k},{k}" for k in range(60)]}
    for name, lines in bodies.items():
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{root}/{name}")
    spark.createDataFrame([(x,) for x in ["Report,,", "Key,Name", *(f"{k},n" for k in range(90)), "Report,,"]], "value string").coalesce(1).write.text(f"{root}-top")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = {tuple(r[c] for c in ("key", "long_name", "other")) for r in readers.read_many(spark, root).collect()}
        body = readers.promote_header(spark, f"{root}-top", row=2)
        # The rows were fixed with the header: what the session is set to when they are read doesn't matter.
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1m" if split == "64" else "64")
        kept = sorted(tuple(r) for r in body.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows == {(str(k), f"name of {k}", None) for k in range(60)} | {(str(k), None, f"o{k}") for k in range(60)}
    assert kept == sorted([("Report", None), *((str(k), "n") for k in range(90))])


def test_types_fold_over_groups(spark):
    rows = [("a", "1", "2020-01-31", "007", "1.5", None), ("a", "-20", "2020-02-29", "8", "2", None), ("b", "3.25", "2021-02-29", "9", "x", None), ("b", None, None, "", "12345678901234567890123", None), ("c", "4", "2020-01-01", "1", "-0.5", None)]
    df = spark.createDataFrame(rows, "g string, n string, d string, c string, m string, e string")
    names = ["n", "d", "c", "m", "e"]
    kinds = readers.column_kinds(df, names, ["g"])
    per = {(r["g"], r["column"]): r["type"] for r in readers.column_types(kinds, names, ["g"]).collect()}
    assert [per["a", c] for c in names] == ["bigint", "date", "string", "decimal", "void"]
    assert [per["b", c] for c in names] == ["decimal", "string", "string", "string", "void"]
    assert [per["c", c] for c in names] == ["bigint", "date", "bigint", "decimal", "void"]
    assert {r["column"]: r["type"] for r in readers.column_types(kinds, names).collect()} == {"n": "decimal", "d": "string", "c": "string", "m": "string", "e": "void"}
    ab = readers.typed(df.filter("g != 'b'"))
    assert dict(ab.dtypes) == {"g": "string", "n": "bigint", "d": "date", "c": "string", "m": "decimal(37,18)", "e": "string"}
    assert sorted(r["n"] for r in ab.collect()) == [-20, 1, 4]
    assert dict(readers.typed(df.limit(0)).dtypes)["n"] == "string"
