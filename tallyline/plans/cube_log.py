"""A profit-and-loss cube kept as additive deltas, one per refresh, and its statement re-derived month by month.

A refresh writes the sums of its lines by dimensions, account, scenario and month, and nothing written before is
changed: the cube is the sum of the deltas. The statement is kept by month as well. After a refresh only the months it
touched and those that look back at them, up to LOOKBACK years later, are derived anew, and of the deltas only these
months and the ones they look back at are read: months are folders, named in the filter.

A refresh becomes visible by its line under `runs`, written last; what a refresh that broke off left behind is never read.
A run that is written again replaces its earlier delta, and the months of both are derived anew. Readers take, for each
month, the newest published statement. The lists that pass the driver have one entry for each refresh and month.

Lines without a month form a month of their own, as in the statement of the whole book.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.plans.pnl import DIMS, PRIOR, VARIANCES, Accounts, labelled, post, report_lines, variances

LOOKBACK = len(PRIOR)
NO_MONTH = "none"
RUNS = "run string, write string, touched array<string>, derived array<string>"


def month_key(day: str) -> Column:
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(NO_MONTH))


def moved(month: str, years: int) -> str:
    """The same month some years on."""
    return month if month == NO_MONTH else f"{int(month[:4]) + years:04d}{month[4:]}"


def schema_of(folder: str, dims: Sequence[str]) -> str:
    """Columns of the deltas or of the report; declared, so that a cube without rows can be read."""
    shared = [*(f"`{d}` string" for d in dims), "ref_date date", "account string"]
    compared = [c for other, name in VARIANCES for c in (other, f"{name}_usd", f"{name}_perc")]
    cells = ["scenario string", "result double"] if folder == "deltas" else [f"{c} double" for c in ("actual", *compared)]
    return ", ".join([*shared, *cells, "month string", "write string"])


def create(spark: SparkSession, path: str, dims: Sequence[str] = DIMS) -> None:
    """An empty cube."""
    root = path.rstrip("/")
    for folder in ("deltas", "report"):
        spark.createDataFrame([], schema_of(folder, dims)).write.partitionBy("month", "write").parquet(f"{root}/{folder}")
    spark.createDataFrame([], RUNS).write.parquet(f"{root}/runs")


def stored(spark: SparkSession, path: str, folder: str, dims: Sequence[str]) -> DataFrame:
    return spark.read.schema(schema_of(folder, dims)).parquet(f"{path.rstrip('/')}/{folder}")


def published(spark: SparkSession, path: str) -> list:
    """The lines about published refreshes in the order in which they were written."""
    return sorted(spark.read.schema(RUNS).parquet(f"{path.rstrip('/')}/runs").collect(), key=lambda r: r["write"])


def deltas(spark: SparkSession, path: str, writes: Iterable[str], months: Iterable[str] | None = None, dims: Sequence[str] = DIMS) -> DataFrame:
    """The deltas of some refreshes; only the folders of the named months are read."""
    rows = stored(spark, path, "deltas", dims).filter(F.col("write").isin(sorted(writes)))
    return rows if months is None else rows.filter(F.col("month").isin(sorted(months)))


def derived(spark: SparkSession, path: str, writes: Iterable[str], months: Sequence[str], dims: Sequence[str] = DIMS, accounts: Accounts = Accounts()) -> DataFrame:
    """The statement of some months out of the deltas of some refreshes."""
    needed = {moved(m, -k) for m in months for k in range(LOOKBACK + 1)}
    cube = post(deltas(spark, path, writes, needed, dims), dims)
    report = variances(report_lines(cube, dims, accounts), dims)
    return report.withColumn("month", month_key("ref_date")).filter(F.col("month").isin(sorted(months)))


def append(lines: DataFrame, path: str, run: str, dims: Sequence[str] = DIMS, accounts: Accounts = Accounts()) -> dict:
    """Add a refresh, or write one again, and derive the months concerned; returns the line published about it."""
    spark, root = lines.sparkSession, path.rstrip("/")
    write = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    earlier = {r["run"]: r for r in published(spark, path)}
    replaced = earlier.pop(run, None)

    def store(rows: DataFrame, folder: str) -> None:
        placed = rows.withColumn("write", F.lit(write))
        # Dealt by the whole row, month first: few files for a month, and none too large.
        placed.select([f.name for f in stored(spark, path, folder, dims).schema]).repartitionByRange("month", *dims, "account").write.mode("append").partitionBy("month", "write").parquet(f"{root}/{folder}")

    summed = lines.groupBy(*dims, "account", "scenario", "ref_date").agg(F.sum("result").alias("result"))
    store(summed.withColumn("month", month_key("ref_date")), "deltas")
    touched = {r["month"] for r in deltas(spark, path, [write], dims=dims).select("month").distinct().collect()}
    concerned = touched | set(replaced["touched"] if replaced else ())
    known = touched.union(*(r["touched"] for r in earlier.values())) | concerned
    months = sorted({moved(m, k) for m in concerned for k in range(LOOKBACK + 1)} & known)
    if months:
        live = [*(r["write"] for r in earlier.values()), write]
        store(derived(spark, path, live, months, dims, accounts), "report")
    line = {"run": run, "write": write, "touched": sorted(touched), "derived": months}
    spark.createDataFrame([line], RUNS).coalesce(1).write.mode("append").parquet(f"{root}/runs")
    return line


def statement(spark: SparkSession, path: str, months: Iterable[str] | None = None, dims: Sequence[str] = DIMS) -> DataFrame:
    """The statement as last derived, of all months or of some ('1999-03')."""
    newest = {m: r["write"] for r in published(spark, path) for m in r["derived"]}
    if months is not None:
        newest = {m: w for m, w in newest.items() if m in set(months)}
    found = stored(spark, path, "report", dims)
    wanted = F.concat_ws("/", "month", "write").isin([f"{m}/{w}" for m, w in newest.items()])
    # Month and write are named by themselves too: folders are pruned by either.
    kept = found.filter(F.col("month").isin(sorted(newest)) & F.col("write").isin(sorted(set(newest.values()))) & wanted)
    return labelled(kept.drop("month", "write"))
