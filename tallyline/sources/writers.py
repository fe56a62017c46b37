"""Writers for snapshots, reports and run logs. No writer touches a path that is being read."""

from __future__ import annotations

import time
import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.sources.readers import live_runs, read_history, run_lines


def save_snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_delimited(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").csv(path, sep=sep, header=True)


def write_report(tables: dict[str, DataFrame], root: str) -> list[str]:
    """One folder per named table, replacing what is there."""
    paths = []
    for name, table in tables.items():
        paths.append(f"{root.rstrip('/')}/{name}")
        table.write.mode("overwrite").parquet(paths[-1])
    return paths


def append_run(rows: DataFrame, path: str, run: str, moment: date, day: str) -> None:
    """Add one refresh to a run log: rows under `data`, by day and write, and a line about the run under `runs`.

    The rows replace all earlier rows from `moment` on when the log is read, also if there are none; nothing written
    before is rewritten. Of several writes of a run the last one counts, with its moment. A run that was folded into a
    base, or comes before one that was, is an error.
    """
    folded = [r["run"] for r in run_lines(rows.sparkSession, path) if r["base"]]
    if folded and run <= max(folded):
        raise ValueError(f"run {run} was folded into a base")
    write = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    stamped = rows.withColumns({"run": F.lit(run), "write": F.lit(write), "__day": F.col(day)})
    stamped.write.mode("append").partitionBy("__day", "write").parquet(f"{path.rstrip('/')}/data")
    line = rows.sparkSession.range(1).select(F.lit(run).alias("run"), F.lit(moment).alias("moment"), F.lit(write).alias("write"), F.lit(False).alias("base"))
    line.write.mode("append").parquet(f"{path.rstrip('/')}/runs")


def fold_runs(spark: SparkSession, path: str, date: str) -> None:
    """Write what a run log shows as one base, which stands for all runs so far.

    The base becomes visible by its line under `runs`, written after its rows: a reader sees the runs or the base, never
    half of it. Nothing is deleted; readers that hold the older lines go on with them, later ones read the base and what
    was appended since. A run that was folded can't be written again.
    """
    root, live = path.rstrip("/"), live_runs(spark, path)
    if not live:
        return
    write = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    shown = read_history(spark, path, date).withColumns({"write": F.lit(write), "__day": F.col(date)})
    # Few files for a day, and none too large.
    shown.repartitionByRange("__day", F.monotonically_increasing_id()).write.mode("append").partitionBy("__day", "write").parquet(f"{root}/data")
    newest = max(r["run"] for r in live)
    line = spark.range(1).select(F.lit(newest).alias("run"), F.lit(None).cast("date").alias("moment"), F.lit(write).alias("write"), F.lit(True).alias("base"))
    line.write.mode("append").parquet(f"{root}/runs")


def stamp_run(rows: DataFrame, exec_day: date, at: datetime) -> DataFrame:
    """Execution day and timestamp of a refresh, as parameters of the run."""
    return rows.withColumn("exec_day", F.lit(exec_day)).withColumn("timestamp", F.lit(at.isoformat(sep=" ")))
