"""Daily sales tracking: aligned measures, month to date, prior year and forecast conversion."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.nulls import ratio_or_null, zero
from tallyline.functions.periods import MONTH_ABBREVIATIONS, month_number, month_of, quarter_label
from tallyline.operators.joins import join_named
from tallyline.operators.reshape import align_measures, fold_measures

DIMS = ("region", "category")


def daily_perspective(long: DataFrame, measures: Sequence[str], keys: Sequence[str], days: DataFrame) -> DataFrame:
    """Daily measures (long rows: keys, measure, value) side by side, with calendar columns found by the day code.

    The rows are those of the first measure; the calendar holds one row per day code.
    """
    aligned = fold_measures(long, keys, measures)
    return join_named(aligned, days.withColumnRenamed("day_code", "calendar_day"), {"day_code": "calendar_day"})


def forecast_perspective(measures: dict[str, DataFrame], keys: Sequence[str], year: str = "year", period: str = "period") -> DataFrame:
    """Monthly forecast measures side by side with month number, first day and quarter."""
    aligned = align_measures(measures, keys)
    number = month_number(period, MONTH_ABBREVIATIONS)
    dated = aligned.withColumn("month_day", number).withColumn("ref_date", month_of(F.col(year), number))
    return dated.withColumn("quarter", quarter_label("ref_date"))


def track(sales: DataFrame, forecast: DataFrame, dims: Sequence[str] = DIMS) -> DataFrame:
    """Every day with its value, the same day of the prior year, both month-to-date sums and the month's targets.

    `sales` has the dims, day, actuals and the expected shares qr, op of the month; `forecast` has the dims,
    year, month, fcast, budget, posted. The prior year is re-dated into the current one, so the running
    sums of both years come out of one window of at most 31 rows, also on days the prior year lacks.
    """
    month_keys = [*dims, "year", "month"]
    per_day = sales.groupBy(*dims, F.year("day").alias("year"), F.month("day").alias("month"), F.dayofmonth("day").alias("day_no")).agg(
        F.sum("actuals").alias("actuals"), F.max("qr").alias("qr"), F.max("op").alias("op")
    )
    copies = per_day.withColumn("back", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("year", F.col("year") + F.col("back"))
    own = F.col("back") == 0
    both = copies.groupBy(*month_keys, "day_no").agg(
        *[F.sum(F.when(own, F.col(c))).alias(c) for c in ("actuals", "qr", "op")],
        F.sum(F.when(~own, F.col("actuals"))).alias("py_actuals"),
        F.max(own).alias("__own"),
    )
    so_far = Window.partitionBy(*month_keys).orderBy("day_no").rangeBetween(Window.unboundedPreceding, 0)
    running = both.withColumns({"mtd_actuals": F.sum("actuals").over(so_far), "py_mtd_actuals": F.sum("py_actuals").over(so_far)})
    posted = forecast.select(*dims, (F.col("year") + 1).alias("year"), "month", F.col("posted").alias("py_posted"))
    targets = forecast.select(*month_keys, "fcast", "budget")
    return running.filter("__own").drop("__own").join(targets, month_keys, "left").join(posted, month_keys, "left")


def derive(tracked: DataFrame, dims: Sequence[str] = DIMS, unit: float = 1.0) -> DataFrame:
    """Variances, shares, conversion and gaps; undefined values become 0 at the end.

    `unit` is the number of sales units in one forecast unit.
    """
    mtd, py_mtd = F.col("mtd_actuals"), F.col("py_mtd_actuals")
    qr, op = F.col("qr") * F.col("fcast") * unit, F.col("op") * F.col("budget") * unit
    cells = {
        "actuals": F.col("actuals"), "py_actuals": F.col("py_actuals"), "d_vpy": ratio_or_null("actuals", "py_actuals") - 1,
        "mtd_actuals": mtd, "qr": qr, "vqr_usd": mtd - qr, "vqr_share": ratio_or_null(mtd - qr, qr),
        "op": op, "vop_usd": mtd - op, "vop_share": ratio_or_null(mtd - op, op),
        "py_mtd_actuals": py_mtd, "vpy_usd": mtd - py_mtd, "vpy_share": ratio_or_null(mtd - py_mtd, py_mtd),
        "fcast": F.col("fcast"), "qr_converted": ratio_or_null(mtd, "fcast"), "qr_gap": F.col("fcast") - mtd,
        "budget": F.col("budget"), "op_converted": ratio_or_null(mtd, "budget"), "op_gap": F.col("budget") - mtd,
        "py_posted": F.col("py_posted"), "py_converted": ratio_or_null(mtd, "py_posted"), "py_gap": F.col("py_posted") - mtd,
    }
    return tracked.select(*dims, "year", "month", "day_no", *[zero(c).alias(n) for n, c in cells.items()])


def track_day(sales: DataFrame, forecast: DataFrame, day: date, dims: Sequence[str] = DIMS) -> DataFrame:
    """Tracking of one day. Only the month to date of the year and of the year before are read."""
    before = date(day.year - 1, day.month, 1)
    # The same month of the prior year ends before the day number passes the one asked for.
    this_month = F.col("day").between(F.lit(date(day.year, day.month, 1)), F.lit(day))
    last_year = (F.col("day") >= F.lit(before)) & (F.col("day") < F.add_months(F.lit(before), 1)) & (F.dayofmonth("day") <= day.day)
    tracked = track(sales.filter(this_month | last_year), forecast, dims)
    return tracked.filter((F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day_no") == day.day))
