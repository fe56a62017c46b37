"""Month, quarter, fiscal-year and serial-date expressions."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.nulls import ColumnOrName, as_col

# English month names in calendar order.
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
MONTH_ABBREVIATIONS = [name[:3] for name in MONTH_NAMES]

# '01-01' to '12-31', the 29th of February with them.
DAYS_OF_A_YEAR = [f"{date(2000, 1, 1) + timedelta(k):%m-%d}" for k in range(366)]

# Day zero of the two spreadsheet serial-date conventions.
SPREADSHEET_ORIGIN = "1899-12-30"
LATE_ORIGIN = "1899-12-31"


def from_serial(serial: ColumnOrName, origin: str = SPREADSHEET_ORIGIN) -> Column:
    """Date for a spreadsheet serial number; fractions of a day are dropped."""
    return F.date_add(F.lit(origin).cast("date"), as_col(serial).try_cast("double").try_cast("int"))


def month_start(day: ColumnOrName) -> Column:
    return F.trunc(as_col(day).cast("date"), "MM")


def month_label(day: ColumnOrName) -> Column:
    return F.date_format(as_col(day), "MMM yyyy")


def month_of(year: ColumnOrName, month: ColumnOrName) -> Column:
    """First day of a month; NULL when year or month is missing, no number or no month."""
    number = as_col(month).try_cast("int")
    return F.when(number.between(1, 12), F.make_date(as_col(year).try_cast("int"), number, F.lit(1)))


def quarter_label(day: ColumnOrName) -> Column:
    return F.concat(F.lit("Q"), F.quarter(as_col(day)).cast("string"))


def month_number(name: ColumnOrName, names: list[str] = MONTH_NAMES) -> Column:
    """Calendar number of a month name; NULL for any other text."""
    listed = F.array(*[F.lit(n) for n in names])
    return F.nullif(F.array_position(listed, as_col(name)).cast("int"), F.lit(0))


def month_name(number: ColumnOrName, names: list[str] = MONTH_NAMES) -> Column:
    listed = F.array(*[F.lit(n) for n in names])
    return F.get(listed, as_col(number).cast("int") - 1)


def fiscal_label(year: ColumnOrName, back: ColumnOrName | int = 0) -> Column:
    """'FY21' for 2021, shifted back by whole years."""
    back = F.lit(back) if isinstance(back, int) else as_col(back)
    return F.concat(F.lit("FY"), F.substring((as_col(year).cast("int") - back).cast("string"), 3, 2))


def closed_month(as_of: date, back: int = 1) -> date:
    """First day of the month that lies a number of months before a date."""
    months = as_of.year * 12 + as_of.month - 1 - back
    return date(months // 12, months % 12 + 1, 1)


def calendar(spark: SparkSession, first: str, last: str, business_days_only: bool = False) -> DataFrame:
    """One row per day between two dates, both inclusive.

    The row count is fixed by the parameters (366 a year at most), so the table is safe to broadcast.
    day_code is the day number in the year, written 'd1'..'d366'; week is counted in the month.
    """
    day = F.col("data_date")
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("data_date")
    )
    if business_days_only:
        days = days.filter(F.weekday(day) < 5)
    return days.select(
        day,
        F.concat(F.lit("d"), F.dayofyear(day).cast("string")).alias("day_code"),
        F.dayofmonth(day).alias("day"),
        F.concat(F.lit("Week "), (F.floor((F.dayofmonth(day) - 1) / 7) + 1).cast("string")).alias("week"),
        F.date_format(day, "MMM").alias("month"),
        quarter_label(day).alias("quarter"),
    )


def calendar_of(df: DataFrame, date: str, business_days_only: bool = False) -> DataFrame:
    """Calendar from the first to the last date of a table; one row of bounds is read first."""
    first, last = df.agg(F.min(F.col(date).cast("date")).cast("string"), F.max(F.col(date).cast("date")).cast("string")).first()
    if first is None:
        return calendar(df.sparkSession, "2000-01-01", "2000-01-01", business_days_only).filter(F.lit(False))
    return calendar(df.sparkSession, first, last, business_days_only)


def close_ranges(days: DataFrame) -> DataFrame:
    """First and last day of every month of a calendar."""
    return (
        days.groupBy(F.year("data_date").alias("year"), F.col("month"))
        .agg(F.min("data_date").alias("first_day"), F.max("data_date").alias("last_day"))
    )


def close_window(ranges: DataFrame, start: str, end: str, open_days: int = 3) -> DataFrame:
    """Booking window of a close: it stays open for some days after the period end."""
    return ranges.withColumn("booking_end", F.date_add(F.col(end), open_days)).withColumnRenamed(start, "period_start").withColumnRenamed(end, "period_end")


def free_text_day(text: ColumnOrName) -> tuple[Column, Column]:
    """Month abbreviation and day number out of text such as 'Week Of September 12th'."""
    text = as_col(text)
    alternatives = "|".join(MONTH_ABBREVIATIONS)
    pattern = rf"\b({alternatives})[a-z]*\s+(\d{{1,2}})"
    return (
        F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1)),
        F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 2).cast("int")),
    )
