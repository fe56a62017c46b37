"""Net-sales bridge, ratios in basis points, organic growth and residual lines."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.nulls import basis_points, ratio_or_null, zero
from tallyline.functions.periods import closed_month, month_name, quarter_label
from tallyline.operators.joins import layout
from tallyline.operators.reshape import spread

KEYS = ("ref_date", "product", "region", "region_channel")
# The measures a net-sales extract holds in its type column.
TYPES = (
    "actual_sales", "actual_sales_py", "actual_sales_2py", "actual_fx", "actual_acqdiv", "actual_price", "actual_volume",
    "fcst_sales", "fcst_price", "fcst_volume", "fcst_acqdiv", "actual_fx_vs_fcst", "actual_fx_vs_op",
    "op_sales", "op_price", "op_volume", "op_acqdiv",
)


def relabel_lines(df: DataFrame, by_product: Sequence[tuple[str, str, str]] = (), regions: dict[str, str] | None = None) -> DataFrame:
    """Rename channels for given (product, channel) pairs, then move renamed channels to other regions."""
    channel = F.col("region_channel")
    for product, old, new in by_product:
        channel = F.when((F.col("product") == product) & (F.col("region_channel") == old), new).otherwise(channel)
    out = df.withColumn("region_channel", channel)
    region = F.col("region")
    for name, target in (regions or {}).items():
        region = F.when(F.col("region_channel") == name, target).otherwise(region)
    return out.withColumn("region", region)


def bridge(net_sales: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Sales, price, volume and organic change against prior year, forecast and plan.

    A missing measure leaves the amounts that need it missing.
    """
    known = net_sales.withColumn("result", zero("result"))
    wide = spread(known, list(keys), "type", list(TYPES), "result")

    def change(other: str, fx: str, prefix: str) -> dict[str, Column]:
        sales = F.col("actual_sales") - F.col(f"{prefix}_sales")
        price = F.col("actual_price") - F.col(f"{prefix}_price")
        acquired = F.col("actual_acqdiv") - F.col(f"{prefix}_acqdiv")
        volume = sales - F.col(fx) - price - acquired
        return {
            f"sales_{other}": sales, f"fx_{other}": F.col(fx), f"acqdiv_{other}": acquired,
            f"org_{other}": volume + price, f"vol_{other}": volume, f"price_{other}": price,
        }

    sales = F.col("actual_sales") - F.col("actual_sales_py")
    cells = {
        "sales_vpy": sales, "fx_vpy": F.col("actual_fx"), "acqdiv_vpy": F.col("actual_acqdiv"),
        "org_vpy": sales - F.col("actual_fx") - F.col("actual_acqdiv"), "vol_vpy": F.col("actual_volume"), "price_vpy": F.col("actual_price"),
    }
    cells |= change("vfcst", "actual_fx_vs_fcst", "fcst") | change("vop", "actual_fx_vs_op", "op")
    kept = ["actual_sales", "fcst_sales", "op_sales", "actual_sales_py", "actual_sales_2py", "fcst_price", "op_price", "fcst_volume", "op_volume"]
    return wide.select(*keys, *kept, *[c.alias(n) for n, c in cells.items()])


PARTS = ("sales", "fx", "acqdiv", "org", "vol", "price")


def ratio_table(bridged: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Shares of prior-year sales, and their change against forecast and plan in basis points.

    A change is the difference of two shares that are each rounded to tens of basis points.
    """
    base = F.col("actual_sales_py")
    shares = {p: ratio_or_null(f"{p}_vpy", base) for p in PARTS}
    out = [zero(shares[p]).alias(f"{p}_vpy_ratio") for p in PARTS]
    for other in ("vfcst", "vop"):
        for p in PARTS:
            before = F.col(f"{p}_vpy") - F.col(f"{p}_{other}")
            divisor = base
            if other == "vfcst" and p == "acqdiv":
                # Measured against the forecast itself, unlike its siblings.
                divisor = F.col("fcst_sales")
            if other == "vfcst" and p == "price":
                before = F.col("fcst_price")
            points = basis_points(shares[p]) - basis_points(ratio_or_null(before, divisor))
            out.append(zero(points).alias(f"{p}_{other}_ratio"))
    return bridged.select(*keys, month_name(F.month("ref_date")).alias("period"), quarter_label("ref_date").alias("quarter"), *out)


def year_to_date_kpis(bridged: DataFrame, as_of: date, product: str) -> DataFrame:
    """Ratios of sums over the closed months of a year, per channel."""
    months = F.col("ref_date").between(F.lit(date(as_of.year, 1, 1)), F.lit(as_of))
    summed = bridged.filter(months & (F.col("product") == product)).groupBy("region_channel").agg(
        *[F.sum(c).alias(c) for c in ("sales_vpy", "sales_vfcst", "actual_sales_py")]
    )
    share = ratio_or_null("sales_vpy", "actual_sales_py")
    before = ratio_or_null(F.col("sales_vpy") - F.col("sales_vfcst"), "actual_sales_py")
    return summed.withColumn("sales_vpy_ratio", zero(share)).withColumn("sales_vfcst_ratio", zero(basis_points(share) - basis_points(before)))


ORGANIC = ("sales_actual_mtd", "forecast_mtd", "op_mtd", "sales_py_mtd", "sales_fx_mtd", "sales_acqdiv_mtd")


def organics_summary(rows: DataFrame, as_of: date, lines: DataFrame | None = None) -> DataFrame:
    """Organic sales of the closed months per region and channel with variances.

    With report lines (region_channel, ord) those decide the rows and their order.
    """
    closed = rows.filter(F.col("ref_date") <= F.lit(closed_month(as_of)))
    wide = spread(closed, ["ref_date", "geo", "region", "channel"], "type", list(ORGANIC), "result")
    actual = F.col("sales_actual_mtd")
    summary = wide.select(
        "ref_date", F.year("ref_date").alias("observation"), F.month("ref_date").alias("month"), month_name(F.month("ref_date")).alias("period"),
        quarter_label("ref_date").alias("quarter"), "geo", F.concat_ws(" / ", "region", "channel").alias("region_channel"), *ORGANIC,
        (actual - F.col("forecast_mtd")).alias("mtd_sales_vfcast"),
        (actual - F.col("op_mtd")).alias("mtd_sales_vop"),
        (actual - F.col("sales_py_mtd")).alias("mtd_sales_vpy"),
    )
    return summary if lines is None else layout(lines, summary, ["region_channel"])
