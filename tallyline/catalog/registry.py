"""Registration of queries and composition of the oracle SQL from named views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


# Declared schemas of the given tables: no job is spent on inferring them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class Tables:
    """The parquet tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str, ranges: dict[str, tuple[str, str | None, str]] | None = None):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._ranges = ranges or {}

    def shipped(self, first: str | None, before: str) -> Tables:
        """The same tables with the lines of a date range only; the range reaches the parquet scan."""
        return Tables(self.spark, self.folder, {**self._ranges, "lineitem": ("l_shipdate", first, before)})

    def ordered(self, first: str, before: str) -> Tables:
        """The same tables with the orders of a date range only."""
        return Tables(self.spark, self.folder, {**self._ranges, "orders": ("o_orderdate", first, before)})

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        table = self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")
        if name in self._ranges:
            column, first, before = self._ranges[name]
            if first is not None:
                table = table.filter(F.col(column) >= F.lit(first).cast("timestamp_ntz"))
            table = table.filter(F.col(column) < F.lit(before).cast("timestamp_ntz"))
        return table


def query(name: str, sql: str | None = None):
    """Register a plan under a name, with its equivalent SQL where SQL can express it."""

    def register(plan: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plan(Tables(spark, folder))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return plan

    return register


def cents(value: Column | str, name: str | None = None) -> Column:
    """Round money at the report edge."""
    out = F.round(F.col(value) if isinstance(value, str) else value, 2)
    return out.alias(name or value) if (name or isinstance(value, str)) else out


def fine(value: Column | str, name: str | None = None, digits: int = 9) -> Column:
    """Round a ratio or a rate."""
    out = F.round(F.col(value) if isinstance(value, str) else value, digits)
    return out.alias(name or value) if (name or isinstance(value, str)) else out


def rounded(df: DataFrame, money=(), shares=()) -> DataFrame:
    cells = {c: cents(F.col(c)) for c in money}
    cells.update({c: fine(F.col(c)) for c in shares})
    return df.withColumns(cells)


def m(expr: str, name: str | None = None) -> str:
    """SQL side of cents()."""
    out = f"(round({expr}, 2) + 0e0)"
    return f"{out} AS {name}" if name else out


def s(expr: str, name: str | None = None, digits: int = 9) -> str:
    """SQL side of fine()."""
    out = f"(round({expr}, {digits}) + 0e0)"
    return f"{out} AS {name}" if name else out


def ms(*names: str, of: str = "") -> str:
    """Several money columns rounded under their own names."""
    return ", ".join(m(f"{of}{n}", n) for n in names)


def ss(*names: str, of: str = "") -> str:
    return ", ".join(s(f"{of}{n}", n) for n in names)
