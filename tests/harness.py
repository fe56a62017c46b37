"""Side-by-side run of the registered queries on Spark and DuckDB.

    python -m tests.harness [--dir FOLDER] [--time] [name-part ...]
"""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def ordered(names, rows):
    spots = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(r[i]) for i in spots) for r in rows]
    return [names[i] for i in spots], sorted(out, key=repr)


def spark_result(df):
    return ordered(df.columns, [tuple(r) for r in df.collect()])


def duck_result(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return ordered(names, cursor.fetchall())


def compare(spark, con, folder, name, queries, oracles):
    """None when equal, else a text that tells the first difference."""
    columns, rows = spark_result(queries[name](spark, folder))
    if name not in oracles:
        return None
    names, expected = duck_result(con, oracles[name])
    if columns != names:
        return f"columns differ: spark {columns} sql {names}"
    if len(rows) != len(expected):
        extra = [r for r in rows if r not in set(expected)][:2]
        lost = [r for r in expected if r not in set(rows)][:2]
        return f"row count differs: spark {len(rows)} sql {len(expected)}\n  only spark {extra}\n  only sql {lost}"
    for got, want in zip(rows, expected, strict=True):
        if got != want:
            cells = [(c, g, w) for c, g, w in zip(columns, got, want, strict=True) if g != w]
            return f"values differ ({sum(a != b for a, b in zip(rows, expected, strict=True))} of {len(rows)} rows): {cells[:4]} in {got}"
    return None


def main(argv):
    from tallyline.catalog import ORACLES, QUERIES
    from tallyline.session import build_session

    folder = "/root/testdata/sf0.01"
    timed = False
    parts = []
    while argv:
        word = argv.pop(0)
        if word == "--dir":
            folder = argv.pop(0)
        elif word == "--time":
            timed = True
        else:
            parts.append(word)
    spark = build_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    names = [n for n in QUERIES if not parts or any(n.startswith(p) or p in n for p in parts)]
    failed = 0
    for name in names:
        begin = time.time()
        try:
            problem = compare(spark, con, folder, name, QUERIES, ORACLES)
        except Exception as error:  # noqa: BLE001 - the report goes on with the next query
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        if problem:
            failed += 1
            print(f"FAIL {name}: {problem}")
        elif timed:
            print(f"ok   {name} {time.time() - begin:.1f}s")
    print(f"{len(names) - failed} of {len(names)} agree; {sum(n in ORACLES for n in names)} with SQL")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
