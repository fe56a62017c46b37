"""Readers for landed tables, delimited files, many-file unions and file inventories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.text import piece
from tallyline.operators.columns import clean_headers
from tallyline.operators.rules import Rules, categorise
from tallyline.session import written


def read_delimited(spark: SparkSession, path, schema: str, sep: str = ",") -> DataFrame:
    """Delimited file with a header. Only an empty cell is missing, so the text 'NA' survives."""
    return spark.read.csv(path, sep=sep, header=True, schema=schema, nullValue="", enforceSchema=False)


def read_table(spark: SparkSession, root: str, table: str, schema: str | None = None) -> DataFrame:
    """One landed table of a folder, the counterpart of a named sheet."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root.rstrip('/')}/{table}")


def file_inventory(spark: SparkSession, root: str, parts: Sequence[str], kinds: Rules = (), glob: str = "*") -> DataFrame:
    """Files below a folder: path, name, size, time and the path parts below the folder by name.

    Only file metadata is read; the content column is pruned.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
        .select("path", "modificationTime", "length")
    )
    relative = F.regexp_replace("path", r"^.*?" + _quoted(root.rstrip("/").split("/")[-1]) + "/", "")
    listed = files.withColumn("__relative", relative).withColumns(
        {name: piece("__relative", "/", i) for i, name in enumerate(parts)}
    ).withColumn("file", F.regexp_extract("path", "[^/]+$", 0))
    if kinds:
        listed = listed.withColumn("kind", categorise("file", kinds))
    return listed.drop("__relative")


def _quoted(text: str) -> str:
    return "\\Q" + text + "\\E"


def newest_source(files: DataFrame, date_pattern: str, code_pattern: str) -> DataFrame:
    """The file with the newest embedded date and, among those, the highest run code; one row. Codes are whole numbers of any length."""
    stamped = files.withColumn("stamp", F.regexp_extract("file", date_pattern, 1).try_cast("int")).withColumn(
        "code", F.regexp_extract("file", code_pattern, 1).try_cast("decimal(38,0)")
    )
    known = stamped.filter(F.col("stamp").isNotNull() & F.col("code").isNotNull())
    return known.agg(F.max_by(F.struct("path", "file", "stamp", "code"), F.struct("stamp", "code")).alias("f")).select("f.*")


def cells_of(line: Column, sep: str = ",") -> Column:
    """The cells of a delimited line; a quoted cell may hold the separator, and a doubled quote is one quote. Lines end a cell."""
    mark = _quoted(sep)
    quoted = f'{mark}("(?:[^"]|"")*"|(?:(?!{mark}).)*)'
    raw = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(quoted), 1)
    return F.transform(raw, lambda c: F.when(c.rlike('^".*"$'), F.replace(c.substr(F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))


def _lines(spark: SparkSession, paths) -> DataFrame:
    """file, start of the block, place of the line in this scan, value. Another scan may cut the files elsewhere and give other places."""
    return spark.read.option("recursiveFileLookup", "true").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), "value")


def placed_lines(spark: SparkSession, paths) -> DataFrame:
    """The lines of one scan, written once: whatever is asked of them later, and however the files would be cut by then, a line keeps its place."""
    return written(_lines(spark, paths), "lines")


def header_lines(lines: DataFrame) -> DataFrame:
    """First line of every text file and its place: file, header, at."""
    return lines.filter(F.col("start") == 0).groupBy("file").agg(F.min_by("value", "at").alias("header"), F.min("at").alias("at"))


def _typed(cells: Column, names: Sequence[str]) -> list[Column]:
    """Named text columns out of an array of cells; an empty or absent cell is missing."""
    return [F.nullif(F.get(cells, F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(names)]


def read_many(spark: SparkSession, paths, sep: str = ",") -> DataFrame:
    """Files with differing columns as one table that keeps the file name; a column a file lacks is NULL.

    Only the distinct layouts travel to the driver, whatever the number of files. The files are scanned once; headers and
    rows come from the written lines. All cells are text; a cell doesn't span lines.
    """
    scanned = placed_lines(spark, paths)
    headers = header_lines(scanned).select(F.col("file").alias("__file"), "header", F.col("at").alias("__first"))
    layouts = {r["header"]: clean_headers(r["cells"]) for r in headers.select("header").distinct().select("header", cells_of(F.col("header"), sep).alias("cells")).collect()}
    names = list(dict.fromkeys(n for header in sorted(layouts) for n in layouts[header]))
    if not names:
        raise ValueError("no file has a header")
    of_layout = F.create_map(*[c for header, own in layouts.items() for c in (F.lit(header), F.array(*[F.lit(n) for n in own]))])
    lines = scanned.join(headers, F.col("file") == F.col("__file")).filter((F.col("at") != F.col("__first")) & (F.col("value") != ""))
    parsed = lines.select("file", F.map_from_arrays(of_layout[F.col("header")], F.transform(
        F.sequence(F.lit(0), F.size(of_layout[F.col("header")]) - 1), lambda i: F.get(cells_of(F.col("value"), sep), i))).alias("row"))
    return parsed.select(*[F.nullif(F.col("row")[n], F.lit("")).alias(n) for n in names], F.regexp_extract("file", "[^/]+$", 0).alias("file_name"))


def promote_header(spark: SparkSession, path: str, row: int = 1, sep: str = ",", header_path: str | None = None) -> DataFrame:
    """Delimited file whose header stands in a given line (from 1); the lines up to it are dropped, by their place.

    A table split over several files names the file with the top lines as header_path, and no line of it is dropped
    but those. Only the first lines travel to the driver. The top lines and the rows come from one written scan, so the
    lines that go are the ones that were read as the top. A cell doesn't span lines.
    """
    scanned = _lines(spark, path) if header_path else placed_lines(spark, path)
    top = (_lines(spark, header_path) if header_path else scanned).filter(F.col("start") == 0).orderBy("at").limit(row).withColumn("cells", cells_of(F.col("value"), sep)).collect()
    top.sort(key=lambda r: r["at"])
    names = clean_headers(top[row - 1]["cells"])
    body = scanned
    if header_path is None:
        body = body.filter(~F.col("at").isin([r["at"] for r in top]))
    return body.filter(F.col("value") != "").select(*_typed(cells_of(F.col("value"), sep), names))


# Kinds of text cells as bits, so that those of many cells and files are folded by OR.
WHOLE, DECIMAL, DATE, OTHER = 1, 2, 4, 8


def cell_kind(cell: Column) -> Column:
    """The bit of a cell's kind; NULL for a missing one. Digits after a leading zero are a code, not a number."""
    return (
        F.when(cell.rlike(r"^[+-]?(0|[1-9]\d{0,17})$"), WHOLE).when(cell.rlike(r"^[+-]?(0|[1-9]\d{0,18})(\.\d{1,18})?$"), DECIMAL)
        .when(cell.rlike(r"^\d{4}-\d{2}-\d{2}$") & cell.try_cast("date").isNotNull(), DATE).when(cell.isNotNull(), OTHER))


def kind_name(kinds: Column) -> Column:
    """The narrowest type that holds all kinds of a fold: whole numbers are decimals as well, everything is text."""
    return (
        F.when(kinds == 0, "void").when(kinds == WHOLE, "bigint").when(kinds.bitwiseAND(DATE | OTHER) == 0, "decimal")
        .when(kinds == DATE, "date").otherwise("string"))


def column_kinds(df: DataFrame, columns: Sequence[str], per: Sequence[str] = ()) -> DataFrame:
    """The kinds of every text column, one row per group (or one in all): the groups' columns, then one column of bits for each.

    Kinds of groups fold to those of the whole by OR: the rows of one pass over all files answer for any union of them.
    """
    return df.groupBy(*per).agg(*[F.coalesce(F.bit_or(cell_kind(F.col(f"`{c}`"))), F.lit(0)).alias(c) for c in columns])


def column_types(kinds: DataFrame, columns: Sequence[str], per: Sequence[str] = ()) -> DataFrame:
    """Kinds as rows: the groups' columns, column, type."""
    long = kinds.unpivot(list(per), list(columns), "column", "__kinds")
    return long.groupBy(*per, "column").agg(kind_name(F.bit_or("__kinds")).alias("type"))


def typed(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Text columns as the narrowest type that holds all their cells: bigint, decimal(37,18), date or text.

    One pass finds the types; one row travels to the driver. A column without any cell stays text.
    """
    columns = list(columns or [c for c, kind in df.dtypes if kind == "string"])
    found = {r["column"]: r["type"] for r in column_types(column_kinds(df, columns), columns).collect()}
    kinds = {"bigint": "bigint", "decimal": "decimal(37,18)", "date": "date"}
    return df.withColumns({c: F.col(f"`{c}`").cast(kinds[found[c]]) for c in columns if found[c] in kinds})


def schema_audit(spark: SparkSession, paths, required: str, sep: str = ",") -> DataFrame:
    """Columns of every file as text, whether a required column is missing, and the number of data lines."""
    lines = _lines(spark, paths)
    # One pass: the line at the smallest place of a file's first block is its header.
    first = F.when(F.col("start") == 0, F.col("at"))
    headers = lines.groupBy("file").agg(F.min_by("value", first).alias("header"), (F.count(F.lit(1)) - 1).alias("n_lines"))
    columns = F.transform(cells_of(F.col("header"), sep), lambda c: F.lower(F.trim(c)))
    return headers.select(
        F.regexp_extract("file", "[^/]+$", 0).alias("file"), F.array_join(columns, ",").alias("columns"), F.size(columns).alias("n_columns"),
        (~F.array_contains(columns, required)).alias("lacks_required"), "n_lines",
    )


RUN_LINE = "run string, moment date, write string, base boolean"


def run_lines(spark: SparkSession, path: str) -> list:
    """The lines about runs and bases, one for each write; none where no run was written."""
    try:
        return spark.read.schema(RUN_LINE).parquet(f"{path.rstrip('/')}/runs").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def live_runs(spark: SparkSession, path: str) -> list:
    """The lines that count: the newest base first, then the last write of every run since, by run."""
    lines = sorted(run_lines(spark, path), key=lambda r: r["write"])
    base = [r for r in lines if r["base"]][-1:]
    since = {r["run"]: r for r in lines if not r["base"] and (not base or r["run"] > base[0]["run"])}
    return base + [since[run] for run in sorted(since)]


def read_history(spark: SparkSession, path: str, date: str) -> DataFrame:
    """Rows of a run log that no later run replaced.

    A run replaces everything from its moment on, in the base as in the runs before it. The moment from which a run
    counts as replaced is the smallest moment of the runs after it. Of a run only its last write counts. The driver gets
    one line for each run since the last base; folders of other writes aren't read, and a range on `__day`, which holds
    the same value as the date column, prunes whole folders.
    """
    limits, until = [], None
    for line in reversed(live_runs(spark, path)):
        limits.append((line["write"], until))
        until = line["moment"] if until is None else min(until, line["moment"] or until)
    log = spark.read.parquet(f"{path.rstrip('/')}/data").filter(F.col("write").isin([w for w, _ in limits]))
    known = spark.createDataFrame(limits, "__write string, __until date")
    visible = F.col("__until").isNull() | (F.col(date) < F.col("__until"))
    return log.join(known, F.col("write") == F.col("__write")).filter(visible).drop("__until", "__write", "write", "__day")
