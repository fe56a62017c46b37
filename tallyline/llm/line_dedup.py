"""Line dedup: winnowing over line hashes finds repeated runs of lines, later ones are deleted. Column algebra only.

The lines of a text (without blank ones, compared without spaces around them) are hashed. A gram begins at every line
and takes as many lines as it needs to hold MIN_WORDS words; its hash covers all of them. Of every WINDOW consecutive
grams the one with the smallest hash (of equal ones the last) is a fingerprint: two texts that share WINDOW grams in a
row share a fingerprint, wherever the run lies in them. A fingerprint that occurred before, in the order of documents
and lines, is matched with its first occurrence. The match is extended both ways, line by line, as long as the lines
are equal, up to the text's neighbouring matches, and all lines it covers are deleted. The first occurrence of a line
is never deleted.

Every step is a join or a window of one row per line at most; extension compares each line with two places, those
its left and its right neighbouring match point to, so the work grows with the number of lines.

Defined results: a missing or empty text has nothing to delete and stays as it is. Rows without id are not compared.
Rows that repeat id and text are one document; other rows of an id are documents of their own, in order of a hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.frames import columns_of, settled

MIN_WORDS, WINDOW = 50, 4
KEY = "concat(lpad(cast(doc_id AS string), 20, '0'), substr(md5(cast(text AS binary)), 1, 8))"


def lines_of(texts: DataFrame) -> DataFrame:
    """k (document), pos, n (place among the lines that aren't blank), h, words and the words before the line."""
    each = texts.select("k", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    each = each.select("k", "pos", F.substring(F.md5(F.trim("line").cast("binary")), 1, 16).alias("h"), F.regexp_count("line", F.lit(r"\S+")).cast("bigint").alias("words"))
    order = Window.partitionBy("k").orderBy("pos")
    return each.filter("words > 0").select(
        "*", F.row_number().over(order).cast("bigint").alias("n"),
        (F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words")).alias("begin"))


def fingerprints(lines: DataFrame, min_words: int, window: int) -> DataFrame:
    """(k, n, gram) of the selected grams."""
    reach = Window.partitionBy("k").orderBy("begin").rangeBetween(0, min_words - 1)
    grams = lines.select("k", "n", F.when(F.sum("words").over(reach) >= min_words, F.md5(F.concat_ws("", F.collect_list("h").over(reach)).cast("binary"))).alias("gram"))
    order = Window.partitionBy("k").orderBy("n")
    least = F.min(F.struct("gram", (-F.col("n")).alias("back"))).over(order.rowsBetween(0, window - 1))
    picked = grams.filter("gram IS NOT NULL").select("*", (-least["back"]).alias("pick"))
    return picked.select("k", "n", "gram", F.collect_list("pick").over(order.rowsBetween(1 - window, 0)).alias("picks")).filter(
        F.array_contains("picks", F.col("n"))).select("k", "n", "gram")


def matched(prints: DataFrame) -> DataFrame:
    """(k, n) of every fingerprint that occurred before, with its first occurrence (fk, fn)."""
    first = prints.groupBy(F.col("gram").alias("g")).agg(F.min(F.struct("k", "n")).alias("f"), F.count("*").alias("c")).filter("c > 1")
    found = prints.join(first, F.col("gram") == F.col("g")).select("k", "n", F.col("f.k").alias("fk"), F.col("f.n").alias("fn"))
    return found.filter((F.col("k") != F.col("fk")) | (F.col("n") != F.col("fn")))


def covered(lines: DataFrame, matches: DataFrame) -> DataFrame:
    """(k, pos) of the lines that the extended matches cover."""
    touched = matches.select(F.col("k").alias("mk")).distinct()
    here = lines.select("k", "n", "pos", "h").join(touched, F.col("k") == F.col("mk"), "left_semi")
    marks = matches.select(F.col("k").alias("mk"), F.col("n").alias("mn"), "fk", "fn")
    marked = here.join(marks, (F.col("k") == F.col("mk")) & (F.col("n") == F.col("mn")), "left").withColumn(
        "m", F.when(F.col("mn").isNotNull(), F.struct("mn", "fk", "fn")))
    down = Window.partitionBy("k").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy("k").orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, -1)
    sides = marked.select("k", "n", "pos", "h", F.last("m", ignorenulls=True).over(down).alias("left"), F.last("m", ignorenulls=True).over(up).alias("right"))
    tried = sides.select("k", "n", "pos", "h", F.explode(F.array("left", "right")).alias("at")).filter("at IS NOT NULL").select(
        "k", "n", "pos", "h", F.col("at.mn").alias("mn"), F.col("at.fk").alias("fk"), (F.col("at.fn") + F.col("n") - F.col("at.mn")).alias("place"))
    there = lines.select(F.col("k").alias("tk"), F.col("n").alias("tn"), F.col("h").alias("th"))
    same = tried.join(there, (F.col("fk") == F.col("tk")) & (F.col("place") == F.col("tn")) & (F.col("h") == F.col("th")))
    # A line belongs to the match if none is missing between it and the fingerprint.
    away = F.abs(F.col("n") - F.col("mn"))
    rank = F.row_number().over(Window.partitionBy("k", "mn", (F.col("n") >= F.col("mn"))).orderBy(away))
    gap = away + (F.col("n") >= F.col("mn")).cast("bigint")
    return same.withColumn("unbroken", rank == gap).filter("unbroken").select("k", "pos").distinct()


def dedup(docs: DataFrame, min_words: int = MIN_WORDS, window: int = WINDOW) -> DataFrame:
    """doc_id, text without the deleted lines, n_lines and n_removed for every row of docs."""
    texts = columns_of(docs, doc_id="bigint", text="string").withColumn("key", F.expr(KEY))
    lines = settled(lines_of(texts.filter("key IS NOT NULL").select(F.col("key").alias("k"), "text").distinct()), "lines")
    gone = covered(lines, settled(matched(fingerprints(lines, min_words, window)), "matches"))
    by_text = gone.groupBy(F.col("k").alias("gk")).agg(F.sort_array(F.collect_list("pos")).alias("gone"))
    parts = F.split("text", "\n")
    # Deleted places come in order: the pieces between them are cut out of the array of lines one by one.
    edges = F.concat(F.array(F.lit(-1)), F.col("gone"), F.array(F.size("parts")))
    spans = F.transform(F.sequence(F.lit(1), F.size("gone") + 1), lambda i: F.slice("parts", F.get("edges", i - 1) + 2, F.get("edges", i) - F.get("edges", i - 1) - 1))
    out = texts.join(by_text, F.col("key") == F.col("gk"), "left").withColumn("parts", parts).withColumn("edges", edges)
    return out.select(
        "doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(spans), "\n")).alias("text"),
        F.coalesce(F.size("parts"), F.lit(0)).cast("bigint").alias("n_lines"), F.coalesce(F.array_size("gone"), F.lit(0)).cast("bigint").alias("n_removed"))
