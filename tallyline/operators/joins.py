"""Join forms of reconciliation work.

No side is broadcast by hint: Spark broadcasts a side itself when its measured size is below
spark.sql.autoBroadcastJoinThreshold and shuffles both sides otherwise, and AQE splits hot keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.text import grams


def join_named(left: DataFrame, right: DataFrame, pairs: dict[str, str], how: str = "left") -> DataFrame:
    """Join on differently named keys (left name -> right name); the right keys are dropped."""
    hidden = {r: f"__{r}" for r in pairs.values()}
    other = right.withColumnsRenamed(hidden)
    condition = [F.col(l) == F.col(f"__{r}") for l, r in pairs.items()]
    joined = left.join(other, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*hidden.values())


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join in which a missing key equals a missing key."""
    hidden = {k: f"__{k}" for k in keys}
    other = right.withColumnsRenamed(hidden)
    condition = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    joined = left.join(other, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*hidden.values())


def without(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the left table whose key is absent on the right; missing keys match missing keys."""
    return join_null_safe(left, right.select(*keys).distinct(), keys, "left_anti")


def missing_both_ways(left: DataFrame, right: DataFrame, keys: Sequence[str], names=("left", "right")) -> DataFrame:
    """Keys present on one side only, labelled with the side they were found on.

    Both key sets are reduced before the shuffle and compared in one aggregation,
    so neither table is read twice.
    """
    found = left.select(*keys, F.lit(0).alias("__side")).unionByName(right.select(*keys, F.lit(1).alias("__side")))
    sides = found.groupBy(*keys).agg(F.min("__side").alias("__lo"), F.max("__side").alias("__hi"))
    one_sided = sides.filter(F.col("__lo") == F.col("__hi"))
    side = F.when(F.col("__lo") == 0, F.lit(names[0])).otherwise(F.lit(names[1]))
    return one_sided.select(*keys, side.alias("found_in"))


def natural_join(tables: Iterable[DataFrame], how: str = "left") -> DataFrame:
    """Join tables one after another on all columns they share."""
    def step(x: DataFrame, y: DataFrame) -> DataFrame:
        return x.join(y, [c for c in x.columns if c in set(y.columns)], how)

    return reduce(step, tables)


def common_keys(left: DataFrame, left_key: str, right: DataFrame, right_key: str, name: str) -> DataFrame:
    """Distinct key values found on both sides; a value missing on both is common to them."""
    found = left.select(F.col(left_key).alias(name), F.lit(0).alias("__side")).unionByName(right.select(F.col(right_key).alias(name), F.lit(1).alias("__side")))
    return found.groupBy(name).agg(F.min("__side").alias("__lo"), F.max("__side").alias("__hi")).filter(F.col("__lo") != F.col("__hi")).select(name)


def membership(df: DataFrame, column: str, other: DataFrame, other_column: str, flag: str) -> DataFrame:
    """Add a 0/1 column telling whether the value occurs in another table's column.

    The other side is reduced to distinct keys first, so no row is multiplied. A missing value
    is a member when the other column holds a missing value.
    """
    keys = other.select(F.col(other_column).alias("__key")).distinct().withColumn("__hit", F.lit(1))
    return (
        df.join(keys, F.col(column).eqNullSafe(F.col("__key")), "left")
        .withColumn(flag, F.coalesce(F.col("__hit"), F.lit(0)))
        .drop("__key", "__hit")
    )


def keep_members(df: DataFrame, column: str, other: DataFrame, other_column: str, negate: bool = False) -> DataFrame:
    """Filter by membership in another table's column."""
    keys = other.select(F.col(other_column).alias("__key")).distinct()
    condition = F.col(column).eqNullSafe(F.col("__key"))
    return df.join(keys, condition, "left_anti" if negate else "left_semi")


def lookup_with_fallback(
    df: DataFrame, table: DataFrame, key: str, value: str, first: str, second: str, on: Sequence[str] = (), name: str | None = None
) -> DataFrame:
    """Look a value up by one column and, where that fails, by another.

    `on` lists further equal-named keys of both tables. The lookup table must be unique per key.
    """
    name = name or value

    def side(label: str, column: str) -> tuple[DataFrame, list[Column]]:
        renamed = table.select(
            F.col(key).alias(f"__{label}_key"), F.col(value).alias(f"__{label}"), *[F.col(o).alias(f"__{label}_{o}") for o in on]
        )
        return renamed, [F.col(column) == F.col(f"__{label}_key"), *[F.col(o) == F.col(f"__{label}_{o}") for o in on]]

    a, on_a = side("a", first)
    b, on_b = side("b", second)
    joined = df.join(a, on_a, "left").join(b, on_b, "left")
    drop = [c for t in (a, b) for c in t.columns]
    return joined.withColumn(name, F.coalesce(F.col("__a"), F.col("__b"))).drop(*drop)


def containing_any(df: DataFrame, text: str, codes: DataFrame, code: str) -> DataFrame:
    """Rows whose text contains at least one of the codes as a substring.

    Exact and free of a nested loop: every distinct text is cut into the distinct substrings that have the length of
    the shortest code; those that begin some code are kept, and the codes they begin are looked for in the text.
    """
    wanted = codes.select(F.col(code).alias("__code")).filter(F.length("__code") > 0).distinct()
    shortest = wanted.agg(F.min(F.length("__code")).alias("n")).scalar()
    heads = wanted.withColumn("__head", F.substring("__code", F.lit(1), shortest))
    texts = df.select(F.col(text).alias("__text")).filter(F.col("__text").isNotNull()).distinct()
    cut = texts.withColumn("__n", F.explode(F.array(shortest))).withColumn("__part", F.explode(grams("__text", F.col("__n"))))
    hits = cut.join(heads, F.col("__part") == F.col("__head")).filter(F.contains("__text", "__code")).select("__text").distinct()
    return df.join(hits, F.col(text) == F.col("__text"), "left_semi")


# Buckets in which the grams of all texts are counted, and bits of the map of grams that are looked for.
COUNTED_BUCKETS, MAP_BITS = 1 << 16, 1 << 20


def _occurrences(texts: DataFrame, codes: DataFrame) -> DataFrame:
    """(__text, __code) for every code that occurs in a text; both tables have one distinct, filled column of that name.

    Every code is filed under the one of its q-grams (q: length of the shortest code) that is rarest in the texts, as
    counted in hashed buckets. Of a text's grams only those whose bit is set in a map of the grams on file are shuffled;
    what they are the rarest gram of is looked for in the text. Buckets and map have a fixed size: they decide how much
    is looked at, never what is found.
    """
    shortest = codes.agg(F.min(F.length("__code")).alias("n")).scalar()

    def cut(table: DataFrame, column: str) -> DataFrame:
        return table.withColumn("__n", F.explode(F.array(shortest))).withColumn("__part", F.explode(grams(column, F.col("__n")))).drop("__n")

    def bucket(buckets: int) -> Column:
        return F.pmod(F.xxhash64("__part"), F.lit(buckets))

    def word_and_bit(column: str) -> tuple[Column, Column]:
        at = F.pmod(F.xxhash64(column), F.lit(MAP_BITS))
        return F.floor(at / 64), F.call_function("shiftleft", F.lit(1).cast("bigint"), (at % 64).cast("int"))

    counted = cut(texts, "__text").groupBy(bucket(COUNTED_BUCKETS).alias("__in")).agg(F.count(F.lit(1)).alias("__times"))
    weighed = cut(codes, "__code").join(counted, bucket(COUNTED_BUCKETS) == F.col("__in"), "left")
    # A gram of no text: its code is in none.
    rarest = F.min(F.struct(F.coalesce("__times", F.lit(0)).alias("times"), F.col("__part").alias("part")))
    filed = weighed.groupBy("__code").agg(rarest.alias("__r")).filter("__r.times > 0").select("__code", F.col("__r.part").alias("__filed"))
    # All words are there, so that a word stands at its own place.
    none = texts.sparkSession.range(MAP_BITS // 64).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    words = none.unionByName(filed.select(*[c.alias(n) for c, n in zip(word_and_bit("__filed"), ("word", "bits"), strict=True)]))
    placed = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("m"))
    word, bit = word_and_bit("__part")
    on_file = F.get(placed.select(F.transform("m", lambda w: w["bits"])).scalar(), word.cast("int")).bitwiseAND(bit) != 0
    return cut(texts, "__text").filter(on_file).join(filed, F.col("__part") == F.col("__filed")).filter(F.contains("__text", "__code")).select("__text", "__code")


def containing_any_indexed(df: DataFrame, text: str, codes: DataFrame, code: str) -> DataFrame:
    """Rows whose text contains at least one of the codes, for many codes or codes that begin alike."""
    wanted = codes.select(F.col(code).alias("__code")).filter(F.length("__code") > 0).distinct()
    texts = df.select(F.col(text).alias("__text")).filter(F.col("__text").isNotNull()).distinct()
    return df.join(_occurrences(texts, wanted).select("__text").distinct(), F.col(text) == F.col("__text"), "left_semi")


def first_match(df: DataFrame, text: str, rules: DataFrame, name: str, default: str | None = None) -> DataFrame:
    """Add the label of the first rule whose keyword occurs in the text, for thousands of rules held in a table.

    rules: rank (its order decides; equal ranks go by keyword and label), keyword, label. Works like `categorise`, which
    builds one condition for each rule: without a match the default applies, without a default the text itself is kept;
    missing text and missing keywords match nothing, an empty keyword matches every text.
    """
    known = rules.select("rank", F.col("keyword").alias("__code"), "label").filter(F.col("__code").isNotNull())
    order = F.min(F.struct("rank", F.col("__code").alias("keyword"), "label"))
    texts = df.select(F.col(text).alias("__text")).filter(F.col("__text").isNotNull()).distinct()
    best = known.filter("__code != ''").groupBy("__code").agg(order.alias("rule"))
    pairs = _occurrences(texts, best.select("__code")).withColumnRenamed("__code", "__found")
    found = pairs.join(best, F.col("__found") == F.col("__code")).groupBy("__text").agg(F.min("rule").alias("__rule"))
    always = known.filter("__code = ''").agg(order.alias("rule")).scalar()
    # A rule is a struct: the lesser one is the earlier.
    first = F.least(F.col("__rule"), F.when(F.col(text).isNotNull(), always))
    fallback = F.lit(default) if default is not None else F.col(text)
    return df.join(found, F.col(text) == F.col("__text"), "left").withColumn(name, F.when(first.isNotNull(), first["label"]).otherwise(fallback)).drop("__text", "__rule")


def layout(lines: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Let an ordered list of report lines drive the output; lines without data stay with NULLs."""
    return lines.join(summary, list(keys), "left")


def expand_grid(template: DataFrame, **axes: Iterable) -> DataFrame:
    """One copy of each template row per combination of the axis values.

    The axes are short literal lists, so every row is exploded in place: no join and no shuffle.
    """
    out = template
    for name, values in axes.items():
        out = out.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return out
