"""Mixing sources to target weights: temperature, then budgeted block permutations. Column algebra only.

The share p of every source in all tokens is raised to an exponent a between 0 (every source alike) and 1 (as it is)
and normalised. The exponent is bisected: the largest one whose entropy reaches the target, or, if that would repeat
some source more often than allowed, the smallest that keeps to the limit. Every source then gets its weight's part
of the budget in tokens (tokens are what stands between white space).

A source's documents are dealt into blocks by a hash of the id, and ordered by it inside a block. Walking through that
permutation again and again until the budget is used up gives each document its number of copies: whole rounds for
all, one more for those in the part of the last round that still fits. Blocks keep every sorted group small, and only
the one block of each source in which the budget ends is sorted at all.

Defined results: a missing source is a source of its own; a missing text has no token; a source without tokens keeps
one copy of each row. Rows that repeat an id are rows of their own (equal ones get the same number of copies, or one
more). An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.frames import fresh, settled, small, total

#: Entropy of the mixture as a part of the largest possible one, and how often a source may be gone over.
ENTROPY, REPEATS = 0.95, 4.0
#: Target of the registered query: near even, so that it binds wherever sources differ and the limit may bind as well.
NEAR_EVEN = 0.9999
BLOCK_TOKENS, MOST_BLOCKS = 200_000, 4_096
#: Bisections, and how many of them one pass over the sources decides at once.
LEVELS, AT_ONCE = 30, 6
SEED = "mix"


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"\S+")), F.lit(0)).cast("bigint")


def bisected(sources: DataFrame, held: Column) -> float:
    """The largest exponent in [0, 1], to LEVELS binary digits, at which `held` is true; 0 if it never is.

    sources: column p, the shares. held: over the sums z (of p**a) and e (of p**a * ln p) and the least share, `least`.
    It must be true up to some exponent and false beyond. A pass evaluates all inner points of AT_ONCE bisections.
    """
    low, width = 0.0, 1.0
    points = 2**AT_ONCE
    for _ in range(LEVELS // AT_ONCE):
        tried = sources.select("p", F.explode(F.sequence(F.lit(1), F.lit(points))).alias("k")).withColumn("a", F.lit(low) + F.col("k") * F.lit(width / points))
        sums = tried.groupBy("k", "a").agg(
            F.sum(F.pow("p", "a")).alias("z"), F.sum(F.pow("p", "a") * F.log("p")).alias("e"), F.min("p").alias("least"))
        steps = sums.filter(held).agg(F.max("k")).first()[0] or 0
        low, width = low + min(steps, points - 1) * width / points if low + width < 1 or steps < points else 1.0, width / points
        if low == 1.0:
            break
    return low


def exponent(sources: DataFrame, count: int, entropy: float | None = ENTROPY, repeats: float | None = REPEATS) -> float:
    """The exponent for a target entropy (as a part of ln count) under a limit of repetitions."""
    import math

    wanted = bisected(sources, F.log("z") - F.col("a") * F.col("e") / F.col("z") >= F.lit((entropy - 1e-12) * math.log(count))) if entropy is not None and count > 1 else 0.0
    if repeats is None:
        return wanted
    # Repetitions fall with the exponent: the largest exponent at which they are too many, and one step more.
    over = F.pow("least", F.col("a") - 1) / F.col("z") > F.lit(repeats)
    at_zero = sources.agg((1 / (F.min("p") * F.count("*")) > repeats)).first()[0]
    return max(wanted, min(1.0, bisected(sources, over) + 0.5**LEVELS)) if at_zero else wanted


def mixed(docs: DataFrame, entropy: float | None = ENTROPY, repeats: float | None = REPEATS, budget: int | None = None, names: tuple[str, ...] = ("n_tokens", "weight", "copies")) -> DataFrame:
    """The rows of docs with their tokens, their source's weight and their number of copies.

    budget: tokens of the mixture; None takes the least that gives every document at least one copy.
    """
    tokens, key, block, src = fresh(docs, "tokens", "key", "block", "src")
    digest = F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("string")).cast("binary"))
    rows = docs.withColumns({tokens: token_count(F.col("text")), key: digest, src: F.col("source").cast("string")})
    counted = settled(rows.groupBy(F.col(src).alias("s")).agg(F.sum(tokens).alias("t")), "sources")
    full = counted.filter("t > 0")
    count, everything = total(full, F.count("*"), F.sum("t"))
    shares = full.select("s", "t", (F.col("t") / F.lit(float(max(1, everything)))).alias("p"))
    a = exponent(shares, count, entropy, repeats) if count else 1.0
    z, stretch = total(shares, F.sum(F.pow("p", F.lit(a))), F.max(F.pow("p", F.lit(1 - a))))
    # With the whole-copies budget, the source that is stretched least is gone over exactly once.
    size = F.lit(float(budget)) if budget is not None else F.lit(everything * float(stretch) * float(z))
    given = F.floor(F.pow("p", F.lit(a)) / F.lit(float(z) or 1.0) * size + F.lit(1e-6)).cast("bigint")
    plan = small(settled(shares.select(
        "s", "t", (F.pow("p", F.lit(a)) / F.lit(float(z) or 1.0)).alias("w"), (F.greatest(given, F.col("t")) if budget is None else given).alias("given"),
        F.least(F.lit(MOST_BLOCKS), F.ceil(F.col("t") / F.lit(BLOCK_TOKENS))).cast("bigint").alias("n_blocks")), "plan"))
    placed = rows.join(plan, F.col(src).eqNullSafe(F.col("s")), "left").withColumn(
        block, F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") % F.coalesce("n_blocks", F.lit(1)))
    in_order = Window.partitionBy("bs").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    blocks = placed.filter(F.col("t").isNotNull()).groupBy(F.col(src).alias("bs"), F.col(block).alias("b")).agg(
        F.sum(tokens).alias("bt"), F.first("given").alias("bg"), F.first("t").alias("st"))
    # room: what the last round still holds when it comes to this block.
    blocks = small(settled(blocks.select("bs", "b", "bt", (F.col("bg") % F.col("st") - F.coalesce(F.sum("bt").over(in_order), F.lit(0))).alias("room")), "blocks"))
    # Without tokens a source isn't in the plan: one copy of each row.
    rounds = F.coalesce(F.floor(F.col("given") / F.col("t")), F.lit(1)).cast("bigint")
    judged = placed.join(blocks, F.col(src).eqNullSafe(F.col("bs")) & (F.col(block) == F.col("b")), "left").withColumn("rounds", rounds)
    ends = (F.col("room") >= 0) & (F.col("room") < F.col("bt"))
    inside = Window.partitionBy(src).orderBy(key, tokens).rowsBetween(Window.unboundedPreceding, 0)
    last = judged.filter(ends).withColumn("extra", (F.sum(tokens).over(inside) <= F.col("room")).cast("bigint"))
    rest = judged.filter(~F.coalesce(ends, F.lit(False))).withColumn("extra", F.coalesce((F.col("room") >= F.col("bt")).cast("bigint"), F.lit(0)))
    out = [F.col(f"`{c}`") for c in docs.columns]
    return last.unionByName(rest).select(*out, F.col(tokens).alias(names[0]), F.coalesce("w", F.lit(0.0)).alias(names[1]), (F.col("rounds") + F.col("extra")).alias(names[2]))
