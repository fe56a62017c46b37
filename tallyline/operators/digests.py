"""Tie-out of two tables by digests: only buckets of keys that differ are shuffled by key and compared.

Keys are hashed to COARSE x FINE buckets (leaves). A leaf's digest is the number of its rows and, for every measure in
whole units of 10**-digits, its sum; beside each stands the same sum with every row weighted by a hash of its key, modulo
each of two primes. These are linear in the sums per key: rows may be split, ordered and spread over files in any way,
equal sums per key give equal digests, and digests of leaves add up to those of the coarse bucket above them. If the sums
or row counts of any key differ, the digests are equal with a chance of about 2**-62.

Comparing two tables this way takes one aggregation to the few digests. First the coarse buckets are compared, then the
leaves below those that differ, then the rows of differing leaves, by key. Where both tables were written by `write_keyed`
the digests are at hand and the scans of the last step read only the folders of differing buckets.

Missing keys are keys like any other. A missing amount counts as 0. Tables with equal sums per key but another number of
rows of a key are compared in full there, which changes the work, not the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COARSE, FINE = 64, 1024
# The largest primes below 2**31: a product of two residues fits a bigint.
PRIMES = (2147483647, 2147483629)
#: So many leaves are named in a filter; of more, the whole coarse buckets are.
NAMED_LEAVES = 4_096


def key_hash(keys: Sequence[str], seed: str) -> Column:
    """64-bit hash of the keys; a missing one differs from every value and place."""
    parts = [c for k in keys for c in (F.col(k).cast("string"), F.col(k).isNull())]
    return F.xxhash64(F.lit(seed), *parts)


def leaf_of(by: Sequence[str]) -> Column:
    return F.pmod(key_hash(by, "leaf"), F.lit(COARSE * FINE)).cast("int")


def units(measure: str, digits: int) -> Column:
    """An amount in whole units of 10**-digits; a missing one is 0."""
    return F.coalesce(F.round(F.col(measure) * F.lit(10**digits)).cast("bigint"), F.lit(0))


def placed(df: DataFrame, keys: Sequence[str], measures: Sequence[str], by: Sequence[str], digits: int) -> DataFrame:
    """The keys, the measures in whole units, and the leaf and coarse bucket of every row."""
    rows = df.select(*keys, *[units(m, digits).alias(m) for m in measures], leaf_of(by).alias("leaf"))
    return rows.withColumn("coarse", F.floor(F.col("leaf") / FINE).cast("int"))


def _digest_names(measures: Sequence[str]) -> list[str]:
    return [name for k in range(len(measures) + 1) for name in (f"sum_{k}", *(f"mod_{k}_{p}" for p in range(len(PRIMES))))]


def digest_tree(rows: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """The digests of the leaves of placed rows: coarse, leaf, sum_k and mod_k_p, where k = 0 counts rows and the rest are the measures in order."""
    # Row by row each weighted amount is below 2**62, and a residue below 2**31, so that 2**32 rows of a leaf can be added.
    weights = rows.withColumns({f"weight_{p}": F.pmod(key_hash(keys, f"weight {p}"), F.lit(prime)) for p, prime in enumerate(PRIMES)})
    cells = []
    for k, amount in enumerate([F.lit(1).cast("bigint"), *[F.col(m) for m in measures]]):
        cells.append(F.sum(amount).alias(f"sum_{k}"))
        for p, prime in enumerate(PRIMES):
            cells.append(F.pmod(F.sum(F.pmod(F.col(f"weight_{p}") * F.pmod(amount, F.lit(prime)), F.lit(prime))), F.lit(prime)).alias(f"mod_{k}_{p}"))
    return weights.groupBy("coarse", "leaf").agg(*cells)


def _differs(names: Sequence[str]) -> Column:
    """Whether a difference of digests isn't 0, residues modulo their prime."""
    found = F.lit(False)
    for name in names:
        value = F.col(name) if name.startswith("sum_") else F.pmod(F.col(name), F.lit(PRIMES[int(name.rsplit("_", 1)[1])]))
        found = found | (value != 0)
    return found


def differing_leaves(left: DataFrame, right: DataFrame, measures: Sequence[str]) -> dict[int, list[int]]:
    """The leaves whose digests differ, by coarse bucket. Two levels: only leaves below differing coarse buckets are looked at.

    The driver gets at most COARSE and COARSE * FINE numbers, whatever the size of the tables.
    """
    names = _digest_names(measures)
    both = left.select("coarse", "leaf", *names).unionByName(right.select("coarse", "leaf", *[(-F.col(n)).alias(n) for n in names]))
    sums = [F.sum(n).alias(n) for n in names]
    coarse = [r[0] for r in both.groupBy("coarse").agg(*sums).filter(_differs(names)).select("coarse").collect()]
    if not coarse:
        return {}
    found: dict[int, list[int]] = {}
    for r in both.filter(F.col("coarse").isin(coarse)).groupBy("coarse", "leaf").agg(*sums).filter(_differs(names)).select("coarse", "leaf").collect():
        found.setdefault(r[0], []).append(r[1])
    return found


def _in_leaves(rows: DataFrame, leaves: dict[int, list[int]]) -> DataFrame:
    """The rows of differing leaves; the coarse bucket, which may be a folder, is named first."""
    kept = rows.filter(F.col("coarse").isin(sorted(leaves))) if leaves else rows.filter(F.lit(False))
    named = sorted(leaf for own in leaves.values() for leaf in own)
    return kept.filter(f"leaf IN ({', '.join(map(str, named))})") if 0 < len(named) <= NAMED_LEAVES else kept


def compared(left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str], names: Sequence[str], digits: int) -> DataFrame:
    """Sums of placed rows per key on either side and which sides hold the key, in one aggregation."""
    sides = [df.select(*keys, *measures, F.lit(name).alias("__side")) for df, name in zip((left, right), names, strict=True)]
    both = sides[0].unionByName(sides[1])
    cells = [(F.sum(F.when(F.col("__side") == name, F.col(m))) / F.lit(10**digits)).alias(f"{m}_{name}") for m in measures for name in names]
    found = [F.max(F.col("__side") == name).alias(f"in_{name}") for name in names]
    return both.groupBy(*keys).agg(*cells, *found)


def differences(sums: DataFrame, measures: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The keys that stand on one side only or have another sum there."""
    one_sided = F.col(f"in_{names[0]}") != F.col(f"in_{names[1]}")
    for m in measures:
        one_sided = one_sided | ~F.col(f"{m}_{names[0]}").eqNullSafe(F.col(f"{m}_{names[1]}"))
    return sums.filter(one_sided)


def tie_out(
    left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str] = (), names: Sequence[str] = ("left", "right"),
    by: Sequence[str] | None = None, digits: int = 2, all_of_bucket: bool = False,
) -> DataFrame:
    """Keys whose sums differ or that one side lacks: keys, {measure}_{name} and in_{name} of both sides.

    `by` names the keys that decide the bucket, if not all. With `all_of_bucket` the other keys of differing buckets are
    returned too. Equal buckets are scanned, never shuffled by key.
    """
    by = list(by or keys)
    rows = [placed(df, keys, measures, by, digits) for df in (left, right)]
    leaves = differing_leaves(*[digest_tree(r, keys, measures) for r in rows], measures)
    sums = compared(*[_in_leaves(r, leaves) for r in rows], keys, measures, names, digits)
    return sums if all_of_bucket else differences(sums, measures, names)


def write_keyed(df: DataFrame, path: str, keys: Sequence[str], measures: Sequence[str] = (), by: Sequence[str] | None = None, digits: int = 2) -> None:
    """Keys and measures as Parquet, one folder for each coarse bucket, with the digests beside them.

    The rows are dealt by ranges of (leaf, row number) and sorted by them, so a hot key is spread over as many files as it
    needs, and of a folder only the row groups that hold a differing leaf are read.
    """
    rows = placed(df, keys, measures, list(by or keys), digits).withColumn("__turn", F.monotonically_increasing_id())
    rows.repartitionByRange("leaf", "__turn").sortWithinPartitions("leaf").drop("__turn").write.partitionBy("coarse").parquet(f"{path.rstrip('/')}/rows")
    written = read_rows(df.sparkSession, path, keys, measures)
    digest_tree(written, keys, measures).write.parquet(f"{path.rstrip('/')}/tree")


def read_rows(spark: SparkSession, path: str, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/rows").select(*keys, *measures, "leaf", "coarse")


def tie_out_written(
    spark: SparkSession, left: str, right: str, keys: Sequence[str], measures: Sequence[str] = (), names: Sequence[str] = ("left", "right"), digits: int = 2
) -> DataFrame:
    """Like tie_out, for two tables of write_keyed: folders of equal buckets aren't read."""
    trees = [spark.read.parquet(f"{p.rstrip('/')}/tree") for p in (left, right)]
    leaves = differing_leaves(*trees, measures)
    sums = compared(*[_in_leaves(read_rows(spark, p, keys, measures), leaves) for p in (left, right)], keys, measures, names, digits)
    return differences(sums, measures, names)
