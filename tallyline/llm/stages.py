"""The stages of the corpus pipeline. A stage takes (spark, docs, sf_dir) and returns rows with the columns of docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import decontaminate, mixing, ngram_join, tokens, toxicity
from tallyline.llm.frames import columns_of, fresh, table
from tallyline.session import scratch_folder, written


def between(docs: DataFrame, name: str) -> DataFrame:
    """The stage's rows as Parquet in the shared folder, read back."""
    return written(docs, f"stage-{name}")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the cut; one that is missing its text scores as empty."""
    model = toxicity.fit(docs, columns_of(table(spark, sf_dir, "labels"), doc_id="bigint", toxic="int"))
    score, = fresh(docs, "score")
    kept = docs.withColumn(score, toxicity.score(docs, model, F.col("text"))).filter(F.col(score) < toxicity.CUT)
    return kept.select(*[f"`{c}`" for c in docs.columns])


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, one with the smallest doc_id; of rows that repeat an id and its words, one.

    Other texts of a repeated id are documents of their own. Rows without id stay.
    """
    kept_id, kept_hash, row = fresh(docs, "kept_id", "kept_hash", "row")
    kept = ngram_join.join(docs).filter("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias(kept_id), F.col("text_hash").alias(kept_hash))
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row)).filter(F.col(f"{row}.doc_id").isNotNull())
    same = (F.col(f"{row}.doc_id") == F.col(kept_id)) & (F.xxhash64(F.col(f"{row}.text").cast("string")) == F.col(kept_hash))
    one = named.join(kept, same).groupBy(kept_id, kept_hash).agg(F.min(row).alias(row))
    return one.select(*[F.col(f"{row}.`{c}`").alias(c) for c in docs.columns]).unionByName(docs.filter("doc_id IS NULL"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def in_proportion(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mixture asks for, at least once."""
    names = fresh(docs, "n_tokens", "weight", "copies")
    mixed = mixing.mixed(docs, names=tuple(names))
    turn, = fresh(mixed, "turn")
    return mixed.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(names[2])))).select(*[f"`{c}`" for c in docs.columns])


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token file of the corpus, read back: doc_id, start, n_tokens and ids_crc32 of every row."""
    path = scratch_folder(spark, "tokens")
    tokens.write(docs, path)
    return tokens.read(spark, path)


STAGES = [
    ("toxicity", without_toxic), ("near_duplicates", without_near_duplicates), ("decontamination", without_benchmark),
    ("mixing", in_proportion), ("tokens", as_tokens),
]
