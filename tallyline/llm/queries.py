"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import decontaminate, language, line_dedup, mixing, multi_index, ngram_join, prefix_trie, secret_scan, sharding, spelling, tokens, toxicity, wrappers
from tallyline.llm.oracles import LINE_DEDUP, MIXING, PREFIX_TRIE, SHARDING, SPELLING
from tallyline.llm.frames import columns_of, fold, table
from tallyline.session import scratch_folder

QUERIES: dict = {}
ORACLES: dict[str, str] = {"op6_mixing": MIXING, "op10_line_dedup": LINE_DEDUP, "op11_sharding": SHARDING, "op12_spelling": SPELLING, "op13_prefix_trie": PREFIX_TRIE}


def registered(plan):
    QUERIES[plan.__name__] = plan
    return plan


@registered
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four of five folds."""
    docs = columns_of(table(spark, sf_dir, "documents"), doc_id="bigint", text="string", lang="string")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = language.fit(docs.filter(~held_out))
    return language.predict(docs, model, F.col("text"), F.col("doc_id"), held_out.alias("held_out"))


@registered
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from two of three folds."""
    docs = columns_of(table(spark, sf_dir, "documents"), doc_id="bigint", text="string", lang="string")
    labels = columns_of(table(spark, sf_dir, "labels"), doc_id="bigint", toxic="int")
    model = toxicity.fit(docs, labels.filter(fold(F.col("doc_id"), 3) != 1))
    scored = docs.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), toxicity.score(docs, model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= toxicity.CUT).cast("int"))


@registered
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its near-duplicate class and its number of links."""
    return ngram_join.join(table(spark, sf_dir, "documents"))


@registered
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items that occur in it."""
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", *[c.alias(name) for name, c in decontaminate.verdict(F.col("found")).items()])


@registered
def op9_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, read back from the token file of all documents."""
    path = scratch_folder(spark, "tokens")
    tokens.write(table(spark, sf_dir, "documents"), path)
    return tokens.read(spark, path)


@registered
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its source's weight and its number of copies in the mixture."""
    docs = columns_of(table(spark, sf_dir, "documents"), doc_id="bigint", source="string", text="string")
    mixed = mixing.mixed(docs, mixing.NEAR_EVEN)
    return mixed.select("doc_id", "source", "n_tokens", F.round("weight", 9).alias("weight"), "copies")


@registered
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the runs of lines that occurred before."""
    return line_dedup.dedup(table(spark, sf_dir, "documents"))


@registered
def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its number of links and its component."""
    return multi_index.join(table(spark, sf_dir, "embeddings"))


@registered
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets in every document."""
    spans = F.col("spans")
    return secret_scan.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", *[secret_scan.count_of(spans, kind).alias(f"n_{kind}") for kind in secret_scan.KINDS],
        F.sha2(secret_scan.digest(spans, base_only=True).cast("binary"), 256).alias("base_sha256"), secret_scan.digest(spans, base_only=False).alias("spans"))


@registered
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return wrappers.extract(table(spark, sf_dir, "pages"))


@registered
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of eight alike, its slot there, and its shard of nine."""
    return sharding.plan(table(spark, sf_dir, "documents"), [1.0] * sharding.SHARDS)


@registered
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its more frequent form and the root its forms lead to."""
    return spelling.variants(table(spark, sf_dir, "documents"))


@registered
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie.nodes(table(spark, sf_dir, "conversations"))
