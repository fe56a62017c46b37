"""From raw documents to a token file: the stages of the corpus pipeline, each by one operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyline.llm.stages import STAGES, between
from tallyline.llm.frames import table

#: Classifiers, MinHash and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents; what a stage returns is written once and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = between(docs, name)
    return docs
