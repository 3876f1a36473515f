"""From raw documents to packed training sequences, in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its rows are written as
Parquet under the shared checkpoint folder and read again as the next one's
``docs``, so a lost executor never costs more than one stage. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txwatch.llm import exact_dedup, ngram_join, packing, quality_rules, substring_dedup
from txwatch.llm.common import table
from txwatch.llm.queries import vocabulary
from txwatch.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the one with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies, the one with the smallest id stays."""
    return ngram_join.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has are cut out of the text."""
    out = substring_dedup.drop_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts' ids as pieces of sequences."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality), ("exact_dedup", exact), ("ngram_join", near),
          ("substring_dedup", passages), ("packing", packed)]

#: No SQL form: Jaccard classes and packing are tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents`` after all stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
