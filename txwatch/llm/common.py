"""Helpers shared by the operators of this subpackage.

Text columns are read null-safe (a null text is an empty text) and whole.
``batched`` deals documents into batches of a bounded number of bytes that
all passes of one query share, so its exchange is planned once and reused.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE = r"[\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+``; an empty array for a null text."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE)
    return F.filter(parts, lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once (a column that a lambda names
    could be put in its place and be computed again for each element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def free_prefix(columns: list[str]) -> str:
    """Underscores that no column starts with, for columns of our own beside them."""
    prefix = "__"
    while any(c.startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Bytes of all texts (one number, from one narrow scan)."""
    row = docs.agg(F.sum(F.octet_length(F.col(text_col))).alias("n")).first()
    return int(row.n or 0)


def n_parts(total: int, each: int, least: int) -> int:
    return max(least, math.ceil(total / each))


def batched(docs: DataFrame, id_col: str, text_col: str, n_batches: int) -> DataFrame:
    """``(batch, doc_id, body)``: every row once, dealt by a hash of its id and
    text into ``n_batches`` batches; ``body`` is the text in UTF-8 (null: empty)."""
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    batch = F.pmod(F.xxhash64(F.col(id_col), body), F.lit(n_batches)).cast("int")
    return (docs.select(batch.alias("batch"), F.col(id_col).cast("long").alias("doc_id"),
                        body.cast("binary").alias("body"))
            .repartition(n_batches, "batch"))
