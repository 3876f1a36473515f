"""Exact deduplication with a heavy-hitter split (DataFrame functions only).

1. Every text becomes a SHA-256 digest of its normalised form; the narrow
   ``(id, digest)`` table is written once.
2. Misra-Gries finds the digests that may be frequent, with Spark's
   ``approx_top_k`` aggregates: each task keeps at most ``counters`` counters
   (all are decremented when a new item finds the map full), and the maps are
   merged. The survivors that are not frequent do no harm.
3. The survivors are verified: their exact group size and winner come from one
   aggregate, at most ``counters`` rows, broadcast. Their rows are settled
   on the map side, without a shuffle.
4. The remaining digests, each a small share of the rows, take the ordinary
   way: aggregate by digest (combined on the map side), joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txwatch.llm.common import ascii_lower, free_prefix
from txwatch.session import materialize

#: Counters that a sketch holds; a digest above about 3.5 / COUNTERS of the rows is always found.
COUNTERS = 4096


def normal_digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z lower-cased; a null text counts as empty."""
    return F.sha2(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), 256)


def frequent(digests: DataFrame, counters: int = COUNTERS, groups: int = 256) -> DataFrame:
    """Misra-Gries survivors of ``digest``: at most ``counters`` rows.

    The maps of the tasks meet in ``groups`` merges; these summaries are merged
    as Misra-Gries summaries are: counters of one item add up, the largest stay."""
    size = f"{counters}"
    level = digests.groupBy(F.pmod(F.spark_partition_id(), F.lit(groups)).alias("g")).agg(
        F.expr(f"approx_top_k_accumulate(digest, {size})").alias("state"))
    found = level.select(F.explode(F.expr(f"approx_top_k_estimate(state, {size})")).alias("top"))
    return (found.groupBy(F.col("top.item").alias("digest")).agg(F.sum("top.count").alias("n"))
            .orderBy(F.desc("n"), "digest").limit(counters).select("digest"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 counters: int = COUNTERS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Equal texts (after lower-casing A-Z) form a group; its row with the largest
    id stays. Ties (repeated rows with that id) keep exactly one row, any one. A null id is the smallest. A null text equals the empty text.
    An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), normal_digest(F.col(text_col)).alias("digest"))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "exact-digests")
    rank = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    per_digest = [F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id"),
                  F.max_by("row", rank).alias("winner")]

    heavy = F.broadcast(frequent(rows, counters))
    winners = rows.join(heavy, "digest", "left_semi").groupBy("digest").agg(*per_digest)
    winners = materialize(winners, "exact-winners")
    settled = rows.join(F.broadcast(winners), "digest")

    light = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    others = light.join(light.groupBy("digest").agg(*per_digest), "digest")

    return settled.unionByName(others).select(
        "doc_id", "keep_id", "group_size",
        (F.col("winner") == F.col("row")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counters: int = COUNTERS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names.

    A null text is an empty one. Rows that repeat both id and text are one
    document: the first stays. A null id is smaller than any other. An empty
    table gives no rows."""
    own = free_prefix(docs.columns)
    at, sha, body = own + "id", own + "sha", own + "digest"
    groups = exact_groups(docs, id_col, text_col, counters)
    stay = groups.where("kept").select(F.col("doc_id").alias(at), F.col("text_sha256").alias(sha))
    marked = docs.withColumn(body, normal_digest(F.col(text_col)))
    out = marked.join(stay, (F.col(id_col).cast("long").eqNullSafe(F.col(at))) & (F.col(body) == F.col(sha)), "left_semi")
    again = groups.groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = again.select(F.col("doc_id").alias(at), F.col("text_sha256").alias(sha))
    same = (F.col(id_col).cast("long").eqNullSafe(F.col(at))) & (F.col(body) == F.col(sha))
    once = out.join(again, same, "left_anti")
    repeated = out.join(again, same, "left_semi").dropDuplicates([id_col, body])
    return once.unionByName(repeated).drop(body)
