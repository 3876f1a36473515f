"""Jaccard join on word n-grams with MinHash banding.

Two documents are linked if the Jaccard similarity of their sets of ``n``-word
shingles is at least ``threshold``. A text of fewer words is one shingle; a
text without words has none and links to nothing.

1. Each document gets MinHash values cut into bands (``banding`` picks their
   number for a target recall) and a digest of its whole shingle set. Documents
   with equal sets are copies: one node with a weight.
2. Nodes are shuffled on band hashes; every node of a bucket is tied to the
   bucket's smallest node, one row each, and connected components of these ties
   are the candidates: any pair that shares a band is inside one.
3. Inside each candidate component all pairs are verified on their full n-gram
   sets, as counts of common shingles in a matrix product. A large component is
   cut into blocks of a bounded number of nodes and each pair of blocks is a
   task of its own; a task returns each node's number of links and its root
   among them, never the pairs.
4. Connected components of the verified links give the classes.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch.llm.common import free_prefix, n_parts
from txwatch.llm.components import components
from txwatch.llm.hashing import U, mix, window_hashes, word_hashes
from txwatch.session import materialize

GRAM, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.999, 128
BLOCK, TASK_BYTES, COLUMNS = 1024, 16 << 20, 4096
NO_ID = (1 << 63) - 1


def banding(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """``(bands, rows)``: the most rows a band, which give the fewest false
    candidates, at which a pair at the threshold shares a band with ``recall``."""
    best = (max_hashes, 1)
    for rows in range(1, max_hashes + 1):
        hit = threshold ** rows
        bands = 1 if hit >= recall else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows > max_hashes:
            break
        best = (bands, rows)
    return best


def shingles(body: bytes, n: int = GRAM) -> np.ndarray:
    """The distinct hashes of a text's n-word shingles, sorted."""
    h = word_hashes(body.split())
    return np.unique(window_hashes(h, min(n, len(h)))) if len(h) else h


def min_hashes(found: np.ndarray, seeds: np.ndarray, factors: np.ndarray) -> np.ndarray:
    low = np.full(len(seeds), np.iinfo(U).max, U)
    for at in range(0, len(found), COLUMNS):
        part = found[at:at + COLUMNS, None]
        low = np.minimum(low, ((part ^ seeds) * factors).min(axis=0))
    return low


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, text_key, n_bytes, set_key`` and band hashes of rows ``doc_id, text_key, body``."""
    seeds = mix(np.arange(1, bands * rows + 1, dtype=U) * U(0x9E3779B97F4A7C15))
    factors = mix(seeds + U(1)) | U(1)
    salt = mix(np.arange(bands, dtype=U) + U(77))

    def run(batches):
        for b in batches:
            keys, values = [], []
            bodies = b.column("body").to_pylist()
            for body in bodies:
                found = shingles(body, n)
                if not len(found):
                    keys.append(None)
                    values.append([])
                    continue
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                low = min_hashes(found, seeds, factors).reshape(bands, rows)
                band = salt.copy()
                for r in range(rows):
                    band = mix(band * U(0x9E3779B97F4A7C15) + low[:, r])
                values.append(band.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_key"), pa.array(map(len, bodies), pa.int64()),
                 pa.array(keys, pa.binary()), pa.array(values, pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "n_bytes", "set_key", "bands"])

    return docs.mapInArrow(run, "doc_id long, text_key long, n_bytes long, set_key binary, bands array<long>")


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets share, of all sets if ``right`` is empty."""
    sets, n = [*left, *right], len(left)
    values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    size = np.diff(np.append(new, len(values)))
    column = np.cumsum(size > 1) - 1  # only shingles of two sets count
    total = int(column[-1]) + 1
    shared = np.repeat(size > 1, size)
    owner, column = owner[shared], np.repeat(column, size)[shared]
    both = np.zeros((n, len(right) or n), np.float32)
    for at in range(0, total, COLUMNS):
        a, b = np.searchsorted(column, (at, at + COLUMNS))
        x = np.zeros((len(sets), min(COLUMNS, total - at)), np.float32)
        x[owner[a:b], column[a:b] - at] = 1
        both += x[:n] @ (x[n:] if right else x).T
    return both.astype(np.float64)


def linked(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which two sets, one of each side or all of the left if ``right`` is empty,
    have a Jaccard similarity of at least the threshold, as a square matrix."""
    n = len(left)
    size = np.array([len(s) for s in (*left, *right)], np.float64)
    both = common_counts(left, right)
    near = both / (size[:n, None] + size[None, n if right else 0:] - both) >= threshold
    if not right:
        np.fill_diagonal(near, False)
        return near
    out = np.zeros((len(size), len(size)), bool)
    out[:n, n:], out[n:, :n] = near, near.T
    return out


def roots(links: np.ndarray) -> np.ndarray:
    """The first node of each node's component."""
    label = np.arange(len(links))
    while True:
        near = np.where(links, label[None, :], len(links)).min(axis=1, initial=len(links))
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def verified(candidates: DataFrame, n: int, threshold: float) -> DataFrame:
    """``node, root, links`` for each node and block pair it takes part in."""

    def run(group):
        out = {"node": [], "root": [], "links": []}
        cols = {c: group.column(c).to_pylist() for c in ("part", "i", "j", "block", "node", "weight", "body")}
        sets = {}
        parts: dict[tuple, dict[int, int]] = {}
        for r, key in enumerate(zip(cols["part"], cols["i"], cols["j"], strict=True)):
            parts.setdefault(key, {}).setdefault(cols["node"][r], r)  # a repeated row is one node
        for (_, i, j), rows in parts.items():
            rows = [rows[x] for x in sorted(rows)]
            if len(rows) < 2:
                continue
            for r in rows:
                if cols["node"][r] not in sets:
                    sets[cols["node"][r]] = shingles(cols["body"][r], n)
            rows.sort(key=lambda r: cols["block"][r])  # by block, by node within
            of = [sets[cols["node"][r]] for r in rows]
            n_left = len(rows) if i == j else sum(cols["block"][r] == i for r in rows)
            if n_left == 0 or (i != j and n_left == len(rows)):
                continue
            links = linked(of[:n_left], of[n_left:], threshold)
            weight = np.array([cols["weight"][r] for r in rows], np.int64)
            root = roots(links)
            some = np.flatnonzero(links.any(axis=1))
            out["node"] += [cols["node"][rows[k]] for k in some]
            out["root"] += [cols["node"][rows[root[k]]] for k in some]
            out["links"] += (links[some] @ weight).tolist()
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})

    return candidates.groupBy("task").applyInArrow(run, "node long, root long, links long")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = GRAM,
               threshold: float = THRESHOLD, recall: float = RECALL, block: int = BLOCK) -> DataFrame:
    """One row per input row: ``doc_id, text_key`` (a 64-bit hash of the text)``,
    class_id`` (smallest id of its class of linked documents)``, n_links`` (how many
    other rows it is linked to, copies included)``, n_copies`` (rows with the
    same shingle set, itself included) and ``leads`` (one row of each class, that
    with its smallest id).

    A row without words is its own class without links. Repeated rows are
    copies. A null id gives way to any other as class id; a class of null ids
    has a null class id. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    bands, rows = banding(threshold, recall)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"),
                         text.cast("binary").alias("body"))
    signed = materialize(signatures(narrow, n, bands, rows).withColumn("row", F.monotonically_increasing_id()),
                         "signatures")
    nodes = materialize(signed.where("set_key is not null").groupBy("set_key").agg(
        F.min("row").alias("node"), F.count(F.lit(1)).alias("weight"), F.min("doc_id").alias("low_id"),
        F.min_by("row", F.coalesce("doc_id", F.lit(NO_ID))).alias("low_row")), "nodes")

    lead = signed.join(nodes.select(F.col("node").alias("row"), "weight"), "row")
    band = lead.select(F.explode("bands").alias("band"), F.col("row").alias("node"))
    bucket = band.groupBy("band").agg(F.min("node").alias("low"), F.count(F.lit(1)).alias("size")).where("size > 1")
    ties = band.join(bucket, "band").where("node <> low").select(F.col("node").alias("u"), F.col("low").alias("v"))
    tied = components(ties)
    tied = materialize(tied.unionByName(tied.select(F.col("root").alias("node"), "root").distinct()), "tied")

    # blocks of at most about `block` nodes; one row for each block pair a node is in
    size = tied.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    member = (tied.join(size, "root")
              .join(lead.select(F.col("row").alias("node"), "weight", "doc_id", "text_key", "n_bytes"), "node")
              .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = member.agg(F.sum(F.col("blocks") * F.col("n_bytes")).alias("n")).first().n or 0
    n_tasks = n_parts(held, TASK_BYTES, least)
    pair = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    texts = (narrow.withColumnRenamed("doc_id", "id").withColumnRenamed("text_key", "key")
             .join(member, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key"))))
    candidates = (texts.withColumn("other", pair)
                  .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
                  .select(F.pmod(F.xxhash64("root", "i", "j"), F.lit(n_tasks)).cast("int").alias("task"),
                          F.col("root").alias("part"), "i", "j", "block", "node", "weight", "body"))
    links = materialize(verified(candidates, n, threshold), "links")

    degree = links.groupBy("node").agg(F.sum("links").alias("links"))
    root = components(links.select(F.col("node").alias("u"), F.col("root").alias("v")))
    classes = (nodes.join(root, "node", "left").join(degree, "node", "left")
               .select("set_key", "weight", "low_id", "low_row", F.coalesce("root", "node").alias("root"),
                       (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    names = classes.groupBy("root").agg(F.min("low_id").alias("class_id"),
                                         F.min_by("low_row", F.coalesce("low_id", F.lit(NO_ID))).alias("lead"))
    classes = classes.join(names, "root")
    return signed.join(classes, "set_key", "left").select(
        "doc_id", "text_key", F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("weight", F.lit(1).cast("long")).alias("n_copies"),
        (F.col("set_key").isNull() | (F.col("row") == F.col("lead"))).alias("leads"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that lead their class, with their columns, whatever
    their names; of rows that repeat both id and text at most one.

    A null or empty text is in no pair, so its row stays. A null id gives way
    to any other. An empty table gives no rows."""
    own = free_prefix(docs.columns)
    at, key, body, more = own + "id", own + "key", own + "text", own + "again"
    found = ngram_join(docs, id_col, text_col, **options)
    stay = found.where("leads").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    rows = found.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("all"))
    stay = stay.join(rows.withColumnRenamed("doc_id", "d").withColumnRenamed("text_key", "k"),
                     F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")))
    stay = materialize(stay.select(F.col("doc_id").alias(at), F.col("text_key").alias(key),
                                   (F.col("n") < F.col("all")).alias(more)), "leaders")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.withColumn(body, F.xxhash64(text)).join(
        stay, F.col(id_col).cast("long").eqNullSafe(F.col(at)) & (F.col(body) == F.col(key)))
    once = out.where(~F.col(more))
    repeated = out.where(F.col(more)).dropDuplicates([id_col, body])
    return once.unionByName(repeated).select(*[F.col(f"`{c}`") for c in docs.columns])
