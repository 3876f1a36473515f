"""Document scores of a gated recurrent language model and of a smoothed unigram base.

1. Documents are dealt in batches. Each batch writes its distinct tokens with
   their counts in its training documents; Spark adds them up over all batches.
   The most frequent tokens are the model's vocabulary, the others are one
   unknown word to the model and share its probability by their counts.
2. The training documents are written once as numbers, in parts by a hash.
   Training is data-parallel: in each round every partition trains on its
   documents from the same parameters, and the parameters are averaged by
   weight in two levels. A round takes one part and the rounds deal all of them,
   so each document is seen exactly once.
3. Each batch joins its tokens to the counts and scores its texts whole.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch.llm import gru
from txwatch.llm.common import UPPER, batched, n_parts, text_bytes
from txwatch.session import materialize, scratch_path

#: Model size. SHARE of the training documents (all of them) moves the weights, in ROUNDS; all of them give the counts.
VOCABULARY, HIDDEN, ROUNDS, SHARE, RATE = 1024, 16, 4, 1.0, 0.01
BATCH_BYTES, BUFFER = 32 << 20, 1 << 20
ALPHA = 0.1
END = b""
UNKNOWN, STOP = 0, 1
LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())


def tokens(body: bytes) -> list[bytes]:
    """Words of a text with A-Z lower-cased, then the end."""
    found = body.translate(LOWER).split()
    found.append(END)
    return found


def numbers(index: dict[bytes, int], body: bytes) -> np.ndarray:
    """Each token's number (``UNKNOWN`` if it has none)."""
    found = tokens(body)
    return np.fromiter(map(index.get, found, repeat(UNKNOWN)), np.int32, len(found))


def held_out(doc_id):
    """Whether crc32 of the id as text leaves 0 by 10 (a null id: as an empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def batch_tokens(rows: DataFrame) -> DataFrame:
    """``batch, token, c``: the distinct tokens of each batch of ``rows`` and how
    often they are in its training documents (0: only in held-out ones)."""

    def run(key, group):
        counts: Counter = Counter()
        seen: set[bytes] = set()  # of held-out documents
        for body, out in zip(group.column("body").to_pylist(), group.column("out").to_pylist(), strict=True):
            (seen if out else counts).update(tokens(body))
        rest = list(seen.difference(counts))
        found = [*counts, *rest]
        return pa.table([pa.array([key[0].as_py()] * len(found), pa.int32()), pa.array(found, pa.binary()),
                         pa.array([*counts.values(), *[0] * len(rest)], pa.int64())], names=["batch", "token", "c"])

    return rows.withColumn("out", held_out(F.col("doc_id"))).groupBy("batch").applyInArrow(run, "batch int, token binary, c long")


def numbered(training: DataFrame, vocabulary: list[bytes], parts: int) -> DataFrame:
    """``part, ids`` of the training documents, written in parts: each word's number in
    the vocabulary (16 bits; the vocabulary is smaller)."""
    index = {t: i for i, t in enumerate(vocabulary)}
    if len(index) > 1 << 15:
        raise ValueError("the vocabulary is numbered in 16 bits")

    def run(batches):
        for b in batches:
            ids = [numbers(index, body).astype("<i2").tobytes() for body in b.column("body").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("part"), pa.array(ids, pa.binary())], names=["part", "ids"])

    path = scratch_path(training.sparkSession, "numbered")
    dealt = F.pmod(F.xxhash64("doc_id", "body"), F.lit(parts)).cast("int")
    training.select(dealt.alias("part"), "body").mapInArrow(run, "part int, ids binary").write.partitionBy("part").parquet(path)
    return training.sparkSession.read.schema("ids binary, part int").parquet(path)


def train_model(training: DataFrame, vocabulary: list[bytes], mass: np.ndarray, hidden: int, rounds: int, share: float,
                rate: float) -> gru.Params:
    """Averaged parameters after all rounds; one model reaches the driver a round."""
    params = gru.init(mass, hidden)
    parts = max(1, round(rounds / share))
    written = numbered(training, vocabulary, parts)
    for k in range(min(rounds, parts)):
        now = gru.dumps(params)

        def run(batches, now=now):
            p = gru.loads(now)
            adam, docs, held, seen = gru.Adam(p, rate), [], 0, 0
            for b in batches:
                for ids in b.column("ids").to_pylist():
                    docs.append(np.frombuffer(ids, "<i2").astype(np.int32))
                    held += len(docs[-1])
                    if held >= BUFFER:
                        gru.train(p, docs, STOP, adam)
                        seen, held, docs = seen + held, 0, []
            if docs:
                gru.train(p, docs, STOP, adam)
                seen += held
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([gru.dumps(p)], pa.binary())],
                                                 names=["weight", "model"])

        def mean(group):
            total, summed = 0, None
            for w, m in zip(group.column("weight").to_pylist(), group.column("model").to_pylist(), strict=True):
                p = gru.loads(m)
                summed = {x: v * float(w) for x, v in p.items()} if summed is None else {
                    x: summed[x] + v * float(w) for x, v in p.items()}
                total += w
            average = gru.dumps({x: (v / total).astype(np.float32) for x, v in summed.items()})
            return pa.table([pa.array([total], pa.int64()), pa.array([average], pa.binary())], names=["weight", "model"])

        models = written.where(F.col("part") == k).select("ids").mapInArrow(run, "weight long, model binary")
        models = materialize(models.withColumn("row", F.monotonically_increasing_id()), "models")
        groups = max(1, math.isqrt(models.count()))
        once = models.select(F.pmod(F.xxhash64("row"), F.lit(groups)).alias("g"), "weight", "model").groupBy("g").applyInArrow(mean, "weight long, model binary")
        found = once.withColumn("g", F.lit(0)).groupBy("g").applyInArrow(mean, "weight long, model binary").collect()
        if found:
            params = gru.loads(bytes(found[0].model))
    return params


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: int = VOCABULARY,
           hidden: int = HIDDEN, rounds: int = ROUNDS, share: float = SHARE, rate: float = RATE,
           batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score`` (log10 probabilities of the whole text).

    A null text is an empty one: its only token is the end. A null id is held
    out. Repeated rows are scored each. Without training documents the base has
    only the unknown token. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    # a batch for every core at least; larger ones share more of their tokens
    n_batches = n_parts(text_bytes(docs, text_col), batch_bytes, spark.sparkContext.defaultParallelism)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("body"))
    training = narrow.where(~held_out(F.col("doc_id")))
    rows = batched(docs, id_col, text_col, n_batches)
    asked = materialize(batch_tokens(rows), "batch-tokens")
    counts = materialize(asked.where(F.col("c") > 0).groupBy("token").agg(F.sum("c").alias("c")), "token-counts")

    whole = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = counts.where(F.col("token") != F.lit(bytearray(END))).orderBy(F.desc("c"), "token").limit(vocabulary - 2).collect()
    n_ends = sum(r.c for r in counts.where(F.col("token") == F.lit(bytearray(END))).collect())
    known = [bytes(r.token) for r in top]
    tail = whole.n - n_ends - sum(r.c for r in top)
    n_tail = whole.v - len(known) - (n_ends > 0)
    words = [None, END, *known]  # 0: every token that is not in the list
    mass = np.array([tail, n_ends, *(r.c for r in top)], np.float64)
    params = gru.dumps(train_model(training, words, mass, hidden, rounds, share, rate))

    n_train, all_mass = int(whole.n), float(whole.n + ALPHA * (whole.v + 1))
    rare_mass = float(tail + ALPHA * (n_tail + 1))
    index = {t: i for i, t in enumerate(words)}
    count_of = mass.copy()

    def judge(group, answers):
        p = gru.loads(params)
        number, rare = dict(index), []
        for t, c in zip(answers.column("token").to_pylist(), answers.column("c").to_pylist(), strict=True):
            if t not in index:
                number[t] = len(words) + len(rare)
                rare.append(c)
        c = np.concatenate([count_of, np.array(rare, np.float64)])
        c[UNKNOWN] = 0  # below: a token that training has not seen
        base = np.log10((c + ALPHA) / all_mass)
        share_of = np.log10((c + ALPHA) / rare_mass)
        share_of[1:len(words)] = 0  # in the vocabulary: the model alone
        bodies = group.column("body")
        size = np.array([len(x) for x in bodies.to_pylist()], np.int64)
        n, known_, total, model = (np.zeros(len(size), kind) for kind in (np.int64, np.int64, np.float64, np.float64))

        def settle(at: list[int], docs_: list[np.ndarray]) -> None:
            model[at] += gru.score(p, docs_, STOP) / np.log(10)

        at, docs_, held = [], [], 0
        for k in np.argsort(-size, kind="stable").tolist():  # texts of about one length run side by side
            ids = numbers(number, bodies[k].as_py())
            n[k], known_[k], total[k], model[k] = len(ids), (c[ids] > 0).sum(), base[ids].sum(), share_of[ids].sum()
            ids[ids >= len(words)] = UNKNOWN
            at.append(k)
            docs_.append(ids)
            held += len(ids)
            if held >= BUFFER:
                settle(at, docs_)
                at, docs_, held = [], [], 0
        if at:
            settle(at, docs_)
        return pa.table([group.column("doc_id"), *(pa.array(x) for x in (n, known_, total, model))],
                        names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    answered = asked.select("batch", "token").join(counts, "token").select(F.col("batch").alias("of"), "token", "c")
    judged = rows.groupBy("batch").cogroup(answered.groupBy("of")).applyInArrow(
        judge, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
                         F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score")
