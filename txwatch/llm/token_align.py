"""Alignment of two tokenizers' tokens by the bytes they cover, in Arrow arrays.

A slice of documents is encoded by both tokenizers into list arrays. Flattening
the lists, their parent indices and running sums of the tokens' byte lengths
that start anew with each document give every token's end; ``(document, end)``
keys of both sides meet in a hash join, which finds the ends that they share.
Shared ends cut a document into groups, and the two tokens that end there are a
link. Links are counted by pair of ids chunk by chunk (``Table.group_by``), the
partial counts are exploded and added up by Spark, and each chunk gets back the
counts of the pairs that it holds.

Both vocabularies keep white space at the start of a token, so a text can be cut
before a single space between two other characters without changing its tokens:
each distinct unit of a slice is encoded once.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txwatch.llm.tokens import LONG_RUN, byte_encoder, encode
from txwatch.session import materialize

#: Bytes of text that are aligned at once, and that share one table of pairs.
SLICE, CHUNK = 1 << 20, 8 << 20
#: Encoded units in a worker's younger half (the older half is as large), and the longest that it keeps.
KEPT, KEPT_LENGTH = 100_000, 64
SPACE = "▁"
ENDS = 40  # bits of an end within a document


class Pair:
    """The two vocabularies, and the units encoded so far."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.path_a, self.a = path_a, byte_encoder(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        n_b = self.b.get_piece_size()
        known = {i: t for t, i in self.a._mergeable_ranks.items()}
        self.bytes_a = [known.get(i, b"") for i in range(self.a.n_vocab)]
        pieces = [self.b.id_to_piece(i) for i in range(n_b)]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        # a unit may start before a space only if no piece has a space behind another character
        apart = all(SPACE not in p.lstrip(SPACE) for i, p in enumerate(pieces) if not self.b.is_control(i))
        self.cut = re.compile(r"(?<=\S) (?=\S)").split if apart else (lambda text: [text])
        self.size_a, self.size_b = (pa.array([len(t) for t in x], pa.int64()) for x in (self.bytes_a, self.bytes_b))
        self.spelt_a, self.spelt_b = (pa.array(x, pa.large_binary()) for x in (self.bytes_a, self.bytes_b))
        self.n_a, self.n_b = len(self.bytes_a), n_b
        # each id in decimal, as it stands inside its part of a group and at the part's end
        self.text = pa.array([f"{i}{sep}" for n, seps in ((self.n_a, ",|"), (self.n_b, ",;")) for sep in seps for i in range(n)],
                             pa.large_string())
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def fresh(self, units: list[str]) -> list[bytes]:
        """Of each unit: whether both sides spell it, how many ids of a, these, the ids of b (32-bit)."""
        of_a = [encode(self.path_a, " " + u, special=False).tolist() if len(u) >= LONG_RUN else self.a.encode_ordinary(" " + u)
                for u in units]
        of_b = self.b.encode(units, num_threads=1)
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (of_a, of_b))
        flat_a, flat_b = (np.fromiter(chain.from_iterable(x), np.int32, int(n.sum())) for x, n in ((of_a, n_a), (of_b, n_b)))
        bodies = [b" " + u.encode() for u in units]
        size, whole, sound = np.fromiter(map(len, bodies), np.int64, len(bodies)), b"".join(bodies), np.ones(len(units), bool)
        for flat, n, sizes, table in ((flat_a, n_a, self.size_a, self.spelt_a), (flat_b, n_b, self.size_b, self.spelt_b)):
            ends = np.append(0, np.cumsum(pc.take(sizes, pa.array(flat)).to_numpy()))
            cuts = ends[np.append(0, np.cumsum(n))]
            joined = pc.take(table, pa.array(flat)).buffers()[2].to_pybytes()[:cuts[-1]] if len(flat) else b""
            if joined != whole or (np.diff(cuts) != size).any():
                sound &= np.array([joined[x:y] == body for x, y, body in zip(cuts, cuts[1:], bodies, strict=False)], bool)
        start = np.cumsum(n_a + n_b + 2) - (n_a + n_b + 2)
        out = np.empty(int((n_a + n_b + 2).sum()), np.int32)
        out[start], out[start + 1] = sound, n_a
        out[np.repeat(start + 2 - (np.cumsum(n_a) - n_a), n_a) + np.arange(len(flat_a))] = flat_a
        out[np.repeat(start + 2 + n_a - (np.cumsum(n_b) - n_b), n_b) + np.arange(len(flat_b))] = flat_b
        data, at = out.tobytes(), (4 * np.append(start, len(out))).tolist()
        return [data[x:y] for x, y in zip(at, at[1:], strict=False)]

    def units(self, distinct: list[str]) -> tuple[pa.LargeListArray, pa.LargeListArray, np.ndarray]:
        """Both sides' ids of each unit, and whether they spell it."""
        found = [self.young.get(u) or self.old.get(u) for u in distinct]
        new = [u for u, f in zip(distinct, found, strict=True) if f is None]
        if new:
            made = dict(zip(new, self.fresh(new), strict=True))
            found = [made[u] if f is None else f for u, f in zip(distinct, found, strict=True)]
        self.young.update((u, f) for u, f in zip(distinct, found, strict=True) if len(u) <= KEPT_LENGTH)
        if len(self.young) > KEPT:
            self.young, self.old = {}, self.young
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, start = np.frombuffer(b"".join(found), np.int32), np.cumsum(size) - size
        n_a = flat[start + 1].astype(np.int64)
        place = np.arange(len(flat)) - np.repeat(start + 2, size)
        is_a = (place >= 0) & (place < np.repeat(n_a, size))
        is_b = place >= np.repeat(n_a, size)
        lists = [pa.LargeListArray.from_arrays(pa.array(np.append(0, np.cumsum(n))), pa.array(flat[mine]))
                 for n, mine in ((n_a, is_a), (size - 2 - n_a, is_b))]
        return lists[0], lists[1], flat[start] > 0

    def spelled(self, text: str) -> bool:
        """Whether both sides' tokens of a whole text join to it."""
        a, b, _ = self.units(self.cut(text))
        body = b" " + text.encode()
        return (b"".join(map(self.bytes_a.__getitem__, a.flatten().to_pylist())) == body
                and b"".join(map(self.bytes_b.__getitem__, b.flatten().to_pylist())) == body)


def _ends(lists: pa.LargeListArray, owner: np.ndarray, sizes: pa.Array, n: int):
    """``ids, doc, key`` of the tokens: the key is the document and the end in it."""
    ids = lists.flatten()
    doc = owner[pc.list_parent_indices(lists).to_numpy()]
    size = pc.take(sizes, ids)
    end = pc.cumulative_sum(size).to_numpy()
    first = np.searchsorted(doc, np.arange(n))  # tokens stand in the documents' order
    before = np.append(0, end)[first]
    return ids, doc, doc.astype(np.int64) << ENDS | (end - before[doc])


def align(pair: Pair, bodies: list[bytes]):
    """For each text ``n_a, n_b, n_groups, n_links`` and the groups' text (bytes; none
    without tokens), and the links of all in order (``id of a`` times the size of b plus ``id of b``)."""
    n = len(bodies)
    texts = []
    for body in bodies:
        try:
            texts.append(body.decode())
        except UnicodeDecodeError:
            texts.append("")
    split = [pair.cut(t) if t else [] for t in texts]
    counts = np.array([len(u) for u in split], np.int64)
    owner = np.repeat(np.arange(n), counts)
    coded = pa.array([u for units in split for u in units], pa.large_string()).dictionary_encode()
    a, b, sound = pair.units(coded.dictionary.to_pylist())
    at = coded.indices.to_numpy()
    if not sound.all():
        odd = np.unique(owner[~sound[at]])
        gone = [d for d in odd.tolist() if not pair.spelled(texts[d])]
        keep = ~np.isin(owner, gone)
        at, owner = at[keep], owner[keep]
    ids_a, doc_a, key_a = _ends(pc.take(a, pa.array(at)), owner, pair.size_a, n)
    ids_b, doc_b, key_b = _ends(pc.take(b, pa.array(at)), owner, pair.size_b, n)
    left = pa.table({"key": key_a, "a": ids_a, "i": np.arange(len(key_a))})
    right = pa.table({"key": key_b, "b": ids_b, "j": np.arange(len(key_b))})
    met = left.join(right, "key", join_type="inner", use_threads=False)
    order = np.argsort(met["key"].to_numpy(), kind="stable")
    key, i, j = (met[c].to_numpy()[order] for c in ("key", "i", "j"))
    links = met["a"].to_numpy()[order].astype(np.int64) * pair.n_b + met["b"].to_numpy()[order]
    del left, right, met

    n_a, n_b = np.bincount(doc_a, minlength=n), np.bincount(doc_b, minlength=n)
    n_links = np.bincount(key >> ENDS, minlength=n)
    new = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
    n_groups = np.bincount((key >> ENDS)[new], minlength=n)
    # a group's ids of a, then its ids of b: every token's place follows from how many tokens come before it
    end_a, end_b = np.zeros(len(key_a), bool), np.zeros(len(key_b), bool)
    end_a[i], end_b[j] = True, True
    group_a, group_b = np.cumsum(end_a) - end_a, np.cumsum(end_b) - end_b
    stop_a, stop_b = np.flatnonzero(end_a) + 1, np.flatnonzero(end_b) + 1
    place = np.empty(len(key_a) + len(key_b), np.int64)
    place[np.arange(len(key_a)) + np.append(0, stop_b)[group_a]] = ids_a.to_numpy() + np.where(end_a, pair.n_a, 0)
    place[np.arange(len(key_b)) + stop_a[group_b]] = 2 * pair.n_a + ids_b.to_numpy() + np.where(end_b, pair.n_b, 0)
    spelt = pc.take(pair.text, pa.array(place))
    offsets = np.frombuffer(spelt.buffers()[1], np.int64)[:len(spelt) + 1] if len(spelt) else np.zeros(1, np.int64)
    data = memoryview(spelt.buffers()[2]) if len(spelt) else memoryview(b"")
    cuts = offsets[np.append(0, np.cumsum(n_a + n_b))]
    groups = [data[x:y - 1] if y > x else None for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
    return n_a, n_b, n_groups, n_links, groups, links


@cache
def vocabularies(path_a: str, path_b: str) -> Pair:
    """One pair a worker process."""
    return Pair(path_a, path_b)


ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, chunk long, "
           "links binary, pairs array<long>, counts array<long>")


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row, in chunks: the figures of the document alone, its
    links as numbers into the chunk's table of pairs, and that table with the
    chunk's counts on its first row (pairs as in ``align``)."""
    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                         F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary").alias("body"))

    def table(chunk: int, parts: list) -> pa.RecordBatch:
        ids, n_a, n_b, n_groups, n_links, digest, links = (
            [x for p in parts for x in p[k]] if k in (0, 5) else np.concatenate([p[k] for p in parts]) for k in range(7))
        found = pa.table({"pair": links}).group_by("pair").aggregate([([], "count_all")])
        pairs = found["pair"].combine_chunks()
        kind = np.dtype("<u2" if len(pairs) <= 1 << 16 else "<u4")
        number = pc.index_in(pa.array(links), value_set=pairs).to_numpy().astype(kind)
        cuts = np.append(0, np.cumsum(n_links)).tolist()
        none = [None] * (len(ids) - 1)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)), pa.array(digest, pa.string()),
             pa.array([chunk] * len(ids), pa.int64()), pa.array([number[x:y].tobytes() for x, y in zip(cuts, cuts[1:], strict=False)], pa.binary()),
             pa.array([pairs.to_pylist(), *none], pa.list_(pa.int64())), pa.array([found["count_all"].to_pylist(), *none], pa.list_(pa.int64()))],
            names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "chunk", "links", "pairs", "counts"])

    def run(batches):
        pair = vocabularies(path_a, path_b)
        chunk, parts, ids, bodies, held, total = TaskContext.get().partitionId() << 32, [], [], [], 0, 0

        def settle():
            n_a, n_b, n_groups, n_links, groups, links = align(pair, bodies)
            digest = ["" if g is None else hashlib.sha256(g).hexdigest() for g in groups]
            parts.append((list(ids), n_a, n_b, n_groups, n_links, digest, links))
            ids.clear()
            bodies.clear()

        for batch in batches:
            for doc, body in zip(batch.column("doc_id").to_pylist(), batch.column("body"), strict=True):
                ids.append(doc)
                bodies.append(body.as_py())
                held += len(bodies[-1]) + 64
                if held >= SLICE:
                    settle()
                    total, held = total + held, 0
                    if total >= CHUNK:
                        yield table(chunk, parts)
                        chunk, parts, total = chunk + 1, [], 0
        if ids:
            settle()
        if parts:
            yield table(chunk, parts)

    return narrow.mapInArrow(run, ALIGNED)


def pair_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """``pair, n, best``: the links of each pair in all documents, and whether no
    pair with the same id of b has more."""
    each = rows.where(F.col("pairs").isNotNull()).select(F.explode(F.arrays_zip("pairs", "counts")).alias("x"))
    total = each.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.counts").alias("n"))
    total = total.withColumn("b", F.col("pair") % size_b)
    most = total.groupBy("b").agg(F.max("n").alias("most"))
    return total.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def cross_align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    Texts that are null, empty or not spelled by both sides' tokens have zeros
    and an empty ``groups_sha256``. Null ids and repeated rows keep their rows
    (and each counts). An empty table gives no rows; other columns are not read.
    The aligned rows are written once under the shared folder."""
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    rows = materialize(aligned(docs, path_a, path_b, id_col, text_col), "aligned")
    counts = pair_counts(rows, size_b)
    asked = rows.where(F.col("pairs").isNotNull()).select(F.col("chunk").alias("of"), F.posexplode("pairs").alias("number", "pair"))
    answers = asked.join(counts, "pair").select("of", "number", "n", "best")
    plain = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]

    def judge(group, found):
        n = np.zeros(len(found), np.int64)
        best = np.zeros(len(found), np.int64)
        number = found["number"].to_numpy()
        n[number], best[number] = found["n"].to_numpy(), found["best"].to_numpy(zero_copy_only=False)
        n_best, total = [], []
        for links, size in zip(group["links"].to_pylist(), group["n_links"].to_pylist(), strict=True):
            at = np.frombuffer(links, f"<u{len(links) // size}") if size else np.zeros(0, np.int64)
            n_best.append(int(best[at].sum()))
            total.append(int(n[at].sum()))
        return pa.table([*(group[c] for c in plain), pa.array(n_best, pa.int64()), pa.array(total, pa.int64()), group["groups_sha256"]],
                        names=[*plain, "n_best", "count_sum", "groups_sha256"])

    return (rows.select(*plain, "groups_sha256", "chunk", "links").groupBy("chunk").cogroup(answers.groupBy("of"))
            .applyInArrow(judge, ", ".join(f"{c} long" for c in [*plain, "n_best", "count_sum"]) + ", groups_sha256 string"))
