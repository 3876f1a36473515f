"""The curve visits neighbours, shards are equal runs of it, and their boxes prune."""
import tempfile
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from txwatch.llm import sharding as S
from txwatch.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int, curve string, shard string"


@pytest.mark.parametrize("dims,bits", [(1, 5), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_each_cell_once_and_steps_to_neighbours(dims, bits):
    cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij")).reshape(dims, -1)
    at = S.hilbert(list(cells), bits)
    assert sorted(at) == list(range(1 << bits * dims))
    path = cells[:, np.argsort(at)]
    assert (np.abs(np.diff(path, axis=1)).sum(0) == 1).all()


def plain(rows, shards, bits):
    """``(doc_id, size, crc, shard, slot)`` of rows ``(doc_id, text, source, lang, n_chars)``."""
    n = len(rows)
    level = []
    for c in (2, 3, 4):
        counts = Counter(r[c] for r in rows)
        before, here = {}, 0
        for v in sorted(counts, key=lambda v: (v is not None, "" if v is None else v)) if c != 4 else \
                sorted(counts, key=lambda v: (v is not None, 0 if v is None else v)):
            before[v], here = (here << bits) // n, here + counts[v]
        level.append(np.array([before[r[c]] for r in rows]))
    curve = S.hilbert(level, bits) if n else []
    body = [(r[1] or "").encode() for r in rows]
    order = sorted(range(n), key=lambda i: (curve[i], rows[i][0] is not None, rows[i][0] or 0, len(body[i]) + 1, zlib.crc32(body[i])))
    small, more = divmod(n, shards)
    cuts = [k * small + min(k, more) for k in range(shards + 1)]
    out = []
    for rank, i in enumerate(order):
        shard = next(k for k in range(shards) if cuts[k] <= rank < cuts[k + 1])
        out.append((rows[i][0], len(body[i]) + 1, zlib.crc32(body[i]), shard, rank - cuts[shard]))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, n, 1, "c", "s") for i, t, source, lang, n in rows], SCHEMA)


def placed(spark, rows, **how):
    got = S.shard(frame(spark, rows).repartition(5), **how)
    return sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got.collect()), key=str)


@pytest.mark.parametrize("shards,bits", [(16, 10), (5, 2), (1, 1), (300, 10)])
def test_equals_a_plain_sort(spark, shards, bits):
    rng = np.random.default_rng(shards)
    rows = [(int(i), f"text {i} é", f"s{rng.integers(0, 7)}" if i % 3 else "hot", rng.choice(["a", "b", "ü", ""]), int(rng.integers(0, 50)))
            for i in range(217)]
    assert placed(spark, rows, shards=shards, bits=bits) == sorted(plain(rows, shards, bits), key=str)


def test_nulls_repeats_hot_values_and_few_rows(spark):
    rows = [(None, None, None, None, None)] * 3 + [(1, "", "", "x", 0)] + [(7, "same", "hot", "en", 4)] * 60 + [
        (i, "t" * i, "hot", "en", i) for i in range(40)] + [(99, "z" * 300_000, "w", None, 300_000)]
    assert placed(spark, rows) == sorted(plain(rows, 16, S.BITS), key=str)
    assert placed(spark, rows[:3]) == sorted(plain(rows[:3], 16, S.BITS), key=str)
    assert S.shard(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        S.shard(frame(spark, rows), bits=40)


def test_dates_and_numbers_as_dimensions(spark):
    docs = frame(spark, [(i, "t", "s", "l", i) for i in range(40)]).withColumn("day", F.expr("date'2024-01-01' + cast(39 - doc_id as int)"))
    got = S.shard(docs, dims=("day",), shards=4, bits=8).collect()
    assert [r.doc_id // 10 for r in sorted(got, key=lambda r: (r.shard, r.slot))] == [3] * 10 + [2] * 10 + [1] * 10 + [0] * 10


def test_written_shards_hold_all_rows_and_boxes_prune(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("shard", F.lit("own")).withColumn("a.b", F.lit(1))
    path = tempfile.mkdtemp(prefix="run-") + "/shards"
    boxes = S.write(docs, path)
    back = spark.read.parquet(path)
    assert back.count() == docs.count() and not back.select("doc.*").exceptAll(docs).count()
    sizes = [r.n_rows for r in boxes.collect()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) <= 1
    low, high = docs.agg(F.percentile("n_chars", 0.45), F.percentile("n_chars", 0.55)).first()
    for wanted in ({"source": ("src3", "src3")}, {"n_chars": (low, high)}, {"lang": ("en", "en")}):
        (c, (a, b)), = wanted.items()
        kept = {r.shard for r in S.prune(boxes, wanted).collect()}
        assert kept >= {int(r.shard) for r in back.where(F.col(f"doc.{c}").between(a, b)).select("shard").distinct().collect()}
    assert len({r.shard for r in S.prune(boxes, {"n_chars": (low, high)}).collect()}) < 16


def test_registered_query(spark):
    got = QUERIES["op12_hilbert_shards"](spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = plain([(r.doc_id, r.text, r.source, r.lang, r.n_chars) for r in docs], 16, S.BITS)
    assert sorted((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in got) == sorted(want)
