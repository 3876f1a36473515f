"""Keep-first dedup: reasons and layout independence."""
import pytest
from pyspark.sql import functions as F

from txwatch.operators import ingest as I
from txwatch.operators import standardize as ST

ROWS = [
    # id, chunk, ordinal
    ("a", 0, 1), ("a", 0, 2),            # intra
    ("b", 0, 3), ("b", 1, 1),            # inter
    ("c", 1, 5), ("c", 1, 2), ("c", 2, 1),  # first is (1,2); (1,5) intra; (2,1) inter
    ("d", 2, 9),
]


@pytest.mark.parametrize("parts", [1, 8])
def test_reasons(spark, parts):
    df = spark.createDataFrame(ROWS, "transaction_id string, chunk_id int, ord int").repartition(parts)
    got = {(r.transaction_id, r.chunk_id, r.ord): r.dead_reason
           for r in ST.mark_duplicates(df, order_cols=["ord"]).collect()}
    assert got == {
        ("a", 0, 1): None, ("a", 0, 2): "intra_chunk_duplicate",
        ("b", 0, 3): None, ("b", 1, 1): "inter_chunk_duplicate",
        ("c", 1, 2): None, ("c", 1, 5): "intra_chunk_duplicate", ("c", 2, 1): "inter_chunk_duplicate",
        ("d", 2, 9): None}


def test_hot_id_many_copies(spark):
    rows = [("hot", i % 3, i) for i in range(3000)] + [("x", 0, 0)]
    df = spark.createDataFrame(rows, "transaction_id string, chunk_id int, ord int")
    kept, dead = ST.dedup(df, ["ord"])
    assert sorted((r.transaction_id, r.ord) for r in kept.collect()) == [("hot", 0), ("x", 0)]
    counts = {r.dead_reason: r["count"] for r in dead.groupBy("dead_reason").count().collect()}
    assert counts == {"intra_chunk_duplicate": 2997, "inter_chunk_duplicate": 2}


def test_dead_letter_split(spark):
    rows = [(1.0, "a", "b"), (None, "a", "b"), (-1.0, "a", "b"), (0.0, None, "b"), (0.0, "a", None)]
    df = spark.createDataFrame(rows, "`Amount Paid` double, Account_sender string, Account_receiver string")
    clean, dead = I.split_dead_letter(df)
    assert clean.count() == 1 and dead.count() == 4


def test_incremental_split(spark):
    pub = spark.createDataFrame([("a",), ("b",)], "transaction_id string")
    new = spark.createDataFrame([("b", 1), ("c", 2)], "transaction_id string, v int")
    unseen, seen = ST.incremental_split(new, pub)
    assert [r.transaction_id for r in unseen.collect()] == ["c"]
    assert [r.transaction_id for r in seen.collect()] == ["b"]


def test_packed_ordinal_orders_like_the_tuple(spark):
    import itertools
    rows = [(a, b, c) for a, b, c in itertools.product([0, 7, 123456789012], [0, 9], [0, 5, 99999])]
    df = spark.createDataFrame(rows, "a long, b long, c long")
    key = ST.packed_ordinal([("a", 0), ("b", 1), ("c", 5)])
    got = [tuple(r)[:3] for r in df.select("a", "b", "c", key.alias("k")).orderBy("k").collect()]
    assert got == sorted(rows)
    plan = df.groupBy("a").agg(F.min(key))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_sample_rows_layout_independent(spark):
    df = spark.range(20000).selectExpr("cast(id as string) as k")
    a = {r.k for r in I.sample_rows(df.repartition(1), 0.15, key="k").collect()}
    b = {r.k for r in I.sample_rows(df.repartition(7), 0.15, key="k").collect()}
    assert a == b and 2500 < len(a) < 3500
    assert I.sample_rows(df, 1.0).count() == 20000


@pytest.mark.parametrize("places", [1, 1 << 28])
def test_rows_that_are_written_once_get_the_same_marks(spark, places):
    """Only ids that may come again are compared; a taken place costs work, never a row."""
    rows = ROWS + [(f"u{i}", i % 3, i) for i in range(200)] + [(None, 0, 1), (None, None, 2), ("n", None, 1), ("a", None, 9)]
    df = spark.createDataFrame(rows, "transaction_id string, chunk_id int, ord int")
    kept = []

    def keep(part):
        kept.append(part.localCheckpoint())
        return kept[-1]

    got = ST.mark_duplicates_kept(df, keep, order_cols=["ord"], places=places)
    want = ST.mark_duplicates(df, order_cols=["ord"])
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert kept[0].count() == len(rows)
    if places > 1:
        assert kept[1].count() < 20
