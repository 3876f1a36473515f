"""Pages and lookups equal a full sort and filter, and open as few files late as early."""
import random

import pytest
from pyspark.sql import functions as F

from txwatch.operators.clustered import ClusteredLayer


@pytest.fixture(scope="module")
def layer(spark, tmp_path_factory):
    rng = random.Random(3)
    rows = [(-rng.choice([0.1, 0.4, 0.65, 0.9]), f"id{i:04d}", i) for i in range(1000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "rank double, alert_id string, n int")
    out = ClusteredLayer(spark, str(tmp_path_factory.mktemp("layer") / "alerts"), ("rank", "alert_id"))
    out.write(df, rows_per_file=100)
    return out, sorted(rows)


def test_all_pages_in_order_and_few_files_for_each(layer):
    out, rows = layer
    assert out.index().count() == 10
    after, got, opened = None, [], []
    while True:
        opened.append(len(out.page_files(after, 70)))
        page = out.page(after, 70)
        part = [tuple(r) for r in page.collect()]
        if not part:
            break
        got += part
        after = out.cursor(page)
    assert got == rows and max(opened) <= 3 and opened[12] <= opened[1] + 1


def test_a_lookup_opens_one_file(layer):
    out, rows = layer
    for r in (rows[0], rows[517], rows[-1]):
        assert len(out.lookup_files(r[:2])) == 1
        assert [tuple(x) for x in out.lookup(r[:2]).collect()] == [r]
    assert out.lookup((-0.4, "nowhere")).count() == 0


def test_ties_nulls_and_empty(spark, tmp_path):
    rows = [(None, "a"), (1, "a"), (1, "a"), (1, "b"), (2, None), (2, "c")]
    out = ClusteredLayer(spark, str(tmp_path / "x"), ("k", "v"))
    out.write(spark.createDataFrame(rows, "k int, v string"), rows_per_file=2)
    assert out.lookup((1, "a")).count() == 2
    first = out.page(None, 3)
    assert [tuple(r) for r in first.collect()] == [(None, "a"), (1, "a"), (1, "a")]
    assert [tuple(r) for r in out.page(out.cursor(first), 9).collect()] == [(1, "b"), (2, None), (2, "c")]
    none = ClusteredLayer(spark, str(tmp_path / "none"), ("k",))
    none.write(spark.createDataFrame([], "k int"))
    assert none.page(None, 5).count() == 0 and none.cursor(none.page(None, 5)) is None
    with pytest.raises(ValueError):
        none.page(None, 0)


def test_the_index_is_small(layer):
    out, rows = layer
    assert out.index().agg(F.sum("n")).first()[0] == len(rows)
