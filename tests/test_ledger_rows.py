"""The ledger writes its rows once; bronze and silver are read back from that table."""
import pytest
from pyspark.sql import functions as F

from txwatch.operators import ingest as I
from txwatch.operators import quality as Q
from txwatch.operators import standardize as ST
from txwatch.plans import pipeline as PL
from txwatch.sources import testdata as TD

BRONZE = ("`Timestamp` string, Account_sender string, Account_receiver string, `Amount Received` double, "
          "`Amount Paid` double, `Payment Format` string")


def tables(spark, folder, n):
    """``n`` orders of up to seven lines, some keys null, missing or repeated."""
    ids = spark.range(n)
    null = F.lit(None).cast("long")
    orders = ids.select(F.when(F.col("id") % 41 == 7, null).otherwise(F.col("id")).alias("o_orderkey"),
                        F.when(F.col("id") % 53 == 5, null).otherwise(F.col("id") % 60).alias("o_custkey"))
    cust = spark.range(58).select(F.col("id").alias("c_custkey"), F.when(F.col("id") != 3, (F.col("id") % 25).cast("int")).alias("c_nationkey"))
    supp = spark.range(10).select(F.col("id").alias("s_suppkey"), (F.col("id") % 25).cast("int").alias("s_nationkey"))
    supp = supp.unionByName(supp.where("s_suppkey = 4"))
    lines = ids.select("id", F.explode(F.sequence(F.lit(1), (F.col("id") % 7 + 1).cast("int"))).alias("l_linenumber")).select(
        F.col("id").alias("l_orderkey"), (F.col("id") * 37 % 500).alias("l_partkey"), (F.col("id") % 11).alias("l_suppkey"), "l_linenumber",
        F.when(F.col("id") % 29 != 3, F.round(F.col("id") * 13.37 % 9000, 2)).alias("l_extendedprice"),
        F.when(F.col("id") % 31 != 3, F.col("id") % 11 / 100).alias("l_discount"),
        F.when(F.col("id") % 23 != 3, F.when(F.col("id") % 2 == 0, "R").otherwise("N")).alias("l_returnflag"))
    for name, df in (("orders", orders), ("customer", cust), ("supplier", supp), ("lineitem", lines)):
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("n", [600, 0])
def test_rows_are_written_once_and_read_the_same(spark, tmp_path, monkeypatch, n):
    sf, written, wrote = tables(spark, tmp_path, n), {}, PL.materialize

    def count(df, name, *args, **more):
        out = wrote(df, name, *args, **more)
        written[name] = written.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(PL, "materialize", count)
    kept, plain = PL.Ledger(spark, sf), PL.Ledger(spark, sf, persist=False)
    for layer in ("bronze", "clean", "dead_letter", "standardized", "_dedup", "silver", "silver_dead"):
        a, b = getattr(kept, layer), getattr(plain, layer)
        assert a.columns == b.columns and [f.dataType for f in a.schema] == [f.dataType for f in b.schema], layer
        assert rows(a) == rows(b), layer
    if n:
        assert kept.silver_dead.count() > 0 and kept.dead_letter.count() > 0
    # all rows once; of silver only those whose id may come again
    assert written.pop("bronze") == kept.bronze.count()
    again = kept._dedup.groupBy("transaction_id").count().where("count > 1").agg(F.sum("count")).first()[0] or 0
    assert sum(written.values()) <= 2 * again + 1 and (n == 0 or again < kept.bronze.count() / 2)


def test_layer_drift_builds_both_layers_from_one_table(spark, tmp_path, monkeypatch):
    sf, names, wrote = tables(spark, tmp_path, 300), [], PL.materialize
    monkeypatch.setattr(PL, "materialize", lambda df, name, *a, **k: (names.append((name, df.columns)), wrote(df, name, *a, **k))[1])
    kept, plain = PL.Ledger(spark, sf), PL.Ledger(spark, sf, persist=False)
    assert rows(Q.layer_drift(kept.bronze, kept.silver)) == rows(Q.layer_drift(plain.bronze, plain.silver))
    assert [name for name, _ in names] == ["bronze", "silver-again", "silver-again"]
    assert "Amount Received" not in names[0][1] and set(names[1][1]) == {"_row", "_bits"}


def test_stored_rows_give_back_the_raw_columns(spark):
    """Every form of a time, junk, nulls; only bad rows have no hash."""
    times = ["2022-09-01 00:00:00", "2022/09/01 00:00:00", "2022-09-01 00:00", "2022-09-01T10:11:12", "2022-09-01 10:11:12.5",
             "2022-09-01 10:11:12.500000", "0001-01-01 00:00:00", "2022-03-27 02:30:00", "not a time", "", None]
    raw = spark.createDataFrame([(t, s, "r", a, a, f) for t in times for s, a, f in (("s", 1.5, "Wire"), ("t", -0.0, None), (None, 2.0, "x"), ("u", None, "y"))], BRONZE)
    stored = ST.to_stored(raw, I.is_bad_row(ts_text=None), TD.SAME)
    assert "Amount Received" not in stored.columns
    assert stored.where(F.col("Timestamp") == "2022-09-01 00:00:00").count() == 0
    back = ST.from_stored(stored.localCheckpoint(), raw.columns, TD.SAME)
    assert rows(back.drop(ST.TIME, ST.BAD, ST.HASH)) == rows(raw)
    clean, dead = I.split_dead_letter(raw)
    assert rows(back.where(~F.col(ST.BAD)).select(*raw.columns)) == rows(clean)
    assert rows(back.where(F.col(ST.BAD)).select(*raw.columns)) == rows(dead)
    assert back.where(F.col(ST.HASH).isNull() != F.col(ST.BAD)).count() == 0
    ids = clean.select(ST.bronze_id(clean).alias("transaction_id"))
    assert rows(back.where(~F.col(ST.BAD)).select(ST.HASH)) == rows(ids.select(ST.id_hash().alias(ST.HASH)))


def test_lines_move_what_bronze_takes(spark, tmp_path):
    """The label is made before the lines move; flag and discount stay behind."""
    sf = tables(spark, tmp_path, 300)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = TD.ledger_bronze(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    above = [line for line in plan.splitlines() if "_label" in line and "l_returnflag" not in line]
    assert above and "l_returnflag" not in plan.split("Join", 1)[0]
