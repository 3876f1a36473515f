"""Spark results equal their DuckDB SQL twins (names, types, values) on sf0.001
for a representative set of queries from every layer."""
import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from txwatch.sources.testdata import TABLES

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import oracle_check as O  # noqa: E402

NAMES = ["alerts_by_typology", "gold_features", "dedup_dead", "dead_letter", "summary_kpis",
         "daily_stats", "score_histogram", "risk_levels", "batch_lookup", "alert_status_current",
         "threshold_sweep", "auc_roc", "auc_pr", "gate_silver", "rules_gold", "contract_rules",
         "long_window_features", "sender_velocity_sliding", "sender_baseline_trailing",
         "unified_union", "incremental_seen_rows"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_twin_matches(spark, con, name):
    sdf = E.queries()[name](spark, SF001)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    dtypes = dict(zip(rel.columns, rel.types))
    assert all(O.spark_type(f.dataType) == O.duck_type(dtypes[f.name]) for f in sdf.schema.fields)
    cols = sorted(sdf.columns)
    a = O.rows_of([r.asDict() for r in sdf.collect()], cols, 12)
    b = O.rows_of([dict(zip(rel.columns, r)) for r in rel.fetchall()], cols, 12)
    assert a == b
