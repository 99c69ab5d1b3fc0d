"""Registered queries against their SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as registry  # noqa: E402
from tools.check_suite import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables are absent")

CHECKED = [
    "drift_feature_table", "drift_batches", "split_chronological", "split_stratified", "oversample",
    "swap_rows", "profile_numeric", "boxplot", "roc_points", "gate_regression", "response_action",
    "report_table", "production_view", "error_report", "contract_check", "inject_nulls",
    "stream_error_counts",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, con, name):
    df = registry.queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(registry.oracle_sql()[name])
    assert got == rows_of([d[0] for d in result.description], result.fetchall())


def test_every_sql_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    rows = registry.entry(spark).collect()
    assert len(rows) == 1 and rows[0].n_columns == 6
