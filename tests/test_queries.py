"""The registered queries against DuckDB on the smallest tables (all of them: tools/verify.py)."""

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "orders", "lineitem")
SAMPLE = (
    "enrollment_mart", "weighted_score", "check_duplicate_keys", "numeric_profile",
    "score_boxplot_by_group", "risk_by_engagement_quartile", "risk_metrics", "temporal_holdout",
    "scoring_frame", "knn_score",
)

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the driver tables")


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    yield connection
    connection.close()


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_is_the_mart(spark):
    assert contract.entry(spark).count() == 733


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql_without_cross_join(spark, engine, name):
    df = contract.queries()[name](spark, FOLDER)
    result = engine.execute(contract.oracle_sql()[name])
    columns = [item[0] for item in result.description]
    assert sorted(df.columns) == sorted(columns)
    names = sorted(columns)
    theirs = sorted(
        repr(tuple(row[columns.index(c)] for c in names)) for row in result.fetchall()
    )
    assert sorted(repr(tuple(row[c] for c in names)) for row in df.collect()) == theirs
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", plan)
