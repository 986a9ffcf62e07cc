"""The registered queries against their SQL on the smallest input."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from tests.compare import DATA, database, difference, spark_result, sql_result

# Whole pipelines and further reports over the daily audit trail; ``python tests/compare.py`` runs them too.
LONG = {
    "silver_build_incremental", "silver_klines_incremental", "state_upsert", "dq_gate", "load_state", "gold_build",
    "quality_dataset_health", "quality_latest_status", "quality_failed_datasets", "quality_status_counts",
    "dashboard_kpis", "observability_report", "serving_snapshot", "dashboard_datasets", "dq_run_incremental", "stream_late_trades",
}
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return database("0.001")


def test_every_sql_has_its_query():
    assert ORACLES.keys() <= contract.queries().keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES.keys() - LONG))
def test_query_equals_sql(spark, connection, name):
    actual = spark_result(contract.queries()[name](spark, f"{DATA}/sf0.001"))
    assert difference(actual, sql_result(connection, ORACLES[name])) is None


@pytest.mark.parametrize("missing", ["ahocorasick", "tokenizers", "zstandard", "xxhash", "sentencepiece", "public_tokenizers", "numpy"])
def test_market_queries_outlive_a_missing_library(missing):
    code = (
        f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; from candlewick.registry.queries import QUERIES; "
        "from candlewick.registry.oracles import oracle_sql; assert QUERIES.keys() <= e.queries().keys() and oracle_sql().keys() <= e.oracle_sql().keys()"
    )
    root = Path(__file__).resolve().parent.parent
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=100, check=False)
    assert done.returncode == 0, done.stderr
