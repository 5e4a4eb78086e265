"""Registered queries against their DuckDB oracle on the smallest test tables.

One key per operator family; ``tools/check_oracle.py`` runs all of them.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from cardlens.plans.compare import compare, duckdb_connection
from tests.conftest import SF_SMALL

KEYS = ["features", "csv_ingest", "source_row_count", "inline_values", "dynamic_projection",
        "column_prune", "rename_projection", "tx_summary", "card_aggregates", "fraud_summary",
        "fraud_hourly", "share_of_total", "sort_desc", "quality_report", "schema_test_suite",
        "stratified_split_exact", "standard_scale", "classification_metrics", "roc_auc",
        "feature_vector", "fn_round", "table_row_count"]


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(entry.queries()[key](spark, SF_SMALL), entry.oracle_sql()[key], con)
    assert r["columns_match"] and r["match"], r
