"""Registered queries against their SQL statements on the smallest tables.

The default run takes a selection that covers every module; ``ALL_QUERIES=1``
takes all of them. ``check_queries.py`` does the same on any directory.
"""

from __future__ import annotations

import os

import pytest
from check_queries import compare, database

import __spark_entry__ as entry
from analogues.queries import queries as own_queries

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
SELECTION = (
    "source_window_scan", "validity_filters", "open_terminals", "approved_transactions", "daily_movements",
    "daily_establishment_activity_valid", "authorisation_summary", "trailing_months_deflated",
    "establishment_activity", "address_unified", "address_latest", "establishment_features_rows",
    "reference_universe", "per_terminal_activity_rows", "installed_base_joined", "days_to_activation",
    "establishment_label_rows", "principal_features_rows", "cohort_features", "radius_neighbours",
    "neighbour_stats", "read_period",
)
NAMES = list(own_queries()) if os.environ.get("ALL_QUERIES") else SELECTION
#: Queries that write relations for their later steps; they must run where the checkpoint folder is a mounted one.
WRITING = (
    "activation_levels",
    "activation_target",
    "activation_target_rows",
    "address_latest_bucketed",
    "address_unified",
    "cohort_features",
    "establishment_activity_rolled",
    "establishment_features",
    "establishment_features_dated",
    "establishment_features_rows",
    "establishment_universe",
    "establishment_universe_dated",
    "geo_features",
    "ingest_job",
    "ingest_repeated",
    "latest_features",
    "model_table",
    "neighbour_stats",
    "owner_days",
    "per_terminal_activity",
    "per_terminal_activity_rows",
    "principal_features",
    "principal_features_rows",
    "radius_neighbours",
)


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    result = compare(name, spark, con, SF)
    assert result.startswith("ok") and "TYPES" not in result, result


@pytest.mark.parametrize("name", WRITING)
def test_writing_query_on_a_cluster_with_a_mounted_folder(spark, con, monkeypatch, name):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://h:7077")
    result = compare(name, spark, con, SF)
    assert result.startswith("ok") and "TYPES" not in result, result


def test_no_statement_without_query():
    assert set(SQL) <= set(entry.queries())
    assert set(own_queries()) <= set(SQL)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "vol_usd_w4" in df.columns
