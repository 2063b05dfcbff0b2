"""Registered queries against DuckDB; all of them with TURNOUT_FULL=1."""

import os

import pytest

import __spark_entry__ as contract
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
QUICK = [
    "master_join", "clean_registrations", "typed_frame", "participation_grid", "positives_only",
    "merge_all_predictions", "temporal_split", "temporal_split_by_series", "rank_bar",
    "popularity_rank_bar", "prediction_describe", "top_k_per_person", "audience_gender_share",
    "event_summary", "first_repeat_spread", "events_of_interest_compat", "read_metric_ledger",
]
NAMES = sorted(contract.oracle_sql()) if os.environ.get("TURNOUT_FULL") else QUICK


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, con, name):
    assert compare(contract.queries()[name](spark, SF), con, contract.oracle_sql()[name]) is None


def test_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())
