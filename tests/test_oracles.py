"""Every registered query against DuckDB, on plain and on skewed data."""

import pytest

import __spark_entry__ as registered
import oracle_queries
from compare import difference, duck
from conftest import DATA
from skewed import write_skewed

NAMES = sorted(oracle_queries.oracle_sql())

# Queries whose per-user scans take the sliced path once a user is hot.
SCANNED = ["mrr_deltas", "users_scd2", "scd2_merge", "asof_user_version", "billing_events",
           "monthly_snapshot", "customer_journey", "dunning_recovery", "dq_scd2_intervals",
           "invoice_pricing", "activity_journey", "scd2_merge_log", "scd2_merge_buckets",
           "asof_overlapping", "snapshot_extend"]


def test_every_query_has_an_oracle():
    own = {name.rstrip("_") for name in registered._QUERIES}
    assert set(NAMES) == own <= set(registered.queries())
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry_returns_months(spark):
    assert registered.entry(spark).count() > 12


@pytest.mark.parametrize("name", NAMES)
def test_query_matches(spark, name):
    folder = f"{DATA}/sf0.001"
    result = registered.queries()[name](spark, folder)
    assert difference(result, duck(folder), registered.oracle_sql()[name]) is None


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    return write_skewed(f"{DATA}/sf0.001", str(tmp_path_factory.mktemp("skewed")))


@pytest.mark.parametrize("name", SCANNED)
def test_query_matches_with_a_hot_user(spark, skewed, hot_limit, name):
    hot_limit(90)  # a third of the rows is one user: cut into several slices
    result = registered.queries()[name](spark, skewed)
    assert difference(result, duck(skewed), registered.oracle_sql()[name]) is None
