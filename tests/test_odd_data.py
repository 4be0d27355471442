"""Data the order tables do not have: later years, unknown priorities, users without a profile."""

from datetime import datetime
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from compare import difference, duck
from conftest import DATA
from recurra.plans.dimensions import plan_dimension, users_dimension
from recurra.plans.facts import with_mrr_deltas
from recurra.plans.views import cohort_matrix
from recurra.schemas import SEQUENCED_STATE

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def folder_with(root: Path, **changed: str) -> str:
    """A copy of the smallest data in which the named tables are the given SELECTs."""
    con = duck(f"{DATA}/sf0.001")
    for name in TABLES:
        sql = changed.get(name, f"SELECT * FROM {name}")
        con.execute(f"COPY ({sql}) TO '{root}/{name}.parquet' (FORMAT parquet)")
    return str(root)


@pytest.fixture(scope="module")
def later(tmp_path_factory):
    """A tenth of the orders ten years on, and a tenth of the customers gone."""
    moved = (
        "SELECT * REPLACE (CASE WHEN o_orderkey % 10 = 0 THEN o_orderdate + INTERVAL 10 YEAR"
        " ELSE o_orderdate END AS o_orderdate) FROM orders"
    )
    kept = "SELECT * FROM customer WHERE c_custkey % 10 <> 0"
    return folder_with(tmp_path_factory.mktemp("later"), orders=moved, customer=kept)


@pytest.mark.parametrize("name", [
    "mrr_waterfall", "customer_journey", "star_sql", "users_scd2", "monthly_snapshot",
    "invoice_pricing", "table_row_counts", "scd2_merge",
])
def test_no_row_is_lost(spark, later, name):
    result = registered.queries()[name](spark, later)
    assert difference(result, duck(later), registered.oracle_sql()[name]) is None


def test_all_events_reach_the_journey(spark, later):
    assert registered.queries()["customer_journey"](spark, later).count() == 1500


def test_unknown_priority_fails_the_job(spark, tmp_path):
    odd = "SELECT * REPLACE (CASE WHEN o_orderkey % 7 = 0 THEN '9-NEW' ELSE o_orderpriority END"
    folder = folder_with(tmp_path, orders=f"{odd} AS o_orderpriority) FROM orders")
    with pytest.raises(Exception, match="no plan for priority 9-NEW"):
        registered.queries()["billing_events"](spark, folder).collect()
    with pytest.raises(duckdb.Error, match="no plan for priority"):
        duck(folder).execute(registered.oracle_sql()["billing_events"])


def test_payment_for_an_unknown_plan_fails_the_job(spark):
    events = spark.createDataFrame(
        [("e1", "u1", "no_such_plan", "invoice_paid", datetime(2024, 1, 1))],
        "event_id string, user_id string, plan_id string, event_type string,"
        " event_timestamp timestamp_ntz",
    ).withColumn("mrr_delta_usd", F.lit(0))
    with pytest.raises(Exception, match="unknown plan no_such_plan"):
        with_mrr_deltas(events, plan_dimension(spark)).collect()


def test_states_of_one_instant_follow_their_sequence(spark):
    at = datetime(2024, 1, 1)

    def state(tier, status, sequence):
        return ("u", "e", "c", "a", "USD", tier, status, at, sequence)

    for order in (("1", "2"), ("2", "1")):
        rows = [state("enterprise", "active", order[1]), state("free", "trial", order[0])]
        users = users_dimension(spark.createDataFrame(rows, SEQUENCED_STATE))
        current = [r.subscription_tier for r in users.where("is_current").collect()]
        assert current == (["enterprise"] if order == ("1", "2") else ["free"])


def test_matrix_has_every_cell_of_the_retention(spark):
    folder = f"{DATA}/sf0.001"
    cells = registered.queries()["cohort_retention"](spark, folder)
    for matrix in (registered.queries()["cohort_matrix"](spark, folder), cohort_matrix(cells)):
        rows = matrix.collect()
        filled = sum(v is not None for r in rows for k, v in r.asDict().items() if k[0] == "m")
        assert filled == cells.where("user_retention_rate_pct IS NOT NULL").count()
