"""That tasks do not grow with the tables, and that what is costly is made once."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from recurra.operators import hotkeys
from recurra.operators.hotkeys import find_hot_keys
from recurra.operators.ordered import RunningSum, ordered
from recurra.plans import kpis, quality
from recurra.plans.dimensions import plan_dimension, users_dimension
from recurra.plans.facts import monthly_snapshot, monthly_states, resolved_events
from recurra.plans.stored import StoredUsers
from recurra.session import stage
from samples import (
    PAID, event, loop_snapshot, one_state_per_user, raw_events, snapshot_rows, state, states,
)


def tasks(df):
    return df.groupBy(F.spark_partition_id()).count().count()


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(hotkeys, "TASK_ROWS", 20)


def billed(spark):
    return [
        event(f"u{i:03}", datetime(2023, 1 + (i + k) % 12, 1 + k), PAID, 29, 29, event_id=f"{i}-{k}")
        for i in range(100) for k in range(4)
    ]


def test_scans_by_key_take_as_many_tasks_as_rows_need(spark, small_tasks):
    rows = spark.range(400).select((F.col("id") % 100).alias("user_id"), F.col("id").alias("at"))
    hot = find_hot_keys(rows, ["user_id"])
    assert not hot and hot.partitions == 20
    summed = ordered(rows, ["user_id"], ["at"], hot).scan(n=RunningSum(F.lit(1)))
    again = summed.scan(m=RunningSum(F.col("n"))).frame()
    assert tasks(again) > 10 and exchanges(again) == 1
    assert {r[0] for r in again.groupBy("user_id").agg(F.max("m")).select("max(m)").collect()} == {10}


def test_cohorts_and_checks_keep_the_tasks_of_the_states(spark, small_tasks):
    """Their windows take the months of few users a task (F2, F3, F4, F5)."""
    events = raw_events(spark, billed(spark))
    hot = find_hot_keys(events, ["user_id"])
    plans = plan_dimension(spark).select("plan_id", "plan_sk")
    found = monthly_states(events.join(plans, "plan_id"), 2023, 2023, hot=hot)
    assert tasks(found) > 10
    before = exchanges(found)
    assert exchanges(quality.falling_revenue(found)) == before
    assert kpis.cohort_retention(found).agg(F.max("cohort_users_month_0")).first()[0] > 0


def test_snapshot_of_many_tasks_is_numbered_in_order(spark, small_tasks):
    events = billed(spark)
    users = users_dimension(one_state_per_user(spark, events))
    fact = stage(resolved_events(raw_events(spark, events), users, plan_dimension(spark)), "fact")
    got = monthly_snapshot(fact, users, 2023, 2023)
    assert snapshot_rows(got) == loop_snapshot(events, 2023, 2023)
    rows = got.select("snapshot_month_sk", "user_id", "snapshot_sk").collect()
    assert [r.snapshot_sk for r in sorted(rows)] == list(range(1, len(rows) + 1))


def test_merge_reads_its_batch_once(spark, tmp_path):
    stored = StoredUsers(spark, str(tmp_path))
    stored.create(users_dimension(states(spark, [state("a", "2023-01-01", "pro", "active")])), 4)
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(user):
        read.add(1)
        return user

    batch = states(spark, [
        state("a", "2023-02-01", "free", "canceled"), state("b", "2023-02-01", "pro", "active"),
    ])
    stored.merge(batch.withColumn("user_id", seen("user_id")))
    assert read.value == 2
    assert stored.read().count() == 3
