"""Building, writing and reading the star; SQL over it; all checks on it."""

from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from recurra.plans import quality, views
from recurra.plans.build import build_star, build_summary, register_star
from recurra.schemas import RAW_EVENT, STAR, enforce_schema, with_load_time
from recurra.sources.billing import BillingInputs
from recurra.sources.warehouse import (
    EVENTS, insert_absent, month_slice, read_table, register, run_sql_file, write_table,
)


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    inputs = BillingInputs(spark, f"{DATA}/sf0.001")
    return build_star(spark, inputs, str(tmp_path_factory.mktemp("star")), 1995, 2001)


def test_declared_columns_and_counts(star):
    for name, schema in STAR.items():
        assert [c for c in star[name].columns if c not in ("event_year", "event_month")] == schema.names
    counts = {r["table_name"]: r["rows"] for r in build_summary(star).collect()}
    assert counts["dim_subscription_plan"] == 7 and counts[EVENTS] == 1500
    assert counts["dim_date"] == 3287


def test_all_checks_pass_on_the_built_star(star):
    failed = [tuple(r) for r in quality.run_checks(star).collect() if r["violations"]]
    assert failed == []


def test_checks_find_nulls_and_events_outside_the_ranges(star):
    def failed(changed, months=None):
        found = quality.run_checks({**star, **changed}, months).where("violations > 0").collect()
        return {r["check_name"]: r["violations"] for r in found}

    lost = star["dim_users"].withColumn("email", F.when(F.col("user_sk") > 3, F.col("email")))
    assert failed({"dim_users": lost}) == {"declared columns present": 1}
    late = star[EVENTS].where("event_timestamp >= DATE '1998-01-01'").count()
    assert late and failed({}, (date(1900, 1, 1), date(1998, 1, 1))) == {
        "events within the ranges": late
    }


def test_declared_columns_hold_no_nulls(star):
    for name, schema in STAR.items():
        assert quality.declared_nulls(star[name], schema).count() == 0


def test_month_reads_one_folder(star):
    june = month_slice(star[EVENTS], 1998, 6)
    plan = june._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_year" in plan
    assert len(june.inputFiles()) > 0
    files = {r[0] for r in june.select(F.input_file_name()).distinct().collect()}
    assert all("event_year=1998/event_month=06" in f for f in files)
    span = june.agg(F.min("event_timestamp"), F.max("event_timestamp")).first()
    assert datetime(1998, 6, 1) <= span[0] <= span[1] < datetime(1998, 7, 1)


def test_months_only_replaces_only_those_months(spark, star, tmp_path):
    events = star[EVENTS].drop("event_year", "event_month")
    write_table(events, str(tmp_path), EVENTS)
    again = month_slice(events, 1998, 6).withColumn("quantity", F.lit(2))
    write_table(again, str(tmp_path), EVENTS, months_only=True)
    back = read_table(spark, str(tmp_path), EVENTS)
    assert back.count() == 1500
    assert back.where("quantity = 2").count() == again.count()


def test_sql_over_registered_names(spark, star, tmp_path):
    register_star(star)
    register({"raw_billing": BillingInputs(spark, f"{DATA}/sf0.001", amounts=False).events})
    assert spark.sql("SELECT * FROM raw_billing").count() == 1500
    weekends = spark.sql(
        "SELECT event_type, sum(quantity) AS n FROM fact_subscription_events"
        " WHERE date_sk IN (SELECT date_sk FROM dim_date WHERE is_weekend) GROUP BY event_type"
    ).collect()
    by_hand = Counter(
        r.event_type for r in star[EVENTS].collect() if r.event_timestamp.weekday() >= 5
    )
    assert {r.event_type: r.n for r in weekends} == by_hand
    path = tmp_path / "kpi.sql"
    path.write_text("SELECT count(*) AS n FROM vw_customer_journey WHERE user_id <> :who;")
    assert run_sql_file(spark, str(path), who="nobody").first()["n"] == 1500
    assert spark.table("vw_active_subscriptions").count() > 0
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        spark.sql("SELECT * FROM no_such_table").collect()


def test_journey_over_the_stored_star_with_hot_versions(star, hot_limit):
    tables = star[EVENTS], star["dim_users"], star["dim_subscription_plan"], star["dim_date"]
    plain = {tuple(r) for r in views.customer_journey(*tables).collect()}
    hot_limit(4)
    assert {tuple(r) for r in views.customer_journey(*tables).collect()} == plain
    assert len(plain) == 1500


def test_insert_absent(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "x"), (3, "c")], "k int, v string")
    rows = insert_absent(old, new, "k").orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, "a"), (2, "b"), (3, "c")]


def test_defaults_and_load_time(spark):
    given = spark.createDataFrame(
        [("e", "u", "plan_free", "signup", datetime(2023, 1, 1))],
        "event_id string, user_id string, plan_id string, event_type string, "
        "event_timestamp timestamp_ntz")
    loaded = with_load_time(enforce_schema(given, RAW_EVENT), F.lit("2023-02-01"))
    row = loaded.first()
    assert row["quantity"] == 1 and row["net_amount_usd"] == 0
    assert row["created_at"] == datetime(2023, 2, 1)
    with pytest.raises(ValueError, match="user_id"):
        enforce_schema(given.drop("user_id"), RAW_EVENT)


def test_checks_return_the_broken_rows(spark, star):
    users, snap = star["dim_users"], star["fact_monthly_financial_snapshot"]
    # A second copy of everything, a day later: duplicates, overlaps and two currents.
    doubled = users.unionByName(
        users.withColumn("start_date", F.col("start_date") + F.expr("interval 1 day")))
    assert quality.duplicate_keys(doubled, ["user_sk"]).count() == users.count()
    assert quality.not_one_current(doubled).count() == 150
    assert quality.broken_continuity(doubled).count() > 0
    assert quality.not_one_current(users.where("NOT is_current")).where(
        "current_versions = 0").count() > 0
    no_end = users.withColumn("end_date", F.lit(None).cast("timestamp_ntz"))
    assert quality.expired_without_end(no_end).count() == users.where("NOT is_current").count()
    early = users.withColumn("end_date", F.lit(datetime(1990, 1, 1) - timedelta(days=1)))
    assert quality.ends_before_start(early).count() == users.count()
    assert quality.orphans(star[EVENTS], users.limit(0), "user_sk").count() > 0
    off = snap.withColumn("arr_usd", F.col("arr_usd") + 1)
    assert quality.arr_not_twelve_mrr(off).count() == snap.count()
    more = snap.withColumn("new_mrr_usd", F.col("new_mrr_usd") + 1)
    months = snap.select("snapshot_month_sk").distinct().count()
    assert quality.waterfall_gaps(more).count() == months
    falling = snap.withColumn("cumulative_revenue_usd", -F.col("cumulative_revenue_usd"))
    assert quality.falling_revenue(falling).count() > 0


def test_checks_scan_a_fact_once_per_key(star):
    plan = quality.run_checks(star)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    # Besides the pass over the rows: key and user of events, user version and user of months.
    assert sum(EVENTS in line for line in scans) == 2
    assert sum("fact_monthly_financial_snapshot" in line for line in scans) == 2


def test_checks_count_repeated_keys_once(star):
    snapshot = star["fact_monthly_financial_snapshot"]
    thrice = snapshot.unionByName(snapshot).unionByName(snapshot.where("snapshot_sk % 2 = 0"))
    found = {r[0]: r[1] for r in quality.run_checks(
        {**star, "fact_monthly_financial_snapshot": thrice}).collect()}
    assert found["snapshot per month and user unique"] == snapshot.count()
    empty = {name: df.limit(0) for name, df in star.items()}
    assert {r[1] for r in quality.run_checks(empty, (date(2000, 1, 1), date(2001, 1, 1))).collect()} == {0}
