"""KPI edge cases the generated data does not reach."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from recurra.functions.money import dollars_text, percent_text
from recurra.plans import kpis, rollups, views
from recurra.schemas import FACT_SNAPSHOT, MONEY
from samples import PAID, event, raw_events


def snapshot(spark, rows):
    """Rows of (month, user, active, mrr, churned)."""
    full = [
        (i, month, date(month // 100, month % 100, 28), i, user, 1, active, Decimal(mrr),
         Decimal(mrr * 12), Decimal(0), Decimal(0), Decimal(0), Decimal(churned), Decimal(0),
         Decimal(0), Decimal(0))
        for i, (month, user, active, mrr, churned) in enumerate(rows)
    ]
    return spark.createDataFrame(full, FACT_SNAPSHOT)


def test_cohort_offsets_across_years(spark):
    snap = snapshot(spark, [
        (202211, "u", True, 10, 0), (202212, "u", True, 10, 0), (202301, "u", True, 20, 0),
        (202301, "v", True, 5, 0), (202302, "v", False, 0, 5),
    ])
    found = [
        (r["cohort_month_sk"], r["month_offset"], r["active_users"], r["net_dollar_retention_ndr_pct"])
        for r in kpis.cohort_retention(snap).collect()
    ]
    assert found == [(202211, 0, 1, 100.0), (202211, 1, 1, 100.0), (202211, 2, 1, 200.0),
                     (202301, 0, 1, 100.0), (202301, 1, 0, 0.0)]
    matrix = views.cohort_matrix(kpis.cohort_retention(snap), range(4)).collect()
    assert {r["cohort_month_sk"]: (r["m0"], r["m2"], r["m3"]) for r in matrix} == {
        202211: (100.0, 100.0, None), 202301: (100.0, None, None)}


def test_month_without_losses_has_no_quick_ratio(spark):
    snap = snapshot(spark, [(202301, "u", True, 10, 0), (202302, "u", True, 10, 0)])
    metrics = kpis.saas_metrics(snap).collect()
    assert [r["month_id"] for r in metrics] == [202302]
    assert metrics[0]["saas_quick_ratio"] is None
    assert metrics[0]["net_revenue_retention_nrr_pct"] == 100.0
    head = kpis.headline(snap).first()
    assert (head["month_id"], head["previous_ending_mrr"]) == (202302, Decimal(10))


def test_start_is_the_previous_month_present(spark):
    snap = snapshot(spark, [(202301, "u", True, 10, 0), (202304, "u", True, 15, 0)])
    assert [r["starting_mrr"] for r in kpis.mrr_waterfall(snap).collect()] == [0, 10]


def test_display_text(spark):
    row = spark.sql("SELECT 1234.5 AS a, CAST(NULL AS DOUBLE) AS b, 12.34 AS c").select(
        dollars_text(F.col("a")), dollars_text(F.col("b")), percent_text(F.col("c")),
        percent_text(F.col("b"))).first()
    assert tuple(row) == ("$1,234.50", "$0.00", "12.3%", "0.0%")


def test_dunning_needs_a_strictly_later_payment_in_time(spark):
    events = raw_events(spark, [
        event("a", "2023-01-01", "payment_failed"), event("a", "2023-01-01", PAID, 0, 1),
        event("a", "2023-01-03", PAID, 0, 2),
        event("b", "2023-01-01", "payment_failed"),
        event("b", datetime(2023, 1, 3, 0, 0, 1), PAID, 0, 3),
        event("c", "2023-01-01", "payment_failed"),
    ])
    found = {r["user_id"]: r["recovered_usd"] for r in rollups.dunning_recovery(events).collect()}
    assert found == {"a": Decimal("2.00"), "b": None, "c": None}
    summary = rollups.dunning_summary(rollups.dunning_recovery(events)).first()
    assert tuple(summary) == (3, 1, Decimal("2.00"), 33.33)


def test_ltv_without_churn_is_null(spark):
    users = spark.sql("""SELECT 1L AS user_sk, 'u' AS user_id, 'pro' AS subscription_tier,
        'x' AS acquisition_channel, 'DE' AS country, true AS is_current, 'active' AS account_status""")
    events = spark.createDataFrame(
        [(1, datetime(2023, 1, 1), Decimal(10)), (1, datetime(2023, 3, 4, 23), Decimal(20))],
        "user_sk long, event_timestamp timestamp_ntz, net_amount_usd decimal(12,2)")
    row = kpis.ltv_by_tier(users, events).first()
    assert row["modeled_ltv_usd"] is None and row["tier_churn_rate_pct"] == 0.0
    assert row["realized_arpu_per_customer_usd"] == 30.0 and row["avg_tenure_months"] == 2.0
    assert MONEY.precision == 12
