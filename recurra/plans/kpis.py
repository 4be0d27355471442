"""Revenue KPIs over the monthly snapshot and the event fact.

(month, user) is unique in the snapshot, so users are counted with conditional sums; the
monthly windows run over one row per month, after the aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from recurra.functions.calendar import months_of_sk
from recurra.functions.money import percent, ratio, rounded

_MONTH = ["snapshot_month_sk", "snapshot_date"]
_ACTIVE = "is_active_subscriber"
METRICS = ["arpa_usd", "saas_quick_ratio", "gross_revenue_churn_pct",
           "net_revenue_retention_nrr_pct", "logo_churn_pct"]


def _monthly(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy(*_MONTH).agg(
        F.sum("mrr_usd").alias("ending_mrr"),
        F.sum("arr_usd").alias("ending_arr"),
        F.sum("new_mrr_usd").alias("new_mrr"),
        F.sum("expansion_mrr_usd").alias("expansion_mrr"),
        F.sum("contraction_mrr_usd").alias("contraction_mrr"),
        F.sum("churned_mrr_usd").alias("churned_mrr"),
        F.sum("net_mrr_movement_usd").alias("net_mrr_movement"),
        F.count_if(_ACTIVE).alias("active_subscribers"),
        F.count_if(F.col("churned_mrr_usd") > 0).alias("churned_subscribers"),
    )


def monthly_kpis(snapshot: DataFrame) -> DataFrame:
    """All monthly figures in one pass; the starting values are those of the previous
    month present, NULL in the first."""
    months = Window.orderBy("month_id")
    start, ending = F.col("starting_mrr"), F.col("ending_mrr")
    gained = F.col("new_mrr") + F.col("expansion_mrr")
    lost = F.col("churned_mrr") + F.col("contraction_mrr")
    return (
        _monthly(snapshot)
        .withColumnRenamed("snapshot_month_sk", "month_id")
        .withColumns({
            "starting_mrr": F.lag("ending_mrr").over(months),
            "starting_subscribers": F.lag("active_subscribers").over(months),
        })
        .withColumns({
            "mrr_growth_rate_pct": percent(ending - start, start),
            "arpa_usd": ratio(ending, F.col("active_subscribers")),
            "saas_quick_ratio": ratio(gained, lost),
            "gross_revenue_churn_pct": percent(F.col("churned_mrr"), start),
            "net_revenue_retention_nrr_pct": percent(
                start + F.col("expansion_mrr") - lost, start
            ),
            "logo_churn_pct": percent(
                F.col("churned_subscribers"), F.col("starting_subscribers")
            ),
        })
    )


def mrr_waterfall(snapshot: DataFrame) -> DataFrame:
    """Per month: MRR at the start, its movements, MRR at the end and growth."""
    return (
        monthly_kpis(snapshot)
        .withColumn("starting_mrr", F.coalesce("starting_mrr", F.lit(0)))
        .select(
            "month_id", "snapshot_date", "starting_mrr", "new_mrr", "expansion_mrr",
            "contraction_mrr", "churned_mrr", "net_mrr_movement", "ending_mrr", "ending_arr",
            "active_subscribers", "mrr_growth_rate_pct",
        )
        .orderBy("month_id")
    )


def saas_metrics(snapshot: DataFrame) -> DataFrame:
    """Per month with starting MRR: ARPA, quick ratio, revenue and logo churn, NRR."""
    return (
        monthly_kpis(snapshot)
        .where(F.col("starting_mrr") > 0)
        .select("month_id", "snapshot_date", "ending_mrr", "active_subscribers", *METRICS)
        .orderBy("month_id")
    )


def headline(snapshot: DataFrame) -> DataFrame:
    """The latest month's figures and the ending MRR of the month before it."""
    figures = ["ending_mrr", "ending_arr", "active_subscribers", "net_mrr_movement",
               "mrr_growth_rate_pct"]
    ratios = [m for m in METRICS if m != "logo_churn_pct"]
    measured = F.when(F.col("starting_mrr") > 0, F.col("month_id"))
    latest = monthly_kpis(snapshot).agg(
        F.max_by(F.struct("month_id", "starting_mrr", *figures), "month_id").alias("now"),
        F.max_by(F.struct(*ratios), measured).alias("measured"),
    )
    return latest.select(
        "now.month_id",
        *[f"now.{c}" for c in figures],
        F.coalesce("now.starting_mrr", "now.ending_mrr").alias("previous_ending_mrr"),
        *[f"measured.{c}" for c in ratios],
    )


def cohort_retention(snapshot: DataFrame) -> DataFrame:
    """Users and MRR still active per first-active-month cohort and month offset.

    One shuffle by user finds the cohort (a user has one row per month, so the window
    is short); everything after that works on cohort x month rows.
    """
    user = Window.partitionBy("user_id")
    first_active = F.min(F.when(F.col(_ACTIVE), F.col("snapshot_month_sk"))).over(user)
    activity = (
        snapshot.select("user_id", *_MONTH, "is_active_subscriber", "mrr_usd")
        .withColumn("cohort_month_sk", first_active)
        .where(F.col("snapshot_month_sk") >= F.col("cohort_month_sk"))
        .groupBy("cohort_month_sk", "snapshot_month_sk")
        .agg(
            F.count_if(_ACTIVE).alias("active_users"),
            F.sum(F.when(F.col(_ACTIVE), F.col("mrr_usd")).otherwise(0)).alias("active_mrr"),
        )
    )
    cohort = Window.partitionBy("cohort_month_sk")
    at_start = F.col("snapshot_month_sk") == F.col("cohort_month_sk")
    offset = months_of_sk(F.col("snapshot_month_sk")) - months_of_sk(F.col("cohort_month_sk"))
    return (
        activity.withColumns({
            "month_offset": offset,
            "cohort_users_month_0": F.max(F.when(at_start, F.col("active_users"))).over(cohort),
            "cohort_mrr_month_0": F.max(F.when(at_start, F.col("active_mrr"))).over(cohort),
        })
        .select(
            "cohort_month_sk",
            "month_offset",
            F.col("snapshot_month_sk").alias("active_calendar_month"),
            "cohort_users_month_0",
            "active_users",
            percent(F.col("active_users"), F.col("cohort_users_month_0")).alias(
                "user_retention_rate_pct"
            ),
            "cohort_mrr_month_0",
            "active_mrr",
            percent(F.col("active_mrr"), F.col("cohort_mrr_month_0")).alias(
                "net_dollar_retention_ndr_pct"
            ),
        )
        .orderBy("cohort_month_sk", "month_offset")
    )


def ltv_by_tier(users: DataFrame, events: DataFrame) -> DataFrame:
    """Revenue, tenure, churn and modelled lifetime value per tier.

    A user counts in every tier one of its versions had, with that version's events.
    Events are summed per version first, so the join to users has no hot keys.
    """
    per_version = events.groupBy("user_sk").agg(
        F.min("event_timestamp").alias("first_ts"),
        F.max("event_timestamp").alias("last_ts"),
        F.sum("net_amount_usd").alias("revenue"),
    )
    gone = F.col("is_current") & (F.col("account_status") == "canceled")
    profile = ["user_id", "subscription_tier", "acquisition_channel", "country"]
    per_profile = (
        users.join(per_version, "user_sk")
        .groupBy(*profile)
        .agg(
            F.min("first_ts").alias("first_ts"),
            F.max("last_ts").alias("last_ts"),
            F.sum("revenue").alias("revenue"),
            F.max(gone).alias("gone"),
        )
    )
    # Whole 24-hour days, then an average month of 30.4375 days.
    days = F.expr("extract(day from (last_ts - first_ts))").cast("double")
    # A user with two profiles in one tier is one customer of it.
    per_user = per_profile.groupBy("subscription_tier", "user_id").agg(
        F.max("gone").alias("gone"),
        F.sum("revenue").alias("revenue"),
        F.sum(days).alias("days"),
        F.count(F.lit(1)).alias("profiles"),
    )
    customers, churned = F.col("total_customers"), F.col("churned_customers")
    revenue = F.col("aggregate_tier_revenue_usd")
    return (
        per_user.groupBy("subscription_tier")
        .agg(
            F.count(F.lit(1)).alias("total_customers"),
            F.count_if(F.col("gone")).alias("churned_customers"),
            F.sum("revenue").alias("aggregate_tier_revenue_usd"),
            F.sum("profiles").alias("profiles"),
            F.sum("days").alias("days"),
        )
        .withColumn("realized_arpu_per_customer_usd", ratio(revenue, F.col("profiles")))
        .select(
            "subscription_tier",
            "total_customers",
            "churned_customers",
            "aggregate_tier_revenue_usd",
            "realized_arpu_per_customer_usd",
            rounded(F.col("days") / F.col("profiles") / F.lit(30.4375), 1).alias(
                "avg_tenure_months"
            ),
            percent(churned, customers).alias("tier_churn_rate_pct"),
            rounded(
                F.col("realized_arpu_per_customer_usd")
                / F.nullif(churned.cast("double") / customers.cast("double"), F.lit(0.0))
            ).alias("modeled_ltv_usd"),
        )
        .orderBy(F.desc("aggregate_tier_revenue_usd"))
    )
