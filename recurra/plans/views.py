"""Views and report shapes on top of the star and the KPIs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from recurra.functions.money import count_text, dollars_text, percent_text
from recurra.operators.hotkeys import HotKeys, lookup
from recurra.operators.ordered import RunningSum, ordered


def active_subscriptions(users: DataFrame, events: DataFrame, plans: DataFrame,
                         as_of: Column | None = None) -> DataFrame:
    """Current active users whose current version has events, with its latest plan and
    what that version has paid."""
    today = F.current_date() if as_of is None else as_of
    # Latest plan and totals in one pass, combined before the shuffle.
    per_version = events.groupBy("user_sk").agg(
        F.max_by("plan_sk", F.struct("event_timestamp", "event_id")).alias("plan_sk"),
        F.sum("net_amount_usd").alias("paid"),
        F.count_if(F.col("event_type") == "invoice_paid").alias("invoices"),
    )
    return (
        users.where(F.col("is_current") & (F.col("account_status") == "active"))
        .join(per_version, "user_sk")
        .join(
            plans.select("plan_sk", "plan_code", "plan_name", "billing_interval",
                         "base_price_usd"),
            "plan_sk",
        )
        .select(
            "user_id", "email", "country", "acquisition_channel", "subscription_tier",
            "account_status", "plan_code", "plan_name", "billing_interval",
            F.col("base_price_usd").alias("current_plan_price"),
            F.col("start_date").alias("tier_effective_date"),
            F.datediff(today, F.to_date("start_date")).alias("days_on_current_tier"),
            F.coalesce("paid", F.lit(0)).alias("lifetime_paid_amount_usd"),
            F.col("invoices").alias("total_successful_invoices"),
        )
    )


def customer_journey(events: DataFrame, users: DataFrame, plans: DataFrame,
                     dates: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Every event of every user in order, with running MRR, cash and a sequence number."""
    missing = [c for c in ("user_id", "email") if c not in events.columns]
    if missing:
        versions = hot.of_finer(["user_sk"]) if hot is not None else None
        events = lookup(events, users.select("user_sk", *missing), "user_sk", hot=versions)
    joined = (
        events.join(plans.select("plan_sk", "plan_name", "billing_interval"), "plan_sk")
        .join(dates.select("date_sk", "calendar_date"), "date_sk")
        .select(
            "event_id", "user_id", "email", "event_timestamp", "calendar_date", "event_type",
            "plan_name", "billing_interval", "net_amount_usd", "mrr_delta_usd",
        )
    )
    return (
        ordered(joined, ["user_id"], ["event_timestamp", "event_id"], hot)
        .scan(
            running_user_mrr_usd=RunningSum(F.col("mrr_delta_usd")),
            cumulative_cash_collected_usd=RunningSum(F.col("net_amount_usd")),
            event_sequence_number=RunningSum(F.lit(1)),
        )
        .frame()
    )


def cohort_matrix(retention: DataFrame, offsets: Sequence[int] | None = None) -> DataFrame:
    """Retention rates with one row per cohort and one column ``m<offset>`` per offset.

    Without ``offsets`` there is a column for each up to the highest; finding that runs
    ``retention`` once more, so pass the offsets where the months are known.
    """
    if offsets is None:
        highest = retention.agg(F.max("month_offset")).first()[0]
        offsets = range(0 if highest is None else highest + 1)
    cells = retention.groupBy("cohort_month_sk").pivot("month_offset", list(offsets)).agg(
        F.first("user_retention_rate_pct")
    )
    return cells.select(
        "cohort_month_sk", *[F.col(f"`{k}`").alias(f"m{k}") for k in offsets]
    )


def trailing(monthly: DataFrame, months: int = 12) -> DataFrame:
    """The last ``months`` rows of a monthly KPI, in time order."""
    return monthly.orderBy(F.desc("month_id")).limit(months).orderBy("month_id")


def first_rows(df: DataFrame, keys: Sequence[str], rows: int = 25) -> DataFrame:
    return df.orderBy(*keys).limit(rows)


def waterfall_report(waterfall: DataFrame) -> DataFrame:
    """Trailing twelve months of the waterfall as display text."""
    money = ["starting_mrr", "new_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr",
             "ending_mrr", "ending_arr"]
    return trailing(waterfall).select(
        F.col("month_id").cast("string").alias("month"),
        *[dollars_text(F.col(c)).alias(c) for c in money],
        count_text(F.col("active_subscribers")).alias("active_users"),
        percent_text(F.col("mrr_growth_rate_pct")).alias("mom_growth"),
    )


def metrics_report(metrics: DataFrame) -> DataFrame:
    """Trailing twelve months of the efficiency metrics as display text."""
    return trailing(metrics).select(
        F.col("month_id").cast("string").alias("month"),
        dollars_text(F.col("arpa_usd")).alias("arpa"),
        F.coalesce(F.format_number("saas_quick_ratio", 2), F.lit("-")).alias("quick_ratio"),
        percent_text(F.col("gross_revenue_churn_pct")).alias("gross_revenue_churn"),
        percent_text(F.col("net_revenue_retention_nrr_pct")).alias("net_revenue_retention"),
        percent_text(F.col("logo_churn_pct")).alias("logo_churn"),
    )


def ltv_report(ltv: DataFrame) -> DataFrame:
    """Unit economics per tier as display text."""
    return ltv.select(
        F.upper("subscription_tier").alias("tier"),
        count_text(F.col("total_customers")).alias("total_customers"),
        count_text(F.col("churned_customers")).alias("churned"),
        dollars_text(F.col("aggregate_tier_revenue_usd")).alias("tier_revenue"),
        dollars_text(F.col("realized_arpu_per_customer_usd")).alias("realized_arpu"),
        F.format_number("avg_tenure_months", 1).alias("avg_tenure"),
        percent_text(F.col("tier_churn_rate_pct")).alias("churn_rate"),
        dollars_text(F.col("modeled_ltv_usd")).alias("modeled_ltv"),
    )


def mrr_movement_long(waterfall: DataFrame) -> DataFrame:
    """One row per month and movement; what reduces MRR is negative."""
    signed = waterfall.select(
        "month_id",
        "snapshot_date",
        F.col("new_mrr").alias("new"),
        F.col("expansion_mrr").alias("expansion"),
        (-F.col("contraction_mrr")).alias("contraction"),
        (-F.col("churned_mrr")).alias("churned"),
        F.col("ending_mrr").alias("ending"),
    )
    return signed.unpivot(
        ["month_id", "snapshot_date"],
        ["new", "expansion", "contraction", "churned", "ending"],
        "component", "amount_usd",
    )


def charted_ltv(ltv: DataFrame) -> DataFrame:
    """Tiers with a positive modelled lifetime value."""
    return ltv.where(F.col("modeled_ltv_usd") > 0).select("subscription_tier", "modeled_ltv_usd")
