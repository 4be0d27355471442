"""Event roll-ups, and recovery of failed payments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recurra.functions.money import rounded
from recurra.operators.hotkeys import HotKeys
from recurra.operators.ordered import Later, ordered
from recurra.sources.warehouse import month_slice


def month_rollup(events: DataFrame, year: int, month: int) -> DataFrame:
    """Events, revenue and mean MRR delta per event type in one calendar month."""
    return (
        month_slice(events, year, month)
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.sum("net_amount_usd").alias("total_revenue"),
            F.sum("mrr_delta_usd").alias("delta"),
        )
        .select(
            "event_type", "event_count", "total_revenue",
            (F.col("delta").cast("double") / F.col("event_count")).alias("avg_mrr_delta"),
        )
    )


def quarterly_plan_revenue(events: DataFrame, dates: DataFrame, plans: DataFrame,
                           users_as: str, revenue_as: str) -> DataFrame:
    """Distinct paying user versions and revenue per quarter and plan.

    Both dimensions are small enough for Spark to broadcast; the distinct count is spread
    over (group, version) before it comes down to the groups.
    """
    return (
        events.join(dates.select("date_sk", "year", "quarter_name"), "date_sk")
        .join(plans.select("plan_sk", "plan_name"), "plan_sk")
        .groupBy("year", "quarter_name", "plan_name")
        .agg(
            F.countDistinct("user_sk").alias(users_as),
            F.sum("net_amount_usd").alias(revenue_as),
        )
    )


def annual_plan_revenue(events: DataFrame, dates: DataFrame, plans: DataFrame,
                        year: int) -> DataFrame:
    """Revenue by quarter and plan of one year; the year also prunes the fact by time."""
    start = F.lit(f"{year}-01-01").cast("timestamp_ntz")
    end = F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")
    ts = F.col("event_timestamp")
    in_year = events.where((ts >= start) & (ts < end))
    if "event_year" in events.columns:
        in_year = in_year.where(F.col("event_year") == year)
    return quarterly_plan_revenue(in_year, dates, plans, "paying_users", "quarterly_revenue")


def paid_revenue_top(events: DataFrame, dates: DataFrame, plans: DataFrame,
                     rows: int = 15) -> DataFrame:
    """Paid-invoice revenue by quarter and plan, latest and largest first."""
    paid = events.where(F.col("event_type") == "invoice_paid")
    return (
        quarterly_plan_revenue(paid, dates, plans, "total_paying_users", "total_revenue_usd")
        .orderBy(F.desc("year"), F.desc("quarter_name"), F.desc("total_revenue_usd"), "plan_name")
        .limit(rows)
    )


def dunning_recovery(events: DataFrame, days: int = 2, hot: HotKeys | None = None) -> DataFrame:
    """Failed payments with the user's next paid invoice, if it came within ``days``.

    The next invoice is read off one ordered scan per user. At equal times payments sort
    first, so that only strictly later ones are found.
    """
    failed = F.col("event_type") == "payment_failed"
    relevant = events.where(failed | (F.col("event_type") == "invoice_paid")).select(
        "user_id", "event_id", "event_timestamp", "event_type", "net_amount_usd",
        failed.alias("failed"),
    )
    payment = F.struct("event_id", "event_timestamp", "net_amount_usd")
    next_paid: Column = F.col("next_paid")
    within = next_paid["event_timestamp"] <= F.col("event_timestamp") + F.make_dt_interval(
        F.lit(days)
    )
    return (
        ordered(relevant, ["user_id"], ["event_timestamp", "failed", "event_id"], hot)
        .scan(next_paid=Later(F.when(~failed, payment)))
        .frame()
        .where("failed")
        .withColumn("next_paid", F.when(within, next_paid))
        .select(
            "user_id",
            F.col("event_id").alias("failed_event_id"),
            F.col("event_timestamp").alias("failed_at"),
            next_paid["event_id"].alias("recovery_event_id"),
            next_paid["event_timestamp"].alias("recovered_at"),
            next_paid["net_amount_usd"].alias("recovered_usd"),
            next_paid.isNotNull().alias("is_recovered"),
        )
    )


def dunning_summary(recovery: DataFrame) -> DataFrame:
    return recovery.agg(
        F.count(F.lit(1)).alias("failures"),
        F.count_if(F.col("is_recovered")).alias("recovered"),
        F.sum("recovered_usd").alias("recovered_usd"),
    ).withColumn(
        "recovery_rate_pct",
        rounded(F.col("recovered") / F.nullif(F.col("failures"), F.lit(0)) * 100.0),
    )
