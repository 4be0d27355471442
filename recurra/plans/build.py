"""Building the whole star from billing inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recurra.operators.hotkeys import HotKeys
from recurra.plans.dimensions import date_dimension, plan_dimension, users_dimension
from recurra.plans.facts import events_fact, monthly_snapshot
from recurra.plans.views import active_subscriptions, customer_journey
from recurra.sources.billing import BillingInputs
from recurra.sources.warehouse import (
    export_star, read_star, read_table, register, row_counts, write_table,
)


def build_star(spark: SparkSession, inputs: BillingInputs, root: str,
               start_year: int = 2023, end_year: int = 2025,
               calendar: tuple[str, str] | None = None) -> dict[str, DataFrame]:
    """Build and write all five tables under ``root``; returns them as read back.

    Each table is written before the next one is built on it, so that a lost executor
    never sets the build back by more than one table.
    """
    first, last = calendar or (f"{start_year - 1}-01-01", f"{end_year + 1}-12-31")
    hot = inputs.hot_users
    export_star(
        {
            "dim_date": date_dimension(spark, first, last),
            "dim_subscription_plan": plan_dimension(spark),
            "dim_users": users_dimension(inputs.user_states, hot),
        },
        root,
    )
    users = read_table(spark, root, "dim_users")
    plans = read_table(spark, root, "dim_subscription_plan")
    # Numbering has already cut the events into stretches of time.
    write_table(events_fact(inputs.events, users, plans, hot), root, "fact_subscription_events",
                time_sliced=True)
    events = read_table(spark, root, "fact_subscription_events")
    write_table(
        monthly_snapshot(events, users, start_year, end_year, hot),
        root, "fact_monthly_financial_snapshot",
    )
    return read_star(spark, root)


def register_star(star: dict[str, DataFrame], hot: HotKeys | None = None) -> None:
    """Register the tables and both views for SQL; pass the ``hot`` users when they are known."""
    users, plans = star["dim_users"], star["dim_subscription_plan"]
    events = star["fact_subscription_events"]
    register(star)
    register({
        "vw_active_subscriptions": active_subscriptions(users, events, plans),
        "vw_customer_journey": customer_journey(events, users, plans, star["dim_date"], hot),
    })


def build_summary(star: dict[str, DataFrame]) -> DataFrame:
    return row_counts(star)
