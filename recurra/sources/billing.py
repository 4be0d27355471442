"""Billing inputs read from order tables: raw events and user states.

Orders stand for billing events, customers for users and line items for the invoice
amounts. What an order means depends on the user's earlier orders, so the events come
out of one ordered scan per user.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recurra.functions.pricing import monthly_mrr, tier_of
from recurra.operators.hotkeys import HotKeys, find_hot_keys, lookup
from recurra.operators.ordered import Earlier, First, ordered
from recurra.plans.dimensions import plan_dimension
from recurra.schemas import MONEY
from recurra.session import stage

# The plan an order priority stands for.
PLAN_OF_PRIORITY = {
    "1-URGENT": "plan_ent_m",
    "2-HIGH": "plan_pro_m",
    "3-MEDIUM": "plan_starter_m",
    "4-NOT SPECIFIED": "plan_starter_a",
    "5-LOW": "plan_pro_a",
}

# What a pending order of a priority stands for; all others are payments.
KIND_OF_PENDING = {
    "5-LOW": "cancellation",
    "4-NOT SPECIFIED": "payment_failed",
    "1-URGENT": "refund",
}

ORDER = ["event_timestamp", "event_id"]


class BillingInputs:
    """Raw billing events and user states of a folder of order tables.

    ``amounts=False`` leaves the line items unread and all amounts but the MRR delta
    zero; ``refunds=True`` gives refund events their negative net amount. ``written=True``
    writes what is asked for once, for those who read it several times.
    """

    def __init__(self, spark: SparkSession, folder: str, amounts: bool = True,
                 refunds: bool = False, written: bool = False):
        self._spark, self._folder = spark, folder
        self._amounts, self._refunds, self._written = amounts, refunds, written
        self._orders = _orders(spark, folder)

    @cached_property
    def hot_users(self) -> HotKeys:
        return find_hot_keys(self._orders, ["user_id"])

    @cached_property
    def events(self) -> DataFrame:
        if self._amounts:
            totals = _invoice_totals(self._spark, self._folder)
            billed = self._orders.join(
                totals, self._orders["o_orderkey"] == totals["l_orderkey"], "left"
            )
        else:
            nothing = {c: F.lit(0) for c in ("gross", "discount", "tax")}
            billed = self._orders.withColumns(nothing)
        events = _events(self._in_order(billed), self._refunds)
        return stage(events, "raw-events") if self._written else events

    @cached_property
    def user_states(self) -> DataFrame:
        profiles = customers(self._spark, self._folder)
        states = _states(self._in_order(self._orders), profiles, self.hot_users)
        return stage(states, "raw-states") if self._written else states

    def _in_order(self, orders: DataFrame) -> DataFrame:
        return _in_order(orders, plan_dimension(self._spark), self.hot_users)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    seconds = (F.col("o_orderkey") % 86400).cast("int")
    zero = F.lit(0)
    return table(spark, folder, "orders").select(
        F.concat(F.lit("usr_"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.concat(F.lit("evt_"), F.col("o_orderkey").cast("string")).alias("event_id"),
        (F.col("o_orderdate") + F.make_dt_interval(zero, zero, zero, seconds)).alias(
            "event_timestamp"
        ),
        "o_orderkey", "o_orderstatus", "o_orderpriority",
    )


def _in_order(orders: DataFrame, plans: DataFrame, hot: HotKeys) -> DataFrame:
    """Orders with kind, plan, MRR delta and the tier last paid for; an unknown priority
    fails the job."""
    priority = F.col("o_orderpriority")
    unknown = F.raise_error(
        F.concat(F.lit("no plan for priority "), F.coalesce(priority, F.lit("NULL")))
    ).cast("string")
    plan_id = F.coalesce(_mapped(priority, PLAN_OF_PRIORITY), unknown)
    priced = (
        orders.withColumn("plan_id", plan_id)
        .join(
            plans.select(
                "plan_id",
                monthly_mrr(F.col("base_price_usd"), F.col("billing_interval")).alias("mrr"),
                tier_of(F.col("plan_code")).alias("tier"),
            ),
            "plan_id", "left",
        )
    )
    # What an order is by itself; the first one of a user turns into the signup below.
    pending = F.when(
        F.col("o_orderstatus") == "P", _mapped(F.col("o_orderpriority"), KIND_OF_PENDING)
    )
    own = F.coalesce(pending, F.lit("paid"))
    paid, cancelled = F.col("own") == "paid", F.col("own") == "cancellation"
    # The MRR an event leaves behind; a cancellation ends the segment at zero.
    left = F.struct(
        "event_id",
        F.when(paid, F.col("mrr")).otherwise(F.lit(0)).cast(MONEY).alias("mrr"),
        paid.alias("open"),
    )
    scanned = (
        ordered(priced.withColumn("own", own), ["user_id"], ORDER, hot)
        .scan(
            first_id=First(F.col("event_id")),
            before=Earlier(F.when(paid | cancelled, left)),
            paid_before=Earlier(F.when(paid, F.struct("event_id", "tier"))),
        )
        .frame()
    )

    def unless_signup(earlier: str, field: str) -> Column:
        real = F.col(f"{earlier}.event_id") != F.col("first_id")
        return F.when(real, F.col(f"{earlier}.{field}"))

    signup = F.col("event_id") == F.col("first_id")
    held = F.coalesce(unless_signup("before", "mrr"), F.lit(0).cast(MONEY))
    return scanned.withColumns({
        "kind": F.when(signup, F.lit("signup")).otherwise(F.col("own")),
        "mrr_delta_usd": F.when(paid & ~signup, F.col("mrr") - held)
        .otherwise(F.lit(0)).cast(MONEY),
        "in_segment": F.coalesce(unless_signup("before", "open"), F.lit(False)),
        "tier_before": unless_signup("paid_before", "tier"),
    })


def _events(history: DataFrame, refunds: bool) -> DataFrame:
    kind, zero = F.col("kind"), F.lit(0).cast(MONEY)
    upgrade = F.col("in_segment") & (F.col("mrr_delta_usd") > 0)
    event_type = (
        F.when((kind == "paid") & upgrade, F.lit("upgrade"))
        .when(kind == "paid", F.lit("invoice_paid"))
        .otherwise(kind)
    )
    gross, discount, tax = (F.coalesce(F.col(c), zero) for c in ("gross", "discount", "tax"))
    net = F.when(kind == "paid", gross - discount)
    if refunds:
        net = net.when(kind == "refund", discount - gross)
    return history.select(
        "event_id",
        "user_id",
        "plan_id",
        event_type.alias("event_type"),
        F.lit(1).alias("quantity"),
        F.when(kind.isin("paid", "payment_failed"), gross)
        .otherwise(zero).cast(MONEY).alias("gross_amount_usd"),
        F.when(kind == "paid", discount).otherwise(zero).cast(MONEY).alias("discount_amount_usd"),
        F.when(kind == "paid", tax).otherwise(zero).cast(MONEY).alias("tax_amount_usd"),
        net.otherwise(zero).cast(MONEY).alias("net_amount_usd"),
        "mrr_delta_usd",
        "event_timestamp",
    )


def _states(history: DataFrame, profiles: DataFrame, hot: HotKeys) -> DataFrame:
    """One row per signup, payment and cancellation: the state it leaves the user in."""
    kind = F.col("kind")
    tier = (
        F.when(kind == "paid", F.col("tier"))
        .when(kind == "cancellation", F.coalesce(F.col("tier_before"), F.lit("free")))
        .otherwise(F.lit("free"))
    )
    status = (
        F.when(kind == "paid", F.lit("active"))
        .when(kind == "cancellation", F.lit("canceled"))
        .otherwise(F.lit("trial"))
    )
    states = history.where(kind.isin("signup", "paid", "cancellation")).select(
        "user_id",
        tier.alias("subscription_tier"),
        status.alias("account_status"),
        F.col("event_timestamp").alias("effective_ts"),
        F.col("event_id").alias("sequence"),
    )
    # A user without a profile keeps the states, with an empty profile.
    return lookup(states, profiles, "user_id", "left", hot=hot).select(
        "user_id", "email", "country", "acquisition_channel", "billing_currency",
        "subscription_tier", "account_status", "effective_ts", "sequence",
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """User profiles."""
    return (
        table(spark, folder, "customer")
        .join(
            table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
        )
        .select(
            F.concat(F.lit("usr_"), F.col("c_custkey").cast("string")).alias("user_id"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
            F.col("n_name").alias("country"),
            F.lower("c_mktsegment").alias("acquisition_channel"),
            F.lit("USD").alias("billing_currency"),
        )
    )


def priced_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with price, discount and tax in cents, cast before multiplying."""
    price = F.col("l_extendedprice").cast(MONEY)
    rate = F.col("l_discount").cast("decimal(4,2)")
    return (
        table(spark, folder, "lineitem")
        .select(
            "l_orderkey",
            price.alias("price"),
            (price * rate).cast(MONEY).alias("discount"),
            F.col("l_tax").cast("decimal(4,2)").alias("tax_rate"),
        )
        .withColumn(
            "tax", ((F.col("price") - F.col("discount")) * F.col("tax_rate")).cast(MONEY)
        )
    )


def _invoice_totals(spark: SparkSession, folder: str) -> DataFrame:
    return priced_lines(spark, folder).groupBy("l_orderkey").agg(
        F.sum("price").alias("gross"),
        F.sum("discount").alias("discount"),
        F.sum("tax").alias("tax"),
    )


def activity_events(spark: SparkSession, folder: str) -> DataFrame:
    """Billing-style events from the ``events`` table: errors are failed payments and
    purchases paid invoices; other kinds pass through."""
    kind = F.col("event_type")
    value = F.col("value").cast(MONEY)
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(kind == "error", F.lit("payment_failed"))
        .when(kind == "purchase", F.lit("invoice_paid"))
        .otherwise(kind).alias("event_type"),
        F.when(kind == "purchase", value).otherwise(F.lit(0)).cast(MONEY).alias("net_amount_usd"),
        value.alias("mrr_delta_usd"),
        F.col("ts").alias("event_timestamp"),
    )


def _mapped(value: Column, pairs: dict[str, str]) -> Column:
    chosen = F.lit(None).cast("string")
    for key, result in pairs.items():
        chosen = F.when(value == key, F.lit(result)).otherwise(chosen)
    return chosen
