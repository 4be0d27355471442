
from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

import oracle_queries
from recurra.functions.calendar import index_of
from recurra.functions.pricing import monthly_mrr, price_invoice, tier_of
from recurra.operators.asof import resolve_plan_sk, resolve_versions
from recurra.operators.ordered import RunningSum, ordered
from recurra.operators.overlap import resolve_first
from recurra.plans import kpis, quality, rollups, views
from recurra.plans.build import build_star, register_star
from recurra.plans.dimensions import (
    date_dimension, merge_users, plan_dimension, users_dimension,
)
from recurra.plans.facts import (
    end_of_month, events_fact, monthly_snapshot, monthly_states, number_events, resolved_events,
    with_mrr_deltas,
)
from recurra.plans.stored import StoredSnapshot, StoredUsers, append_once
from recurra.schemas import RAW_EVENT
from recurra.session import shared_dir, stage
from recurra.sources import console
from recurra.sources.billing import BillingInputs, activity_events, customers, table
from recurra.sources.parts import DEFAULT, RangeTable, month_ranges
from recurra.sources.warehouse import (
    EVENTS, PARTITIONED_BY, insert_absent, next_number, read_table, register, register_between,
    report, rewrite_table, row_counts, run_sql_file, slice_name, write_table,
)

SLICES = date(1996, 1, 1), date(2000, 1, 1)
AS_OF = date(2002, 1, 1)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _comparable(build(spark, sf_dir))

    _QUERIES[build.__name__] = run
    return build


def _comparable(df: DataFrame) -> DataFrame:
    """Plain output types: BIGINT, DOUBLE, VARCHAR and BOOLEAN."""

    def plain(field: T.StructField):
        value, kind = F.col(field.name), field.dataType
        if isinstance(kind, T.DecimalType):
            value = value.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType)):
            value = value.cast("bigint")
        elif isinstance(kind, T.DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        elif isinstance(kind, T.TimestampNTZType):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return value.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


# --- inputs shared by the queries -------------------------------------------------------


def _states(spark: SparkSession, sf_dir: str, refunds: bool = False) -> DataFrame:
    """Monthly states; the revenue KPIs need neither user versions nor numbers."""
    inputs = BillingInputs(spark, sf_dir, refunds=refunds)
    events = resolve_plan_sk(inputs.events, plan_dimension(spark))
    return monthly_states(events, *_years(spark, sf_dir), hot=inputs.hot_users)


def _years(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """The first and the last year of the billing events."""
    span = table(spark, sf_dir, "orders").agg(
        F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))
    ).first()
    return (1970, 1970) if span[0] is None else (span[0], span[1])


def _keyed(spark: SparkSession, sf_dir: str, columns=("user_sk",)):
    """Billing inputs, user dimension and events with their user version."""
    inputs = BillingInputs(spark, sf_dir)
    users = users_dimension(inputs.user_states, inputs.hot_users)
    events = resolved_events(
        inputs.events, users, plan_dimension(spark), inputs.hot_users, columns
    )
    return inputs, users, events


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days from the year before the first event to the year after the last one."""
    first, last = _years(spark, sf_dir)
    return date_dimension(spark, f"{first - 1}-01-01", f"{last + 1}-12-31")


def _calendar_of(spark: SparkSession, rows: DataFrame, ts: str) -> DataFrame:
    span = rows.agg(F.min(ts).cast("date").alias("low"), F.max(ts).cast("date").alias("high"))
    low, high = span.first()
    return date_dimension(spark, low.isoformat(), high.isoformat())


def _terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thirty-day order terms read as versions: not contiguous, so the checks find some."""
    orders = table(spark, sf_dir, "orders")
    seconds = (F.col("o_orderkey") % 86400).cast("int")
    start = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return orders.select(
        F.concat(F.lit("usr_"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.col("o_orderkey").alias("user_sk"),
        start.alias("start_date"),
        (start + F.expr("interval 30 days")).alias("end_date"),
        (F.col("o_orderstatus") == "O").alias("is_current"),
    )


# --- dimensions ---------------------------------------------------------------------------


@_query
def date_dimension_(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    per_day = orders.groupBy(F.to_date("o_orderdate").alias("calendar_date")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    calendar = _calendar_of(spark, orders, "o_orderdate")
    return calendar.join(per_day, "calendar_date", "left").withColumn(
        "orders", F.coalesce("orders", F.lit(0))
    )


@_query
def date_dimension_extend(spark, sf_dir):
    known = _calendar_of(spark, table(spark, sf_dir, "orders"), "o_orderdate")
    wanted = _calendar_of(spark, table(spark, sf_dir, "events"), "ts")
    return insert_absent(known, wanted, "date_sk")


@_query
def plan_dimension_(spark, sf_dir):
    events = BillingInputs(spark, sf_dir, amounts=False).events
    used = events.groupBy("plan_id").agg(F.count(F.lit(1)).alias("events"))
    return plan_dimension(spark).join(used, "plan_id", "left").withColumn(
        "events", F.coalesce("events", F.lit(0))
    )


@_query
def plan_mrr(spark, sf_dir):
    events = BillingInputs(spark, sf_dir, amounts=False).events
    paid = events.where(F.col("event_type").isin("invoice_paid", "upgrade"))
    counted = paid.groupBy("plan_id").agg(F.count(F.lit(1)).alias("payments"))
    mrr = monthly_mrr(F.col("base_price_usd"), F.col("billing_interval"))
    return plan_dimension(spark).join(counted, "plan_id").select(
        "plan_id",
        tier_of(F.col("plan_code")).alias("tier"),
        mrr.alias("monthly_mrr_usd"),
        "payments",
        (mrr * F.col("payments").cast("decimal(18,0)")).alias("listed_mrr_usd"),
    )


@_query
def users_scd2(spark, sf_dir):
    inputs = BillingInputs(spark, sf_dir, amounts=False)
    return users_dimension(inputs.user_states, inputs.hot_users)


def _merge(spark, sf_dir):
    """States up to 1999 as the dimension; those from mid-1998 on as the batch, of which
    the ones older than the version they meet are late."""
    inputs = BillingInputs(spark, sf_dir, amounts=False)
    states, ts, hot = inputs.user_states, F.col("effective_ts"), inputs.hot_users
    cut, since = (F.lit(d).cast("timestamp_ntz") for d in ("1999-01-01", "1998-07-01"))
    return merge_users(users_dimension(states.where(ts < cut), hot), states.where(ts >= since), hot)


@_query
def scd2_merge(spark, sf_dir):
    return _merge(spark, sf_dir).dimension


@_query
def scd2_merge_rejects(spark, sf_dir):
    return _merge(spark, sf_dir).rejects.select(
        "user_id", "subscription_tier", "account_status", "effective_ts"
    )


@_query
def scd2_merge_stored(spark, sf_dir):
    """The merge into a written dimension, which takes the place of the old one."""
    inputs = BillingInputs(spark, sf_dir, amounts=False)
    root = f"{shared_dir(spark)}/recurra-merge-{uuid.uuid4().hex}"
    states, ts, hot = inputs.user_states, F.col("effective_ts"), inputs.hot_users
    cut, since = (F.lit(d).cast("timestamp_ntz") for d in ("1999-01-01", "1998-07-01"))
    write_table(users_dimension(states.where(ts < cut), hot), root, "dim_users")
    stored = read_table(spark, root, "dim_users")
    rewrite_table(merge_users(stored, states.where(ts >= since), hot).dimension, root, "dim_users")
    return read_table(spark, root, "dim_users")


@_query
def scd2_merge_log(spark, sf_dir):
    """What became of each change of the merge."""
    return _merge(spark, sf_dir).log


@_query
def scd2_merge_buckets(spark, sf_dir):
    """A dimension stored in buckets, into which the states of the last two days are merged."""
    inputs = BillingInputs(spark, sf_dir, amounts=False, written=True)
    states, ts, hot = inputs.user_states, F.col("effective_ts"), inputs.hot_users
    stored = StoredUsers(spark, f"{shared_dir(spark)}/recurra-buckets-{uuid.uuid4().hex}")
    last = table(spark, sf_dir, "orders").agg(F.max("o_orderdate")).first()[0] or datetime(1970, 1, 2)
    cut = F.lit(last - timedelta(days=1)).cast("timestamp_ntz")
    stored.create(users_dimension(states.where(ts < cut), hot))
    stored.merge(states.where(ts >= cut), hot)
    return stored.read()


# --- facts --------------------------------------------------------------------------------


@_query
def billing_events(spark, sf_dir):
    return BillingInputs(spark, sf_dir).events


@_query
def mrr_deltas(spark, sf_dir):
    inputs = BillingInputs(spark, sf_dir, amounts=False)
    priced = with_mrr_deltas(inputs.events, plan_dimension(spark), inputs.hot_users)
    return priced.select("event_id", "event_type", "mrr_delta_usd")


@_query
def invoice_pricing(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.concat(F.lit("usr_"), F.col("o_custkey").cast("string")).alias("user_id"),
    )
    # Plain equi joins, whose skewed partitions Spark splits; what matches nothing is kept.
    profiles = customers(spark, sf_dir).select("user_id", "country")
    country = orders.join(profiles, "user_id", "left").select("l_orderkey", "country")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    priced = price_invoice(
        lines.join(country, "l_orderkey", "left"),
        F.col("l_extendedprice"), F.col("l_discount"), F.col("country"),
        taxed=("NATION_2", "NATION_7"),
    )
    amounts = ["gross_amount_usd", "discount_amount_usd", "net_amount_usd", "tax_amount_usd"]
    return priced.groupBy("country").agg(
        F.count(F.lit(1)).alias("lines"), *[F.sum(a).alias(a) for a in amounts]
    )


@_query
def asof_user_version(spark, sf_dir):
    inputs = BillingInputs(spark, sf_dir, amounts=False)
    users = users_dimension(inputs.user_states, inputs.hot_users)
    return resolve_versions(
        inputs.events.select("user_id", "event_id", "event_timestamp"), users, "event_timestamp",
        ["user_sk", "subscription_tier", "account_status", "start_date"], ["event_id"],
        inputs.hot_users,
    ).drop("user_id", "event_timestamp")


@_query
def asof_fallback(spark, sf_dir):
    inputs = BillingInputs(spark, sf_dir, amounts=False)
    users = users_dimension(inputs.user_states, inputs.hot_users)
    earlier = inputs.events.select(
        "user_id", "event_id",
        (F.col("event_timestamp") - F.expr("interval 400 days")).alias("at"),
    )
    return resolve_versions(
        earlier, users, "at", tie=["event_id"], hot=inputs.hot_users
    ).select("event_id", "user_sk")


@_query
def asof_overlapping(spark, sf_dir):
    """The first of the overlapping order terms that each event falls into."""
    inputs = BillingInputs(spark, sf_dir, amounts=False)
    events = inputs.events.select(
        "user_id", "event_id", (F.col("event_timestamp") + F.expr("interval 9 days")).alias("at")
    )
    return resolve_first(
        events, _terms(spark, sf_dir), "at", ["user_sk", "end_date"], hot=inputs.hot_users
    ).select("event_id", "user_sk", "end_date")


@_query
def events_fact_(spark, sf_dir):
    inputs = BillingInputs(spark, sf_dir)
    users = users_dimension(inputs.user_states, inputs.hot_users)
    return events_fact(inputs.events, users, plan_dimension(spark), inputs.hot_users)


@_query
def events_append(spark, sf_dir):
    """The event fact in two batches, the second appended with the numbers going on."""
    inputs = BillingInputs(spark, sf_dir)
    users, plans = users_dimension(inputs.user_states, inputs.hot_users), plan_dimension(spark)
    root = f"{shared_dir(spark)}/recurra-append-{uuid.uuid4().hex}"
    early = F.col("event_timestamp") < F.lit("1998-01-01").cast("timestamp_ntz")
    write_table(
        events_fact(inputs.events.where(early), users, plans, inputs.hot_users), root, EVENTS
    )
    first = next_number(read_table(spark, root, EVENTS), "event_sk")
    late = events_fact(inputs.events.where(~early), users, plans, inputs.hot_users, first)
    write_table(late, root, EVENTS, append=True)
    return read_table(spark, root, EVENTS).drop(*PARTITIONED_BY)


@_query
def events_append_twice(spark, sf_dir):
    """The event fact in two batches, the second given twice: also under another name."""
    inputs = BillingInputs(spark, sf_dir)
    users, plans = users_dimension(inputs.user_states, inputs.hot_users), plan_dimension(spark)
    # Read by each append, and twice.
    raw = stage(inputs.events, "raw-events")
    root = f"{shared_dir(spark)}/recurra-batches-{uuid.uuid4().hex}"
    early = F.col("event_timestamp") < F.lit("1998-01-01").cast("timestamp_ntz")

    def make(raw, stored=None):
        first = 1 if stored is None else next_number(stored, "event_sk")
        return events_fact(raw, users, plans, inputs.hot_users, first)

    write_table(make(raw.where(early)), root, EVENTS, time_sliced=True)
    late = raw.where(~early)
    for batch in ("1998", "1998", "1998 again"):
        append_once(spark, late, root, EVENTS, ["event_id"], "event_timestamp", batch, make, True)
    return read_table(spark, root, EVENTS).drop(*PARTITIONED_BY)


@_query
def ranges_declared(spark, sf_dir):
    """Events stored by the declared months of 1996 and 1997, those of 1998 declared afterwards."""
    events = BillingInputs(spark, sf_dir).events
    path = f"{shared_dir(spark)}/recurra-ranges-{uuid.uuid4().hex}"
    stored = RangeTable(spark, path, RAW_EVENT, "event_timestamp", ["event_id"])
    stored.declare(*month_ranges(datetime(1996, 1, 1), 24))
    stored.append(events)
    stored.declare(*month_ranges(datetime(1998, 1, 1), 12))
    slices = [
        stored.parts.read([r.name]).select(F.lit(r.name).alias("slice"), "net_amount_usd")
        for r in stored.parts.ranges()
    ] + [stored.parts.read([DEFAULT]).select(F.lit(DEFAULT).alias("slice"), "net_amount_usd")]
    return reduce(DataFrame.unionByName, slices).groupBy("slice").agg(
        F.count(F.lit(1)).alias("events"), F.sum("net_amount_usd").alias("revenue")
    )


@_query
def events_between(spark, sf_dir):
    """Plain SQL over a time range of the stored events that neither begins nor ends a month."""
    _, _, events = _keyed(spark, sf_dir)
    root = f"{shared_dir(spark)}/recurra-between-{uuid.uuid4().hex}"
    # Numbering has already cut the events into stretches of time.
    write_table(number_events(events), root, EVENTS, time_sliced=True)
    register({EVENTS: read_table(spark, root, EVENTS)})
    register_between(spark, "subscription_events_between", EVENTS)
    return spark.sql(
        """SELECT event_type, count(*) AS events, sum(net_amount_usd) AS revenue,
                  min(event_timestamp) AS first_event, max(event_timestamp) AS last_event
           FROM subscription_events_between(
               TIMESTAMP_NTZ'1996-12-31 12:00:00', TIMESTAMP_NTZ'1998-03-01 00:00:00')
           GROUP BY event_type"""
    )


@_query
def snapshot_extend(spark, sf_dir):
    """The snapshot in three extensions, each of the events since the one before."""
    inputs, users, events = _keyed(spark, sf_dir)
    events = stage(events, "keyed-events")  # read several times by each extension
    stored = StoredSnapshot(spark, f"{shared_dir(spark)}/recurra-snapshot-{uuid.uuid4().hex}")
    low, high = _years(spark, sf_dir)
    first, last = index_of(low, 1), index_of(high, 12)
    since = None
    for until in (first + (last - first) // 2, last - 5, last):
        ends = F.col("event_timestamp") <= end_of_month(until)
        batch = events.where(ends if since is None else ends & ~since)
        stored.extend(batch, users, until, first, inputs.hot_users)
        since = ends
    return stored.read()


@_query
def monthly_snapshot_(spark, sf_dir):
    inputs, users, events = _keyed(spark, sf_dir)
    return monthly_snapshot(events, users, *_years(spark, sf_dir), inputs.hot_users)


# --- KPIs ---------------------------------------------------------------------------------


@_query
def mrr_waterfall(spark, sf_dir):
    return kpis.mrr_waterfall(_states(spark, sf_dir))


@_query
def saas_metrics(spark, sf_dir):
    return kpis.saas_metrics(_states(spark, sf_dir))


@_query
def cohort_retention(spark, sf_dir):
    return kpis.cohort_retention(_states(spark, sf_dir))


@_query
def cohort_first_rows(spark, sf_dir):
    retention = kpis.cohort_retention(_states(spark, sf_dir))
    return views.first_rows(retention, ["cohort_month_sk", "month_offset"])


@_query
def cohort_matrix(spark, sf_dir):
    first, last = _years(spark, sf_dir)
    retention = kpis.cohort_retention(_states(spark, sf_dir))
    return views.cohort_matrix(retention, range(12 * (last - first + 1)))


def _ltv(spark, sf_dir):
    _, users, events = _keyed(spark, sf_dir)
    return kpis.ltv_by_tier(users, events)


@_query
def ltv_arpu(spark, sf_dir):
    return _ltv(spark, sf_dir)


@_query
def ltv_charted(spark, sf_dir):
    return views.charted_ltv(_ltv(spark, sf_dir))


# --- views and reports --------------------------------------------------------------------


@_query
def active_subscriptions(spark, sf_dir):
    _, users, events = _keyed(spark, sf_dir)
    return views.active_subscriptions(users, events, plan_dimension(spark), F.lit(AS_OF))


@_query
def customer_journey(spark, sf_dir):
    inputs, users, events = _keyed(spark, sf_dir, ("user_sk", "email"))
    return views.customer_journey(
        events, users, plan_dimension(spark), _calendar(spark, sf_dir), inputs.hot_users
    )


@_query
def activity_journey(spark, sf_dir):
    events = activity_events(spark, sf_dir).select(
        "event_id", "user_id", "event_timestamp", "mrr_delta_usd"
    )
    return (
        ordered(events, ["user_id"], ["event_timestamp", "event_id"])
        .scan(
            running_value=RunningSum(F.col("mrr_delta_usd")),
            event_sequence_number=RunningSum(F.lit(1)),
        )
        .frame()
        .drop("mrr_delta_usd")
    )


@_query
def waterfall_report(spark, sf_dir):
    return views.waterfall_report(kpis.mrr_waterfall(_states(spark, sf_dir)))


@_query
def metrics_report(spark, sf_dir):
    return views.metrics_report(kpis.saas_metrics(_states(spark, sf_dir)))


@_query
def ltv_report(spark, sf_dir):
    return views.ltv_report(_ltv(spark, sf_dir))


@_query
def headline(spark, sf_dir):
    return kpis.headline(_states(spark, sf_dir))


@_query
def mrr_movement_long(spark, sf_dir):
    return views.mrr_movement_long(kpis.mrr_waterfall(_states(spark, sf_dir)))


# --- roll-ups -----------------------------------------------------------------------------


@_query
def month_rollup(spark, sf_dir):
    return rollups.month_rollup(BillingInputs(spark, sf_dir).events, 1998, 6)


@_query
def month_rollup_partitioned(spark, sf_dir):
    """The same over events written by year and month, reading only that month's folder."""
    root = f"{shared_dir(spark)}/recurra-export-{uuid.uuid4().hex}"
    path = write_table(BillingInputs(spark, sf_dir).events, root, EVENTS)
    return rollups.month_rollup(spark.read.parquet(path), 1998, 6)


@_query
def activity_month_rollup(spark, sf_dir):
    return rollups.month_rollup(activity_events(spark, sf_dir), 2024, 1)


@_query
def annual_plan_revenue(spark, sf_dir):
    _, _, events = _keyed(spark, sf_dir)
    return rollups.annual_plan_revenue(events, _calendar(spark, sf_dir), plan_dimension(spark), 1998)


@_query
def paid_revenue_top15(spark, sf_dir):
    _, _, events = _keyed(spark, sf_dir)
    return rollups.paid_revenue_top(events, _calendar(spark, sf_dir), plan_dimension(spark))


@_query
def star_sql(spark, sf_dir):
    """Ad-hoc SQL over registered names."""
    _, _, events = _keyed(spark, sf_dir)
    register({
        EVENTS: events, "dim_date": _calendar(spark, sf_dir),
        "dim_subscription_plan": plan_dimension(spark),
    })
    return spark.sql(
        f"""SELECT d.year, p.tier_level, count(*) AS events, sum(f.net_amount_usd) AS revenue
            FROM {EVENTS} f JOIN dim_date d ON d.date_sk = f.date_sk
            JOIN dim_subscription_plan p ON p.plan_sk = f.plan_sk
            WHERE f.event_type IN (:first, :second)
            GROUP BY d.year, p.tier_level""",
        args={"first": "invoice_paid", "second": "upgrade"},
    )


@_query
def partition_slices(spark, sf_dir):
    events = BillingInputs(spark, sf_dir).events
    return events.groupBy(slice_name(F.col("event_timestamp"), *SLICES).alias("slice")).agg(
        F.count(F.lit(1)).alias("events"), F.sum("net_amount_usd").alias("revenue")
    )


@_query
def dunning_recovery(spark, sf_dir):
    return rollups.dunning_recovery(activity_events(spark, sf_dir))


@_query
def billing_dunning(spark, sf_dir):
    inputs = BillingInputs(spark, sf_dir)
    return rollups.dunning_summary(
        rollups.dunning_recovery(inputs.events, 60, inputs.hot_users)
    )


@_query
def table_row_counts(spark, sf_dir):
    inputs, users, events = _keyed(spark, sf_dir)
    return row_counts({
        "dim_date": _calendar(spark, sf_dir),
        "dim_subscription_plan": plan_dimension(spark),
        "dim_users": users,
        "fact_subscription_events": events,
        "fact_monthly_financial_snapshot": monthly_states(
            events, *_years(spark, sf_dir), hot=inputs.hot_users
        ),
    })


# --- checks, on inputs that do violate them -----------------------------------------------


@_query
def run_checks(spark, sf_dir):
    """All checks on a star that breaks most of them: the calendar lacks all days before 1997,
    the catalogue the annual plans, and every tenth user version is lost; an eighth of the events
    stands there twice, refunds are negative revenue, and in December the MRR stands for the ARR."""
    inputs = BillingInputs(spark, sf_dir, refunds=True)
    users = users_dimension(inputs.user_states, inputs.hot_users)
    plans = plan_dimension(spark)
    # Written before it is read for each check.
    events = stage(events_fact(inputs.events, users, plans, inputs.hot_users), "checked-events")
    states = monthly_states(events, *_years(spark, sf_dir), users, inputs.hot_users)
    numbered = states.withColumn("snapshot_sk", F.lit(1).cast("long"))
    wrong = F.when(F.col("snapshot_month_sk") % 100 == 12, F.col("mrr_usd"))
    snapshot = stage(numbered.withColumn(
        "arr_usd", F.coalesce(wrong, F.col("arr_usd")).cast("decimal(12,2)")
    ), "checked-snapshot")
    held = users.where("user_sk % 10 <> 0").withColumn(
        "email", F.when(F.col("user_sk") % 7 != 0, F.col("email"))
    )
    return quality.run_checks({
        "dim_date": _calendar(spark, sf_dir).where("year >= 1997"),
        "dim_subscription_plan": plans.where("billing_interval = 'monthly'"),
        "dim_users": stage(held, "checked-users"),
        "fact_subscription_events": events.unionByName(events.where("event_sk % 8 = 0")),
        "fact_monthly_financial_snapshot": snapshot,
    }, (date(1996, 1, 1), date(2000, 1, 1)))


@_query
def star_end_to_end(spark, sf_dir):
    """Build, store, read back, register tables, views and the raw events, run a SQL file."""
    inputs = BillingInputs(spark, sf_dir, written=True)
    root = f"{shared_dir(spark)}/recurra-star-{uuid.uuid4().hex}"
    register_star(build_star(spark, inputs, root, *_years(spark, sf_dir)), inputs.hot_users)
    register({"raw_billing": inputs.events})
    return run_sql_file(spark, report("revenue_reconciliation"), left_out="refund")


@_query
def console_top15(spark, sf_dir):
    """A statement of the console, asked for its first nine rows."""
    _, _, events = _keyed(spark, sf_dir)
    register({
        EVENTS: events, "dim_date": _calendar(spark, sf_dir),
        "dim_subscription_plan": plan_dimension(spark),
    })
    answer = console.ask(spark, f"""
        SELECT d.year, d.quarter_name, p.plan_name,
               count(DISTINCT f.user_sk) AS total_paying_users,
               CAST(sum(f.net_amount_usd) AS DOUBLE) AS total_revenue_usd
        FROM {EVENTS} f JOIN dim_date d ON f.date_sk = d.date_sk
        JOIN dim_subscription_plan p ON p.plan_sk = f.plan_sk
        WHERE f.event_type = 'invoice_paid'
        GROUP BY d.year, d.quarter_name, p.plan_name
        ORDER BY d.year DESC, d.quarter_name DESC, total_revenue_usd DESC, p.plan_name
        LIMIT 15; -- as typed""", rows=9)
    refused = console.ask(spark, "CREATE OR REPLACE TEMPORARY VIEW dim_date AS SELECT 1 AS x")
    if answer.error or not refused.error:
        raise RuntimeError(f"console: {answer.error or 'a definition was run'}")
    schema = ("year int, quarter_name string, plan_name string, total_paying_users long, "
              "total_revenue_usd double, more boolean")
    return spark.createDataFrame([(*r, answer.more) for r in answer.rows], schema)


@_query
def dq_unique_keys(spark, sf_dir):
    return quality.duplicate_keys(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@_query
def dq_orphans(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    return quality.orphans(table(spark, sf_dir, "orders"), lines, "o_orderkey", "l_orderkey")


@_query
def dq_not_null(spark, sf_dir):
    inputs = BillingInputs(spark, sf_dir, amounts=False)
    users = users_dimension(inputs.user_states, inputs.hot_users)
    return quality.null_values(users, users.columns)


@_query
def dq_single_current(spark, sf_dir):
    return quality.not_one_current(_terms(spark, sf_dir))


@_query
def dq_scd2_intervals(spark, sf_dir):
    return quality.broken_continuity(_terms(spark, sf_dir))


@_query
def dq_arr_identity(spark, sf_dir):
    """List prices in place of the run rate: off wherever the MRR is not the last plan's."""
    plans = plan_dimension(spark).select("plan_sk", "billing_interval", "base_price_usd")
    listed = F.when(F.col("billing_interval") == "annual", F.col("base_price_usd")).otherwise(
        F.col("base_price_usd") * 12
    )
    states = _states(spark, sf_dir).join(plans, "plan_sk")
    return quality.arr_not_twelve_mrr(states.withColumn("arr_usd", listed))


@_query
def dq_waterfall_identity(spark, sf_dir):
    """Churn left out of the movements."""
    states = _states(spark, sf_dir).withColumn("churned_mrr_usd", F.lit(0).cast("decimal(12,2)"))
    return quality.waterfall_gaps(states)


@_query
def dq_cumulative_monotone(spark, sf_dir):
    """Refunds booked as negative revenue."""
    return quality.falling_revenue(_states(spark, sf_dir, refunds=True))


@_query
def dq_outside_ranges(spark, sf_dir):
    events = BillingInputs(spark, sf_dir, amounts=False).events
    outside = slice_name(F.col("event_timestamp"), *SLICES) == "default"
    return events.where(outside).select("event_id", "event_timestamp")


@_query
def dq_expired_without_end(spark, sf_dir):
    """Order terms of which every fifth has lost its end."""
    lost = F.when(F.col("user_sk") % 5 != 0, F.col("end_date"))
    terms = _terms(spark, sf_dir).withColumn("end_date", lost)
    return quality.expired_without_end(terms).select("user_id", "user_sk")


@_query
def dq_ends_before_start(spark, sf_dir):
    """Order terms of which every third ends a day early."""
    early = F.when(
        F.col("user_sk") % 3 == 0, F.col("start_date") - F.expr("interval 1 day")
    ).otherwise(F.col("end_date"))
    terms = _terms(spark, sf_dir).withColumn("end_date", early)
    return quality.ends_before_start(terms).select("user_id", "user_sk", "start_date", "end_date")


@_query
def dq_snapshot_orphans(spark, sf_dir):
    """Snapshot rows against a catalogue that lacks the annual plans."""
    plans = plan_dimension(spark).where("billing_interval = 'monthly'")
    return quality.orphans(_states(spark, sf_dir), plans, "plan_sk")


@_query
def dq_month_user_unique(spark, sf_dir):
    """Months in which a user has more than one event."""
    events = BillingInputs(spark, sf_dir, amounts=False).events
    months = events.withColumn("month", F.date_format("event_timestamp", "yyyyMM").cast("int"))
    return quality.duplicate_keys(months, ["month", "user_id"])


@_query
def dq_declared_nulls(spark, sf_dir):
    """Billing events whose type is lost where it is a refund, and the plan of cancellations."""
    kind = F.col("event_type")
    events = BillingInputs(spark, sf_dir, amounts=False).events.select(
        "*", F.when(kind != "refund", kind).alias("kind")
    )
    lost = events.withColumn("plan_id", F.when(kind != "cancellation", F.col("plan_id"))).drop(
        "event_type"
    ).withColumnRenamed("kind", "event_type")
    return quality.declared_nulls(lost, RAW_EVENT)


@_query
def dq_natural_keys(spark, sf_dir):
    """Days on which more than one order was placed: no natural key of orders."""
    orders = table(spark, sf_dir, "orders")
    return quality.duplicate_keys(
        orders.select(F.to_date("o_orderdate").alias("calendar_date")), ["calendar_date"]
    )


@_query
def dq_event_key(spark, sf_dir):
    """Events that share the user and the kind."""
    return quality.duplicate_keys(activity_events(spark, sf_dir), ["user_id", "event_type"])


# --- training-data operators, present only with their subpackage ---------------------------

try:
    import corpus_pipeline
    from recurra.llm import queries as llm_queries
except ModuleNotFoundError as error:
    # Only the subpackage or the pipeline may be missing, not something that they need.
    if error.name not in ("corpus_pipeline", "recurra.llm"):
        raise
    corpus_pipeline = llm_queries = None


def _llm_queries() -> dict[str, Query]:
    if llm_queries is None:
        return {}
    return llm_queries.queries() | {"pipeline": corpus_pipeline.run}


def _llm_sql() -> dict[str, str]:
    if llm_queries is None:
        return {}
    own = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return llm_queries.oracle_sql() | own


# --- contract -----------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """The monthly MRR waterfall on the smallest data set."""
    return queries()["mrr_waterfall"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {name.rstrip("_"): run for name, run in _QUERIES.items()} | _llm_queries()


def oracle_sql() -> dict[str, str]:
    return oracle_queries.oracle_sql() | _llm_sql()
