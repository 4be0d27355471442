"""Event fact and monthly financial snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from recurra.functions.calendar import date_sk, index_of, month_end, month_index, month_sk
from recurra.functions.pricing import monthly_mrr
from recurra.operators.asof import resolve_plan_sk, resolve_versions
from recurra.operators.hotkeys import HotKeys, by_user, lookup
from recurra.operators.numbering import number_rows
from recurra.operators.ordered import Earlier, Later, ordered
from recurra.schemas import FACT_EVENTS, FACT_SNAPSHOT, MONEY, RAW_EVENT, enforce_schema
from recurra.session import stage

_ORDER = ["event_timestamp", "event_id"]


def resolved_events(raw: DataFrame, users: DataFrame, plans: DataFrame,
                    hot: HotKeys | None = None,
                    columns: Sequence[str] = ("user_sk",)) -> DataFrame:
    """Raw events with user, plan and date keys; the user id is kept, no number given.

    ``columns`` names what to take from the user version besides its key.
    """
    keyed = resolve_plan_sk(enforce_schema(raw, RAW_EVENT), plans)
    keyed = resolve_versions(keyed, users, "event_timestamp", columns, ["event_id"], hot)
    return keyed.withColumn("date_sk", date_sk(F.col("event_timestamp")))


def with_mrr_deltas(events: DataFrame, plans: DataFrame,
                    hot: HotKeys | None = None) -> DataFrame:
    """Set ``mrr_delta_usd`` from the plans: a payment moves the user from the MRR held to
    that of its plan, a cancellation to zero; other events move nothing. A payment for an
    unknown plan fails the job."""
    priced = events.drop("mrr_delta_usd").join(
        plans.select(
            "plan_id", monthly_mrr(F.col("base_price_usd"), F.col("billing_interval")).alias("mrr")
        ),
        "plan_id", "left",
    )
    paid = F.col("event_type").isin("invoice_paid", "upgrade")
    unknown = F.raise_error(
        F.concat(F.lit("unknown plan "), F.coalesce("plan_id", F.lit("NULL")))
    ).cast(MONEY)
    target = F.when(paid, F.coalesce("mrr", unknown)).when(
        F.col("event_type") == "cancellation", F.lit(0).cast(MONEY)
    )
    held = F.coalesce(F.col("held"), F.lit(0).cast(MONEY))
    delta = F.coalesce(F.col("target") - held, F.lit(0)).cast(MONEY)
    return (
        ordered(priced.withColumn("target", target), ["user_id"], _ORDER, hot)
        .scan(held=Earlier(F.col("target")))
        .frame()
        .withColumn("mrr_delta_usd", delta)
        .drop("mrr", "target", "held")
    )


def events_fact(raw: DataFrame, users: DataFrame, plans: DataFrame,
                hot: HotKeys | None = None, first: int = 1) -> DataFrame:
    """The event fact, numbered in time order from ``first`` on."""
    return number_events(resolved_events(raw, users, plans, hot), first)


def number_events(resolved: DataFrame, first: int = 1) -> DataFrame:
    return enforce_schema(number_rows(resolved, _ORDER, "event_sk", first), FACT_EVENTS)


def monthly_states(events: DataFrame, start_year: int, end_year: int,
                   users: DataFrame | None = None, hot: HotKeys | None = None) -> DataFrame:
    """Recurring revenue of each user at each month end, without numbers.

    ``events`` is the event fact, with or without the user id. ``users`` adds the user
    version at month end and stands in for a missing user id. Within a month only what is
    paid after the last cancellation survives, and everything held before it churns; so
    one aggregate row per user and month is enough to carry the state forward.
    """
    first, last = index_of(start_year, 1), index_of(end_year, 12)
    return _recorded(_moved(events, first, last, users, hot), users, first, last, hot)


def states_of_months(
    events: DataFrame, first: int, last: int, users: DataFrame | None = None,
    hot: HotKeys | None = None, opening: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Monthly states of the months from index ``first`` to ``last``, and each user's state after.

    ``opening`` is what an earlier call has returned second for the months before; then only
    later events are needed, and just users that are active or have events are looked at.
    """
    if opening is not None:
        busy = _known_users(events, users, hot).select("user_id").distinct()
        busy = busy.select(F.col("user_id").alias("__busy"))
        concerned = opening.join(busy, opening["user_id"] == busy["__busy"], "left").where(
            F.col("active") | F.col("__busy").isNotNull()
        )
        moved = _moved(events, first, last, users, hot, concerned.drop("__busy"))
    else:
        moved = _moved(events, first, last, users, hot)
    # Read twice: for the months, and for where they leave each user.
    moved = stage(moved, "moved")
    closing = moved.groupBy("user_id").agg(
        F.max_by(F.struct("plan_sk", "active", "mrr", "cumulative"), "ix").alias("state")
    ).select("user_id", "state.*")
    if opening is not None:
        closing = closing.unionByName(opening.join(closing.select("user_id"), "user_id", "left_anti"))
    return _recorded(moved, users, first, last, hot), closing


def _known_users(events: DataFrame, users: DataFrame | None, hot: HotKeys | None) -> DataFrame:
    if "user_id" in events.columns:
        return events
    versions = hot.of_finer(["user_sk"]) if hot is not None else None
    return lookup(events, users.select("user_sk", "user_id"), "user_sk", hot=versions)


def _moved(events: DataFrame, first: int, last: int, users: DataFrame | None,
           hot: HotKeys | None, opening: DataFrame | None = None) -> DataFrame:
    """State after each month with events; ``opening`` counts as the month before ``first``."""
    events = _known_users(events, users, hot)
    totals = _month_totals(_in_range(events, first, last), hot)
    if opening is not None:
        zero = F.lit(0).cast(MONEY)
        # MRR is floored at zero, so what is held is all that later months need of the level.
        totals = totals.unionByName(opening.select(
            "user_id", F.lit(first - 1).alias("ix"), zero.alias("undone"),
            F.col("mrr").alias("kept"), F.col("active").alias("paid_open"),
            F.lit(False).alias("cancelled"), zero.alias("gain"), zero.alias("loss"),
            F.col("cumulative").alias("revenue"), zero.alias("discount"), "plan_sk",
        ))
    return _carry_forward(totals if hot is None else hot.dealt(totals))


def _recorded(moved: DataFrame, users: DataFrame | None, first: int, last: int,
              hot: HotKeys | None) -> DataFrame:
    """Monthly states from those after months with events."""
    months = _spread(moved, users, first, last, hot).where(F.col("month") >= first)
    month, state, quiet = F.col("month"), F.col("state"), F.col("quiet")

    def only_in_month(name: str):
        return F.when(quiet, F.lit(0)).otherwise(state[name]).cast(MONEY)

    return months.select(
        month_sk(month).alias("snapshot_month_sk"),
        month_end(month).alias("snapshot_date"),
        *(["user_sk"] if users is not None else []),
        "user_id",
        state["plan_sk"].alias("plan_sk"),
        state["active"].alias("is_active_subscriber"),
        state["mrr"].cast(MONEY).alias("mrr_usd"),
        (state["mrr"] * 12).cast(MONEY).alias("arr_usd"),
        only_in_month("new").alias("new_mrr_usd"),
        only_in_month("expansion").alias("expansion_mrr_usd"),
        only_in_month("contraction").alias("contraction_mrr_usd"),
        only_in_month("churned").alias("churned_mrr_usd"),
        only_in_month("movement").alias("net_mrr_movement_usd"),
        only_in_month("discount").alias("discount_applied_usd"),
        state["cumulative"].cast("decimal(14,2)").alias("cumulative_revenue_usd"),
    )


def monthly_snapshot(events: DataFrame, users: DataFrame, start_year: int = 2023,
                     end_year: int = 2025, hot: HotKeys | None = None) -> DataFrame:
    """The snapshot fact: monthly states with the user version at month end, numbered by
    month and user."""
    return number_states(monthly_states(events, start_year, end_year, users, hot))


def number_states(states: DataFrame, first: int = 1) -> DataFrame:
    """The snapshot from states, numbered by month and user."""
    numbered = number_rows(states, ["snapshot_month_sk", "user_id"], "snapshot_sk", first)
    return enforce_schema(numbered, FACT_SNAPSHOT)


def _spread(moved: DataFrame, users: DataFrame | None, first: int, last: int,
            hot: HotKeys | None) -> DataFrame:
    """One row per user and month to record, with the state and user version it has.

    Months with events and months in which a version starts are the break points of a
    user. State and version are filled forward over those few rows only; the months in
    between come out of the final explode, so that they are never shuffled or sorted.
    """
    state = [c for c in moved.columns if c not in ("user_id", "ix")]
    rows = moved.select("user_id", "ix", F.struct(*state).alias("own"))
    if users is not None:
        rows = rows.unionByName(_version_months(users, first, hot), allowMissingColumns=True)
    rows = rows.withColumn("has_events", F.col("own").isNotNull())
    # Two rows per month at most: the version that starts in it, then its events.
    user = Window.partitionBy("user_id").orderBy("ix", "has_events")
    so_far = user.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = rows.withColumns({
        "state": F.last("own", ignorenulls=True).over(so_far),
        "next_ix": F.lead("ix", 1, last + 1).over(user),
    })
    if users is not None:
        filled = filled.withColumns({
            "current": F.last("version", ignorenulls=True).over(so_far),
            "newest": F.max("version").over(Window.partitionBy("user_id")),
        })
    active = F.col("state.active")
    recorded = (F.col("state.churned") > 0) | (F.col("state.revenue") > 0) | active
    months = F.least(F.col("next_ix"), F.lit(last + 1)) - F.col("ix")
    steps = (
        F.when(F.col("has_events") & recorded, F.when(active, months - 1).otherwise(F.lit(0)))
        .when(~F.col("has_events") & active & (months > 0), months - 1)
    )
    breaks = filled.withColumn("steps", steps).where(F.col("steps").isNotNull())
    spread = (
        breaks.withColumn("step", F.explode(F.sequence(F.lit(0), F.col("steps").cast("int"))))
        .withColumns({
            "month": F.col("ix") + F.col("step"),
            "quiet": ~F.col("has_events") | (F.col("step") > 0),
        })
    )
    if users is None:
        return spread
    until = F.col("current.until_ix")
    valid = F.col("current").isNotNull() & (until.isNull() | (F.col("month") < until))
    unknown = F.concat(F.lit("no dimension record for user "), F.col("user_id"))
    return spread.withColumn(
        "user_sk",
        F.coalesce(
            F.when(valid, F.col("current.user_sk")).otherwise(F.col("newest.user_sk")),
            F.raise_error(unknown).cast("long"),
        ),
    )


def _version_months(users: DataFrame, first: int, hot: HotKeys | None) -> DataFrame:
    """The last version starting in each month, per user: the one valid from that month's
    end on, until the month its own end falls into."""
    starting = (
        users.select(
            "user_id",
            F.greatest(month_index(F.col("start_date")), F.lit(first)).alias("ix"),
            F.struct(
                "start_date", "user_sk", month_index(F.col("end_date")).alias("until_ix")
            ).alias("version"),
        )
        .groupBy("user_id", "ix")
        .agg(F.max("version").alias("version"))
    )
    # Hashed like the states, so that both are merged without another shuffle.
    return by_user(starting, hot)


def end_of_month(index: int) -> Column:
    """The last second of a month, which belongs to it as all times after the one before do."""
    following = datetime(index // 12 + (index % 12 == 11), (index + 1) % 12 + 1, 1)
    return F.lit((following - timedelta(seconds=1)).isoformat()).cast("timestamp_ntz")


def _in_range(events: DataFrame, first: int, last: int) -> DataFrame:
    ts = F.col("event_timestamp")
    return events.where((ts > end_of_month(first - 1)) & (ts <= end_of_month(last))).select(
        "user_id", "event_id", "event_timestamp", "event_type", "plan_sk",
        "net_amount_usd", "discount_amount_usd", "mrr_delta_usd",
        month_index(ts).alias("ix"),
    )


def _month_totals(events: DataFrame, hot: HotKeys | None) -> DataFrame:
    cancel = F.col("event_type") == "cancellation"
    paid = F.col("event_type").isin("invoice_paid", "upgrade")
    delta = F.when(paid, F.col("mrr_delta_usd")).otherwise(F.lit(0).cast(MONEY))
    # Paid before a cancellation of the same month: gone again by month end.
    undone = F.coalesce(F.col("cancel_ix") == F.col("ix"), F.lit(False))
    nothing = F.lit(0).cast(MONEY)
    return (
        # The month comes first in time anyway; naming it saves the grouping a sort.
        ordered(events, ["user_id"], ["ix", *_ORDER], hot)
        .scan(cancel_ix=Later(F.when(cancel, F.col("ix"))))
        .frame()
        .groupBy("user_id", "ix")
        .agg(
            F.sum(F.when(undone, delta).otherwise(nothing)).alias("undone"),
            F.sum(F.when(undone, nothing).otherwise(delta)).alias("kept"),
            F.max(paid & ~undone).alias("paid_open"),
            F.max(cancel).alias("cancelled"),
            F.sum(F.greatest(delta, nothing)).alias("gain"),
            F.sum(F.greatest(-delta, nothing)).alias("loss"),
            F.sum("net_amount_usd").alias("revenue"),
            F.sum("discount_amount_usd").alias("discount"),
            F.max_by("plan_sk", F.struct(*_ORDER)).alias("plan_sk"),
        )
    )


def _carry_forward(monthly: DataFrame) -> DataFrame:
    """State after each month with events. Groups hold one row per month at most."""
    by_user = Window.partitionBy("user_id").orderBy("ix")
    so_far = by_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_segment = (
        Window.partitionBy("user_id", "segment").orderBy("ix")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    zero = F.lit(0).cast(MONEY)
    # A month with a cancellation starts a segment; MRR is floored at zero each month
    # end, which over a running sum means taking out its lowest point below zero.
    state = (
        monthly.withColumns({
            "segment": F.sum(F.col("cancelled").cast("int")).over(so_far),
            "cumulative": F.sum("revenue").over(so_far),
        })
        .withColumns({
            "level": F.sum("kept").over(in_segment),
            "active": F.max("paid_open").over(in_segment),
        })
        .withColumn("low", F.min("level").over(in_segment))
        .withColumn("mrr", (F.col("level") - F.least(zero, F.col("low"))).cast(MONEY))
        .withColumns({
            "held": F.coalesce(F.lag("mrr").over(by_user), zero),
            "was_active": F.coalesce(F.lag("active").over(by_user), F.lit(False)),
        })
    )
    starting = ~F.col("was_active") & (F.col("held") == 0)
    return state.withColumns({
        "churned": F.when(F.col("cancelled"), F.col("held") + F.col("undone")).otherwise(zero),
        "new": F.when(starting, F.col("gain") - F.col("loss")).otherwise(zero),
        "expansion": F.when(starting, zero).otherwise(F.col("gain")),
        "contraction": F.when(starting, zero).otherwise(F.col("loss")),
        "movement": F.col("mrr") - F.col("held"),
    }).select(
        "user_id", "ix", "plan_sk", "active", "mrr", "new", "expansion", "contraction",
        "churned", "movement", "revenue", "discount", "cumulative",
    )
