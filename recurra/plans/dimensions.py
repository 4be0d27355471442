"""Calendar, plan and Type-2 user dimensions, and the batch merge into the latter."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from recurra.functions.calendar import date_sk
from recurra.operators.hotkeys import HotKeys, find_hot_keys
from recurra.operators.numbering import number_rows
from recurra.operators.ordered import Earlier, Latest, Later, ordered
from recurra.schemas import (
    DIM_DATE, DIM_PLAN, DIM_USERS, SEQUENCED_STATE, USER_STATE, enforce_schema,
)

# The plan catalogue, in surrogate-key order
# (id, code, name, interval, tier level, price, seats).
PLAN_CATALOGUE = [
    ("plan_free", "FREE_TIER", "Free Community", "monthly", 1, "0.00", 1),
    ("plan_starter_m", "STARTER_MONTHLY", "Starter Monthly", "monthly", 2, "29.00", 3),
    ("plan_starter_a", "STARTER_ANNUAL", "Starter Annual", "annual", 2, "290.00", 3),
    ("plan_pro_m", "PRO_MONTHLY", "Pro Monthly", "monthly", 3, "99.00", 10),
    ("plan_pro_a", "PRO_ANNUAL", "Pro Annual", "annual", 3, "990.00", 10),
    ("plan_ent_m", "ENTERPRISE_MONTHLY", "Enterprise Monthly", "monthly", 4, "499.00", 100),
    ("plan_ent_a", "ENTERPRISE_ANNUAL", "Enterprise Annual", "annual", 4, "4990.00", 100),
]

_TRACKED = ("subscription_tier", "account_status")

# States of one instant follow their sequence; without one, their tier and status as text.
_WITHIN_INSTANT = ("sequence", *_TRACKED)


def date_dimension(spark: SparkSession, start: str = "2022-01-01",
                   end: str = "2026-12-31") -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    day = F.col("calendar_date")
    quarter = F.quarter(day).cast("string")
    iso_day = F.weekday(day) + 1
    days = spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))).alias(
            "calendar_date"
        )
    )
    return enforce_schema(
        days.select(
            date_sk(day).alias("date_sk"),
            "calendar_date",
            F.year(day).alias("year"),
            F.quarter(day).alias("quarter"),
            F.concat(F.lit("Q"), quarter, F.lit("-"), F.year(day).cast("string")).alias(
                "quarter_name"
            ),
            F.month(day).alias("month"),
            F.date_format(day, "MMMM").alias("month_name"),
            F.date_format(day, "yyyy-MM").alias("month_year"),
            F.day(day).alias("day_of_month"),
            iso_day.alias("day_of_week"),
            F.date_format(day, "EEEE").alias("day_name"),
            iso_day.isin(6, 7).alias("is_weekend"),
            (F.day(day) == 1).alias("is_month_start"),
            (F.last_day(day) == day).alias("is_month_end"),
            F.concat(F.lit("FQ"), quarter).alias("fiscal_quarter"),
            F.year(day).alias("fiscal_year"),
        ),
        DIM_DATE,
    )


def plan_dimension(spark: SparkSession, catalogue=None) -> DataFrame:
    """The plan catalogue with 1-based surrogate keys in list order.

    Built from literals inside the plan, so Spark knows how small it is and broadcasts it.
    """
    rows = ", ".join(
        "({}, true)".format(", ".join(map(_literal, (sk, *plan))))
        for sk, plan in enumerate(catalogue or PLAN_CATALOGUE, start=1)
    )
    names = ", ".join(DIM_PLAN.names)
    return enforce_schema(spark.sql(f"SELECT * FROM VALUES {rows} AS plans({names})"), DIM_PLAN)


def _literal(value: str | int | None) -> str:
    """A value in SQL; quotes and backslashes of a text stand for themselves."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def user_versions(states: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Versions of each user: states that change tier or status, each closed where the
    next one starts. A column ``sequence`` of the states orders those of one instant."""
    states = enforce_schema(states, SEQUENCED_STATE)
    tracked = F.struct(*_TRACKED)
    kept = (
        ordered(states, ["user_id"], ["effective_ts", *_WITHIN_INSTANT], hot)
        .scan(__before=Earlier(tracked))
        .apply(lambda d: d.where(~F.col("__before").eqNullSafe(tracked)).drop("__before"))
        .scan(end_date=Later(F.col("effective_ts")))
        .frame()
    )
    return kept.withColumnRenamed("effective_ts", "start_date").withColumn(
        "is_current", F.col("end_date").isNull()
    )


def users_dimension(states: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """``user_versions`` with surrogate keys in (user, start) order."""
    versions = user_versions(states, hot)
    # Two versions may start at one instant; the one that ends there comes first.
    order = ["user_id", "start_date", "is_current", "end_date", *_WITHIN_INSTANT]
    return enforce_schema(number_rows(versions, order, "user_sk"), DIM_USERS)


@dataclass(frozen=True)
class MergeResult:
    """What a merge leaves: the dimension, the late changes, and one row per change (``log``):
    user, time, tier, status, ``action`` (inserted: first version of the user; opened: version
    after another, which it closes; kept: nothing tracked changed; rejected: late) and the key of
    the version that holds after it, null for rejects."""
    dimension: DataFrame
    rejects: DataFrame
    log: DataFrame


def merge_users(dimension: DataFrame, changes: DataFrame, hot: HotKeys | None = None,
                first: int | None = None) -> MergeResult:
    """Apply a batch of user states to the Type-2 dimension.

    A new user gets a first version. A change of tier or status closes the current
    version and opens one; anything else leaves the dimension as it is. Changes dated
    before the start of the user's current version come back as rejects. New versions are
    numbered from ``first``, by default from the dimension's highest key on.
    """
    changes = enforce_schema(changes, SEQUENCED_STATE)
    if hot is None:
        hot = find_hot_keys(changes, ["user_id"])
    touched = changes.select("user_id").distinct()
    current = dimension.where("is_current")
    open_rows = current.join(touched, "user_id", "left_semi").select(
        "user_id", "user_sk", *[f for f in USER_STATE.names if f not in ("user_id", "effective_ts")],
        F.col("start_date").alias("effective_ts"), F.lit(0).alias("__new"),
    )
    batch = changes.withColumn("__new", F.lit(1))
    # The open version sorts first through __at, left empty for it alone.
    rows = open_rows.withColumn("__at", F.lit(None).cast("timestamp_ntz")).unionByName(
        batch.withColumn("__at", F.col("effective_ts")), allowMissingColumns=True
    )
    dated = ordered(rows, ["user_id"], ["__at", "__new", *_WITHIN_INSTANT], hot).scan(
        __opened=Latest(F.when(F.col("__new") == 0, F.col("effective_ts")))
    )
    late = (F.col("__new") == 1) & F.coalesce(
        F.col("effective_ts") < F.col("__opened"), F.lit(False)
    )
    tracked = F.struct(*_TRACKED)
    changed = (F.col("__new") == 0) | ~F.col("__before").eqNullSafe(tracked)
    compared = dated.apply(lambda d: d.where(~late)).scan(__before=Earlier(tracked))
    versions = (
        compared.apply(lambda d: d.where(changed))
        .scan(end_date=Later(F.col("effective_ts")))
        .frame()
        .withColumnRenamed("effective_ts", "start_date")
        .withColumn("is_current", F.col("end_date").isNull())
    )
    added = versions.where(F.col("__new") == 1).select(
        *[f.name for f in DIM_USERS.fields if f.name != "user_sk"], "sequence",
        F.col("__before").isNull().alias("__unknown"),
    )
    if first is None:
        first = (dimension.agg(F.max("user_sk")).first()[0] or 0) + 1
    order = ["user_id", "start_date", "is_current", "end_date", *_WITHIN_INSTANT]
    numbered = number_rows(added, order, "user_sk", first)
    untouched = dimension.where(~F.col("is_current")).unionByName(
        current.join(touched, "user_id", "left_anti")
    )
    merged = (
        enforce_schema(untouched, DIM_USERS)
        .unionByName(enforce_schema(versions.where(F.col("__new") == 0), DIM_USERS))
        .unionByName(enforce_schema(numbered, DIM_USERS))
    )
    late_rows = dated.frame().where(late)
    change = ["user_id", F.col("start_date").alias("effective_ts"), *_TRACKED, "sequence"]
    opened = numbered.select(
        *change, F.when(F.col("__unknown"), "inserted").otherwise("opened").alias("action"),
        "user_sk", F.lit(0).alias("__kept"),
    )
    kept = compared.frame().where(~changed).withColumnRenamed("effective_ts", "start_date").select(
        *change, F.lit("kept").alias("action"), F.lit(None).cast("long").alias("user_sk"),
        F.lit(1).alias("__kept"),
    )
    before = open_rows.select("user_id", "user_sk")
    # The open version comes first, having no time; of equal changes the one that opened one.
    holding = (
        ordered(
            before.unionByName(opened.unionByName(kept), allowMissingColumns=True), ["user_id"],
            ["effective_ts", *_WITHIN_INSTANT, "__kept"], hot,
        )
        .scan(__holds=Latest(F.col("user_sk")))
        .frame()
        .where(F.col("action").isNotNull())
    )
    columns = ["user_id", "effective_ts", *_TRACKED, "action"]
    log = holding.select(*columns, F.col("__holds").alias("user_sk")).unionByName(
        late_rows.withColumn("action", F.lit("rejected")).select(
            *columns, F.lit(None).cast("long").alias("user_sk")
        )
    )
    return MergeResult(merged, late_rows.select(*USER_STATE.names), log)
