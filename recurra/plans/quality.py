"""Data-quality checks. Each returns the offending rows; no rows means it passes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from recurra.operators.hotkeys import HotKeys
from recurra.operators.ordered import Later, ordered
from recurra.schemas import STAR
from recurra.session import stage


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values on more than one row, with the number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None) -> DataFrame:
    """Key values of the fact without a dimension row, with the number of fact rows.

    Fact rows are counted per key before the join, so a hot key is one row in it.
    """
    used = fact.where(F.col(fact_key).isNotNull()).groupBy(fact_key).agg(
        F.count(F.lit(1)).alias("rows")
    )
    known = dim.select(F.col(dim_key or fact_key).alias("__key"))
    return used.join(known, used[fact_key] == known["__key"], "left_anti")


def null_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns that hold NULLs, with how many; all counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "nulls").where(F.col("nulls") > 0)


def declared_nulls(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``null_values`` of every column the schema declares NOT NULL."""
    return null_values(df, [f.name for f in schema.fields if not f.nullable])


def not_one_current(users: DataFrame) -> DataFrame:
    """Users with any number of current versions but one, none included."""
    return (
        users.groupBy("user_id")
        .agg(F.count_if(F.col("is_current")).alias("current_versions"))
        .where(F.col("current_versions") != 1)
    )


def expired_without_end(users: DataFrame) -> DataFrame:
    return users.where(~F.col("is_current") & F.col("end_date").isNull())


def ends_before_start(users: DataFrame) -> DataFrame:
    return users.where(F.col("end_date") < F.col("start_date"))


def broken_continuity(users: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Versions that do not end exactly where the user's next version starts."""
    order = ["start_date", "user_sk"]
    return (
        ordered(users, ["user_id"], order, hot)
        .scan(next_start=Later(F.col("start_date")))
        .frame()
        .where(F.col("next_start").isNotNull()
               & ~F.col("end_date").eqNullSafe(F.col("next_start")))
        .select("user_id", "user_sk", "start_date", "end_date", "next_start")
    )


def _arr_gap(tolerance: float = 0.05) -> Column:
    return F.abs(F.col("arr_usd") - F.col("mrr_usd") * 12) >= F.lit(tolerance)


def arr_not_twelve_mrr(snapshot: DataFrame, tolerance: float = 0.05) -> DataFrame:
    return snapshot.where(_arr_gap(tolerance)).select(
        "snapshot_month_sk", "user_id", "mrr_usd", "arr_usd"
    )


_WATERFALL = [
    "mrr_usd", "new_mrr_usd", "expansion_mrr_usd", "contraction_mrr_usd", "churned_mrr_usd",
]


def waterfall_gaps(snapshot: DataFrame, tolerance: float = 0.10) -> DataFrame:
    """Months whose ending MRR is not the previous month's plus the movements."""
    monthly = snapshot.groupBy("snapshot_month_sk").agg(
        F.sum("mrr_usd").alias("actual"),
        F.sum(
            F.col("new_mrr_usd") + F.col("expansion_mrr_usd")
            - F.col("contraction_mrr_usd") - F.col("churned_mrr_usd")
        ).alias("moved"),
    )
    months = Window.orderBy("snapshot_month_sk")  # one row per month
    return (
        monthly.withColumn(
            "expected", F.coalesce(F.lag("actual").over(months), F.lit(0)) + F.col("moved")
        )
        .where(F.abs(F.col("expected") - F.col("actual")) >= F.lit(tolerance))
        .select("snapshot_month_sk", "expected", "actual")
    )


def falling_revenue(snapshot: DataFrame) -> DataFrame:
    """Snapshots whose cumulative revenue is below the user's previous one."""
    user = Window.partitionBy("user_id").orderBy("snapshot_month_sk")  # a row per month
    return (
        snapshot.select("user_id", "snapshot_month_sk", "cumulative_revenue_usd")
        .withColumn("previous_usd", F.lag("cumulative_revenue_usd").over(user))
        .where(F.col("cumulative_revenue_usd") < F.col("previous_usd"))
    )


def run_checks(star: dict[str, DataFrame], months: tuple[date, date] | None = None) -> DataFrame:
    """All checks on a built star: one row per check with its number of violations.

    ``months`` are the first day of the declared ranges and that after the last; by default the
    calendar's. A violation is what the functions above return as a row, so a key on three rows
    counts once. Checks of single rows are sums of one pass, which on facts rides along with a
    grouping, and checks with the same key share one: a table is scanned once per key, not once
    per check.
    """
    users, plans = star["dim_users"], star["dim_subscription_plan"]
    dates, events = star["dim_date"], star["fact_subscription_events"]
    snapshot = star["fact_monthly_financial_snapshot"]
    if months is None:
        months = dates.agg(F.min("calendar_date"), F.date_add(F.max("calendar_date"), 1)).first()
    low, high = (F.lit(m).cast("timestamp_ntz") for m in months)
    time = F.col("event_timestamp")
    within = F.coalesce((time >= low) & (time < high), F.lit(False))

    def rows(name: str, **checks: Column) -> list[Column]:
        """Sums for the checks of single rows of a table: nulls by column, and others."""
        declared = [f.name for f in STAR[name].fields if not f.nullable]
        return [F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in declared] + [
            F.count_if(wrong).alias(f"row {check}") for check, wrong in checks.items()
        ]

    found: list[DataFrame] = []

    def count(check: str, wrong: DataFrame) -> None:
        found.append(wrong.agg(F.lit(check).alias("check_name"),
                               F.count(F.lit(1)).alias("violations")))

    def collect(total: DataFrame, pairs: list[tuple[str, Column]]) -> None:
        """A row for each check of a frame of one row."""
        found.append(total.select(F.explode(F.array(*[
            F.struct(F.lit(n).alias("check_name"),
                     F.coalesce(v.cast("long"), F.lit(0)).alias("violations"))
            for n, v in pairs
        ])).alias("pair")).select("pair.*"))

    def collect_rows(groups: DataFrame, key: str | None = None) -> None:
        """Add up what ``rows`` has counted in groups."""
        counted = [c for c in groups.columns if " " in c]
        total = groups.agg(*[F.sum(F.col(f"`{c}`")).alias(c) for c in counted])
        nulls = [c for c in total.columns if c.startswith("null ")]
        any_null = sum((F.coalesce((F.col(f"`{c}`") > 0).cast("long"), F.lit(0)) for c in nulls),
                       F.lit(0))
        pairs = [("declared columns present", any_null)]
        if key:
            missing = F.coalesce((F.col(f"`null {key}`") > 0).cast("long"), F.lit(0))
            pairs.append(("surrogate keys present", missing))
        pairs += [(c[len("row "):], F.col(f"`{c}`")) for c in total.columns
                  if c.startswith("row ")]
        collect(total, pairs)

    # Dimensions: their rows without a shuffle, then their keys alone.
    for name, key, extra in (
        ("dim_date", "date_sk", {}), ("dim_subscription_plan", "plan_sk", {}),
        ("dim_users", "user_sk", {
            "expired versions end": ~F.col("is_current") & F.col("end_date").isNull(),
            "versions end after start": F.col("end_date") < F.col("start_date"),
        }),
    ):
        collect_rows(star[name].agg(*rows(name, **extra)), key)
        count(f"{key} unique", duplicate_keys(star[name], [key]))
    count("calendar_date unique", duplicate_keys(dates, ["calendar_date"]))
    count("plan_id unique", duplicate_keys(plans, ["plan_id"]))

    # Events: their rows by plan and day, few groups from which both kinds of orphans follow.
    # They are written, as each use would prune, and so scan, for itself.
    by_plan_day = stage(events.groupBy("plan_sk", "date_sk").agg(
        *rows("fact_subscription_events", **{"events within the ranges": ~within})
    ), "plan-days")
    collect_rows(by_plan_day, "event_sk")
    for key, dim, check in (("plan_sk", plans, "event plan exists"),
                            ("date_sk", dates, "event date exists")):
        count(check, orphans(by_plan_day, dim, key))
    count("event key unique", duplicate_keys(events, ["event_sk", "event_timestamp"]))
    count("event user exists", orphans(events, users, "user_sk"))

    # Snapshot: its rows by month and plan, likewise.
    by_month_plan = stage(snapshot.groupBy("snapshot_month_sk", "plan_sk").agg(
        *[F.sum(c).alias(c) for c in _WATERFALL],
        *rows("fact_monthly_financial_snapshot", **{"ARR is twelve MRR": _arr_gap()}),
    ), "month-plans")
    collect_rows(by_month_plan, "snapshot_sk")
    count("snapshot plan exists", orphans(by_month_plan, plans, "plan_sk"))
    count("waterfall adds up", waterfall_gaps(by_month_plan))
    count("snapshot user exists", orphans(snapshot, users, "user_sk"))
    month, user = F.col("snapshot_month_sk"), Window.partitionBy("user_id").orderBy(
        "snapshot_month_sk"  # a row per month
    )
    in_order = snapshot.select("user_id", "snapshot_month_sk", "cumulative_revenue_usd").withColumns({
        "again": month.eqNullSafe(F.lag(month).over(user)),
        "thrice": month.eqNullSafe(F.lag(month, 2).over(user)),
        "falls": F.col("cumulative_revenue_usd") < F.lag("cumulative_revenue_usd").over(user),
        "place": F.row_number().over(user),
    })
    repeated = F.col("again") & (F.col("place") > 1) & ~(F.col("thrice") & (F.col("place") > 2))
    per_user = in_order.agg(F.count_if(repeated).alias("again"), F.count_if("falls").alias("falls"))
    collect(per_user, [("snapshot per month and user unique", F.col("again")),
                       ("cumulative revenue never falls", F.col("falls"))])

    # Versions of a user, in order.
    versions = ordered(users, ["user_id"], ["start_date", "user_sk"]).scan(
        next_start=Later(F.col("start_date"))
    ).frame()
    broken = F.col("next_start").isNotNull() & ~F.col("end_date").eqNullSafe(F.col("next_start"))
    by_user = versions.groupBy("user_id").agg(
        F.count_if("is_current").alias("current"), F.count_if(broken).alias("broken")
    ).agg(F.count_if(F.col("current") != 1).alias("current"), F.sum("broken").alias("broken"))
    collect(by_user, [("one current version", F.col("current")),
                      ("versions are contiguous", F.col("broken"))])
    together = reduce(DataFrame.unionByName, found)
    return together.groupBy("check_name").agg(F.sum("violations").alias("violations"))
