"""Point-in-time lookup of a versioned dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from recurra.operators.hotkeys import HotKeys, by_user, find_hot_keys
from recurra.operators.ordered import Latest, ordered

_AT, _KIND, _SEQ = "__at", "__kind", "__seq"


def resolve_versions(
    df: DataFrame,
    versions: DataFrame,
    at: str,
    columns: Sequence[str] = ("user_sk",),
    tie: Sequence[str] = (),
    hot: HotKeys | None = None,
    strict: bool = True,
) -> DataFrame:
    """Add the ``columns`` of the version of ``user_id`` valid at the time in ``at``.

    A version is valid in ``[start_date, end_date)``, without end when NULL. Where none
    is valid the user's last version stands in; an unknown user fails the job when
    ``strict``, else yields NULL. Versions of a user must not overlap.

    Rows and versions are merged into one ordered scan per user instead of joined, so
    the work is linear even for a user with many rows and many versions.
    """
    columns = list(columns)
    picked = F.struct(*columns)
    newest = versions.groupBy("user_id").agg(
        F.max_by(picked, F.struct("start_date", "user_sk")).alias("__last")
    )
    if hot is None:
        hot = find_hot_keys(
            df.select("user_id").unionAll(versions.select("user_id")), ["user_id"]
        )
    rows = df.withColumns({_AT: F.col(at), _KIND: F.lit(2)})
    changes = versions.select(
        "user_id",
        F.col("start_date").alias(_AT),
        F.lit(1).alias(_KIND),
        F.col("user_sk").alias(_SEQ),
        F.struct(F.col("end_date").alias("until"), picked.alias("row")).alias("__version"),
    )
    # The versions of ordinary users are hashed by user, so that rows which already are (the
    # usual case, after another scan) are merged with them without a second shuffle. Those of
    # a hot user would meet in one task, and go to their slices straight away.
    changes = (
        by_user(hot.cold(changes), hot).unionByName(hot.hot(changes)) if hot
        else by_user(changes, hot)
    )
    # Sorted ahead of everything, so that every row of the user can fall back to it.
    fallback = hot.dealt(newest.select("user_id", F.lit(0).alias(_KIND), "__last"))
    merged = rows.unionByName(changes, allowMissingColumns=True).unionByName(
        fallback, allowMissingColumns=True
    )
    scanned = (
        ordered(merged, ["user_id"], [_AT, _KIND, _SEQ, *tie], hot)
        .scan(__version=Latest(F.col("__version")), __last=Latest(F.col("__last")))
        .frame()
        .where(F.col(_KIND) == 2)
    )
    until = F.col("__version.until")
    valid = F.col("__version").isNotNull() & (until.isNull() | (F.col(_AT) < until))
    row = F.when(valid, F.col("__version.row")).otherwise(F.col("__last"))
    if strict:
        unknown = F.concat(F.lit("no dimension record for user "), F.col("user_id"))
        row = F.coalesce(row, F.raise_error(unknown).cast(scanned.schema["__last"].dataType))
    return scanned.select(*df.columns, *[row[c].alias(c) for c in columns])


def resolve_plan_sk(df: DataFrame, plans: DataFrame) -> DataFrame:
    """Add ``plan_sk`` for ``plan_id``; an unknown plan fails the job."""
    found = plans.select("plan_id", F.col("plan_sk").alias("__plan_sk"))
    unknown = F.raise_error(F.concat(F.lit("unknown plan "), F.col("plan_id"))).cast("int")
    return df.join(found, "plan_id", "left").select(
        *df.columns, F.coalesce("__plan_sk", unknown).alias("plan_sk")
    )
