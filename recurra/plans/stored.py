"""Keeping a stored star up to date: Type-2 merge by buckets, appends that can be repeated, and
a snapshot that grows month by month."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from recurra.operators.hotkeys import HotKeys
from recurra.plans.dimensions import merge_users
from recurra.plans.facts import end_of_month, number_states, states_of_months
from recurra.schemas import CUMULATIVE, DIM_USERS, FACT_SNAPSHOT, MONEY, enforce_schema
from recurra.session import stage
from recurra.sources.parts import PartTable
from recurra.sources.warehouse import read_table, time_slice, write_table

BUCKETS = 256


# --- the user dimension, in hash buckets of the user ----------------------------------------


class StoredUsers:
    """The Type-2 user dimension at ``path``. A merge reads and writes the buckets of the users
    it touches; the number of buckets is fixed by the first write."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = PartTable(spark, path, DIM_USERS, ["user_id", "start_date"])

    def create(self, users: DataFrame, buckets: int = BUCKETS) -> None:
        self.table.write(users, _bucket(buckets), number="user_sk")

    def read(self) -> DataFrame:
        return self.table.read()

    def merge(self, changes: DataFrame, hot: HotKeys | None = None) -> DataFrame:
        """Apply a batch as ``merge_users`` does; returns its log. The batch is written first, as
        each step of the merge reads it."""
        changes = stage(changes, "changes")
        history = self.table.history()
        buckets = int(history[0].part.split("-")[0]) if history else BUCKETS
        # At most one row per bucket.
        touched = [r[0] for r in changes.select(_bucket(buckets)).distinct().collect()]
        if not touched:
            return merge_users(self.table.read([]), changes, hot, 1).log
        first = self.table.last_number() + 1
        merged = merge_users(self.table.read(touched), changes, hot, first)
        self.table.write(merged.dimension, _bucket(buckets), touched, number="user_sk")
        return merged.log


def _bucket(buckets: int) -> Column:
    number = F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("string")
    return F.concat(F.lit(f"{buckets}-"), F.lpad(number, len(str(buckets)), "0"))


# --- appends --------------------------------------------------------------------------------


def absent_rows(rows: DataFrame, stored: DataFrame, key: Sequence[str], time: str) -> DataFrame:
    """One of the ``rows`` for each key that ``stored`` does not hold.

    ``time`` is a date or time column, never null, that rows of one key agree in. Only the part of
    the stored table within the rows' span of it is read.
    """
    key = list(key)
    low, high = rows.agg(F.min(time), F.max(time)).first()
    fresh = rows.dropDuplicates(key)
    if low is None:
        return fresh
    if isinstance(low, datetime):
        near = time_slice(stored, low, high + timedelta(microseconds=1), time)
    else:
        near = stored.where(F.col(time).between(F.lit(low), F.lit(high)))
    match = [fresh[k].eqNullSafe(F.col(f"__{k}")) for k in key]
    return fresh.join(near.select(*[F.col(k).alias(f"__{k}") for k in key]), match, "left_anti")


def append_once(spark: SparkSession, rows: DataFrame, root: str, name: str, key: Sequence[str],
                time: str, batch: str,
                make: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
                time_sliced: bool = False) -> bool:
    """Append a batch to a stored table unless it is there already; tells if it was not.

    Rows whose key the table holds are left out, so a batch of which a lost job has written some
    files is completed by running it again; if the table holds all, nothing is made or written. The name of the batch is written last; a batch with
    that name is then done with at once. ``make(new, stored)`` turns the new rows into rows of
    the table, such as by giving them keys and numbers; ``time_sliced`` says that it puts them in
    stretches of time, as numbering does.
    """
    done = f"{root}/{name}-batches"
    if batch in _committed(spark, done):
        return False
    stored = read_table(spark, root, name)
    # Written before the table grows: what is new must not depend on what is being added.
    new = stage(absent_rows(rows, stored, key, time), "absent")
    if not new.isEmpty():
        made = make(new, stored) if make else new
        write_table(made, root, name, append=True, time_sliced=time_sliced)
    spark.createDataFrame([(batch,)], "batch string").coalesce(1).write.mode("append").parquet(done)
    return True


def _committed(spark: SparkSession, path: str) -> set[str]:
    """Names of the batches appended so far, one short row each."""
    try:
        return {r.batch for r in spark.read.schema("batch string").parquet(path).collect()}
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()


# --- the monthly snapshot -------------------------------------------------------------------

STATE = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("plan_sk", T.IntegerType()),
    T.StructField("active", T.BooleanType()), T.StructField("mrr", MONEY),
    T.StructField("cumulative", CUMULATIVE),
])


class StoredSnapshot:
    """The monthly snapshot at ``path`` with the state of every user after its last month.

    ``extend`` goes on from that state: it reads new events only, and of the users those that are
    active or have some. Rows are stored by month, the state by the month it follows, which is
    written last: if a job is lost in between, extending again replaces the same months.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.rows = PartTable(spark, f"{path}/rows", FACT_SNAPSHOT, ["user_id"])
        self._states = PartTable(spark, f"{path}/states", STATE, ["user_id"])

    def until(self) -> int | None:
        """The index of the last month, if there is one."""
        return max((int(p) for p, folders in self._states.folders().items() if folders), default=None)

    def read(self) -> DataFrame:
        return self.rows.read()

    def extend(self, events: DataFrame, users: DataFrame, last: int, first: int | None = None,
               hot: HotKeys | None = None) -> DataFrame:
        """Add the months up to index ``last``; the first time from ``first`` on.

        ``events`` are those since the last extension; ``users`` the versions of the user. Returns
        the events that come too late, being of months that are stored: they change nothing.
        """
        until = self.until()
        begin = first if until is None else until + 1
        if begin is None or last < begin:
            raise ValueError("no months to add")
        late = events.limit(0)
        opening = None
        if until is not None:
            stored = F.col("event_timestamp") <= end_of_month(until)
            late, events = events.where(stored), events.where(~stored)
            opening = self._states.read([str(until)])
        states, closing = states_of_months(events, begin, last, users, hot, opening)
        before = _month_name(begin)
        number = 1 + max(
            (r.last_number or 0 for r in self.rows.history() if r.part < before), default=0
        )
        month = F.col("snapshot_month_sk").cast("string")
        self.rows.write(
            number_states(states, number), month,
            [_month_name(k) for k in range(begin, last + 1)], number="snapshot_sk",
        )
        self._states.write(
            enforce_schema(closing, STATE, {}), F.lit(str(last)),
            [] if until is None else [str(until)],
        )
        return late


def _month_name(index: int) -> str:
    return str(index // 12 * 100 + index % 12 + 1)
