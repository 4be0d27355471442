"""Tables kept up to date in place: parts, ranges, buckets, batches, growing snapshots."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from conftest import DATA
from recurra.functions.calendar import index_of
from recurra.operators.overlap import resolve_first
from recurra.plans import stored as stored_module
from recurra.plans.dimensions import merge_users, plan_dimension, users_dimension
from recurra.plans.facts import end_of_month, events_fact, monthly_snapshot, resolved_events
from recurra.plans.stored import StoredSnapshot, StoredUsers, append_once
from recurra.sources.billing import BillingInputs
from recurra.sources.parts import DEFAULT, PartTable, Range, RangeTable, month_ranges
from recurra.sources.warehouse import (
    EVENTS, PARTITIONED_BY, next_number, read_table, register, register_between, time_slice,
    write_table,
)

ROW = T.StructType([
    T.StructField("at", T.TimestampNTZType()), T.StructField("n", T.LongType()),
])
USER = "user_id string, subscription_tier string, account_status string, effective_ts timestamp_ntz"


@pytest.fixture(scope="module")
def inputs(spark):
    return BillingInputs(spark, f"{DATA}/sf0.001")


@pytest.fixture(scope="module")
def users(spark, inputs, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("users"))
    write_table(users_dimension(inputs.user_states), root, "dim_users")
    return read_table(spark, root, "dim_users")


@pytest.fixture(scope="module")
def resolved(spark, inputs, users, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("resolved") / "events")
    resolved_events(inputs.events, users, plan_dimension(spark)).write.parquet(path)
    return spark.read.parquet(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def files(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def states(spark, *given):
    full = [(u, t, s, datetime(2024, 1, 1) + timedelta(days=d)) for u, t, s, d in given]
    made = spark.createDataFrame(full, USER)
    return made.withColumns({
        "email": F.lit("e"), "country": F.lit("c"), "acquisition_channel": F.lit("a"),
        "billing_currency": F.lit("USD"),
    })


# --- parts and ranges -----------------------------------------------------------------------


def test_parts_are_replaced_one_by_one(spark, tmp_path):
    table = PartTable(spark, str(tmp_path), ROW, ["n"])
    part = F.concat(F.lit("p"), (F.col("n") % 3).cast("string"))
    assert table.read().collect() == [] and table.folders() == {} and table.last_number() == 0
    table.write(spark.range(9).select(F.lit(None).cast("timestamp_ntz").alias("at"), F.col("id").alias("n")),
                part, number="n")
    before = table.folders()
    more = spark.createDataFrame([(None, 10), (None, 11)], ROW)
    table.write(more, part, replace=["p1"], number="n")
    after = table.folders()
    assert after["p0"] == before["p0"] and not set(after["p1"]) & set(before["p1"])
    assert after["p2"][0] == before["p2"][0] and len(after["p2"]) == 2
    assert [n for _, n in rows(table.read())] == [0, 10, 11, 2, 3, 5, 6, 8]
    assert rows(table.read(["p1"])) == [(None, 10)]
    assert table.last_number() == 11
    table.write(more.limit(0), part, replace=["p0"])
    assert table.read(["p0"]).collect() == [] and table.last_number() == 11


def test_a_lost_write_is_not_read_and_a_second_writer_is_refused(spark, tmp_path, monkeypatch):
    table = PartTable(spark, str(tmp_path), ROW, ["n"])
    table.write(spark.createDataFrame([(None, 1)], ROW), F.lit("p"))
    seen = table.history()
    with monkeypatch.context() as lost:
        lost.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.write(table.read(), F.lit("p"), replace=["p"])
    assert table.history() == seen and rows(table.read()) == [(None, 1)]
    table.write(spark.createDataFrame([(None, 2)], ROW), F.lit("p"))
    monkeypatch.setattr(table, "history", lambda: seen)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        table.write(spark.createDataFrame([(None, 3)], ROW), F.lit("p"))
    monkeypatch.undo()
    assert rows(table.read()) == [(None, 1), (None, 2)]


def test_names_of_parts_are_plain(spark, tmp_path):
    with pytest.raises(ValueError, match="not names of parts"):
        PartTable(spark, str(tmp_path), ROW, ["n"]).write(
            spark.createDataFrame([(None, 1)], ROW), F.lit("a/b"))


def test_ranges_route_and_reroute(spark, tmp_path):
    given = [(datetime(2023, 1, 1) + timedelta(hours=37 * i), i) for i in range(400)] + [(None, 999)]
    edge = [(datetime(2023, 2, 1), 1000), (datetime(2023, 1, 31, 23, 59, 59, 999999), 1001)]
    table = RangeTable(spark, str(tmp_path), ROW, "at", ["n"])
    months = month_ranges(datetime(2023, 1, 15), 12)
    assert months[0] == Range("2023_01", datetime(2023, 1, 1), datetime(2023, 2, 1))
    table.declare(*months[:3], *months[6:8])
    table.append(spark.createDataFrame(given + edge, ROW))

    def name(at, known):
        return next((r.name for r in known if at and r.low <= at < r.high), DEFAULT)

    def check(known):
        for part in {r.name for r in known} | {DEFAULT}:
            wanted = [n for at, n in given + edge if name(at, known) == part]
            assert sorted(r.n for r in table.parts.read([part]).collect()) == sorted(wanted)

    check([*months[:3], *months[6:8]])
    kept = {p: f for p, f in table.parts.folders().items() if p != DEFAULT}
    table.declare(*months[3:6])
    check(months[:8])
    assert all(table.parts.folders()[p] == f for p, f in kept.items())
    low, high = datetime(2023, 1, 31, 23), datetime(2023, 3, 1)
    found = table.read(low, high)
    assert sorted(r.n for r in found.collect()) == sorted(
        n for at, n in given + edge if at and low <= at < high)
    read = {f.split("part_of=")[1].split("/")[0] for f in table.read(low, high).inputFiles()}
    assert read == {"2023_01", "2023_02", DEFAULT}
    for bad in (Range("2024_01", datetime(2023, 3, 5), datetime(2023, 3, 6)),
                Range("2023_01", datetime(2030, 1, 1), datetime(2030, 1, 2)),
                Range("none", datetime(2030, 1, 2), datetime(2030, 1, 2))):
        with pytest.raises(ValueError):
            table.declare(bad)
    check(months[:8])


# --- the user dimension ---------------------------------------------------------------------


def test_a_batch_rewrites_the_buckets_it_touches(spark, inputs, tmp_path):
    cut = F.lit("1999-01-01").cast("timestamp_ntz")
    early = inputs.user_states.where(F.col("effective_ts") < cut)
    late = inputs.user_states.where((F.col("effective_ts") >= cut) & (F.col("user_id") == "usr_7"))
    kept = StoredUsers(spark, str(tmp_path))
    kept.create(users_dimension(early), buckets=100)
    before, all_before = kept.table.folders(), files(kept.read())
    log = kept.merge(late)
    after = kept.table.folders()
    assert sum(before[p] != after[p] for p in before) == 1 and set(after) == set(before)
    assert len(all_before - files(kept.read())) == 1
    whole = merge_users(users_dimension(early), late)
    assert rows(kept.read()) == rows(whole.dimension)
    assert rows(log) == rows(whole.log) and log.count() == late.count()
    assert kept.merge(late.limit(0)).collect() == [] and kept.table.folders() == after


def test_merge_log_of_each_kind_of_change(spark, tmp_path):
    kept = StoredUsers(spark, str(tmp_path))
    kept.create(users_dimension(states(spark, ("a", "free", "trial", 0), ("b", "pro", "active", 5))), 4)
    log = kept.merge(states(
        spark, ("a", "free", "trial", 3), ("a", "pro", "active", 4), ("a", "pro", "active", 6),
        ("b", "pro", "canceled", 1), ("c", "free", "trial", 2), ("c", "free", "trial", 2),
    )).collect()
    found = sorted((r.user_id, (r.effective_ts - datetime(2024, 1, 1)).days, r.action, r.user_sk or 0)
                   for r in log)
    assert found == [
        ("a", 3, "kept", 1), ("a", 4, "opened", 3), ("a", 6, "kept", 3), ("b", 1, "rejected", 0),
        ("c", 2, "inserted", 4), ("c", 2, "kept", 4),
    ]
    again = kept.merge(states(spark, ("d", "free", "trial", 1)))
    assert [r.user_sk for r in again.collect()] == [5]


# --- batches --------------------------------------------------------------------------------


def test_a_batch_is_appended_once_even_after_a_lost_job(spark, inputs, users, tmp_path):
    plans, events, root = plan_dimension(spark), inputs.events, str(tmp_path)
    early = F.col("event_timestamp") < F.lit("1998-01-01").cast("timestamp_ntz")

    def make(raw, stored=None):
        return events_fact(raw, users, plans, None, next_number(stored, "event_sk") if stored else 1)

    write_table(events_fact(events.where(early), users, plans), root, EVENTS)
    stored = read_table(spark, root, EVENTS)
    # Half of the batch has been written, its name has not.
    half = events.where(~early & (F.xxhash64("event_id") % 2 == 0))
    write_table(make(half, stored), root, EVENTS, append=True)
    keys = (["event_id"], "event_timestamp")
    assert append_once(spark, events.where(~early), root, EVENTS, *keys, "late", make)
    assert not append_once(spark, events, root, EVENTS, *keys, "late", make)
    assert append_once(spark, events.where(~early), root, EVENTS, *keys, "again", make)
    back = read_table(spark, root, EVENTS).drop(*PARTITIONED_BY)
    whole = events_fact(events, users, plans)
    assert rows(back.drop("event_sk")) == rows(whole.drop("event_sk"))
    numbers = [r[0] for r in back.select("event_sk").collect()]
    assert sorted(numbers) == list(range(1, len(numbers) + 1))
    assert append_once(spark, events.limit(0), root, EVENTS, *keys, "empty", make)


def test_nothing_is_made_of_a_batch_that_is_there_already(spark, tmp_path):
    from recurra.plans.dimensions import date_dimension

    days, made = date_dimension(spark, "2023-12-01", "2024-01-31"), []
    write_table(days.limit(0), str(tmp_path), "dim_date")

    def make(new, stored):
        made.append(new.count())
        return new

    for batch in ("first", "again"):
        assert append_once(
            spark, days, str(tmp_path), "dim_date", ["date_sk"], "calendar_date", batch, make)
        stored = read_table(spark, str(tmp_path), "dim_date")
        assert stored.count() == stored.select("date_sk").distinct().count() == 62
    assert made == [62]


def test_days_are_appended_to_a_stored_calendar(spark, tmp_path):
    from recurra.plans.dimensions import date_dimension

    root = str(tmp_path)
    write_table(date_dimension(spark, "2023-01-01", "2023-12-31"), root, "dim_date")
    for batch in ("a", "a", "b"):
        append_once(spark, date_dimension(spark, "2023-12-01", "2024-01-31"), root, "dim_date",
                    ["date_sk"], "calendar_date", batch)
    assert rows(read_table(spark, root, "dim_date")) == rows(
        date_dimension(spark, "2023-01-01", "2024-01-31"))


# --- time ranges ----------------------------------------------------------------------------


@pytest.mark.parametrize("low, high", [
    (datetime(1996, 12, 31, 12), datetime(1998, 1, 1)),
    (datetime(1996, 12, 31, 12), datetime(1998, 1, 1, 0, 0, 0, 1)),
    (datetime(1997, 6, 1), datetime(1997, 6, 2)), (datetime(1997, 6, 2), datetime(1997, 6, 2)),
])
def test_time_ranges_read_only_their_folders(spark, inputs, users, tmp_path, low, high):
    write_table(events_fact(inputs.events, users, plan_dimension(spark)), str(tmp_path), EVENTS)
    stored = read_table(spark, str(tmp_path), EVENTS)
    register({"stored_events": stored})
    register_between(spark, "stored_between", "stored_events")
    by_sql = spark.sql(f"SELECT * FROM stored_between(TIMESTAMP_NTZ'{low}', TIMESTAMP_NTZ'{high}')")
    wanted = rows(stored.where(
        (F.col("event_timestamp") >= F.lit(low)) & (F.col("event_timestamp") < F.lit(high))))
    months = set()
    day = low
    while day < high:
        months.add(f"event_year={day.year}/event_month={day.month:02d}")
        day += timedelta(days=1)
    months |= {f"event_year={d.year}/event_month={d.month:02d}" for d in (high - timedelta(microseconds=1),) if low < high}
    for found in (by_sql, time_slice(stored, low, high)):
        assert rows(found) == wanted
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert low == high or "event_year" in plan.split("PartitionFilters")[1].split("]")[0]
        assert {f.rsplit("/", 1)[0][-len("event_year=1996/event_month=01"):] for f in files(found)} <= months


# --- the snapshot ---------------------------------------------------------------------------


def test_extended_snapshot_is_the_whole_one(spark, resolved, users, tmp_path):
    first, last = index_of(1995, 1), index_of(2001, 12)
    kept = StoredSnapshot(spark, str(tmp_path))
    batch = resolved
    for until in (index_of(1996, 3), index_of(1996, 4), index_of(1999, 12), last):
        late = kept.extend(batch, users, until, first)
        assert late.count() == (0 if batch is resolved else resolved.count() - fresh.count())
        assert kept.until() == until
        # The next batch repeats all events: those of stored months come back as late.
        batch = resolved.select("*")
        fresh = resolved.where(F.col("event_timestamp") > end_of_month(until))
    assert rows(kept.read()) == rows(monthly_snapshot(resolved, users, 1995, 2001))
    with pytest.raises(ValueError, match="no months"):
        kept.extend(resolved, users, last)


def test_an_extension_lost_before_its_state_is_repeated(spark, resolved, users, tmp_path, monkeypatch):
    kept = StoredSnapshot(spark, str(tmp_path))
    first, middle, last = index_of(1995, 1), index_of(1998, 5), index_of(2001, 12)
    kept.extend(resolved, users, middle, first)
    with monkeypatch.context() as lost:
        lost.setattr(kept._states, "write", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            kept.extend(resolved, users, last)
    assert kept.until() == middle
    kept.extend(resolved, users, last)
    assert rows(kept.read()) == rows(monthly_snapshot(resolved, users, 1995, 2001))


# --- overlapping versions -------------------------------------------------------------------


@pytest.mark.parametrize("limit", [None, 60])
def test_first_of_overlapping_versions(spark, hot_limit, limit):
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    versions, facts, sk = [], [], 0
    for user, n in (("a", 300), ("b", 20), ("c", 1), ("d", 0), (None, 3)):
        for _ in range(n):
            sk += rng.randint(1, 3)
            low = start + timedelta(hours=rng.randint(0, 500))
            high = None if rng.random() < 0.02 else low + timedelta(hours=rng.randint(0, 90))
            versions.append((user, sk, low if rng.random() > 0.01 else None, high, f"v{sk}"))
        facts += [(user, start + timedelta(hours=rng.randint(-20, 600)), i) for i in range(n + 30)]
    facts.append(("a", None, -1))
    rng.shuffle(versions)
    if limit:
        hot_limit(limit)
    found = resolve_first(
        spark.createDataFrame(facts, "user_id string, at timestamp_ntz, n int").repartition(5),
        spark.createDataFrame(
            versions, "user_id string, user_sk long, start_date timestamp_ntz, "
            "end_date timestamp_ntz, label string"),
        "at", ["user_sk", "label"],
    )
    wanted = []
    for user, at, n in facts:
        own = sorted(v for v in versions if v[0] == user) if user else sorted(
            v[1:] for v in versions if v[0] is None)
        own = [v[1:] if user else v for v in sorted(own, key=lambda v: v[1] if user else v[0])]
        valid = [v for v in own if at and v[1] and v[1] <= at and (v[2] is None or at < v[2])]
        won = (valid or own[-1:] or [(None, None, None, None)])[0 if valid else -1]
        wanted.append((user, at, n, won[0], won[3]))
    assert rows(found) == sorted(wanted, key=repr)
