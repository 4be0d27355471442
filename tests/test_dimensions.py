"""Calendar, Type-2 history, point-in-time lookup and the batch merge."""

from datetime import date, datetime, timedelta

import pytest

from recurra.operators.asof import resolve_plan_sk, resolve_versions
from recurra.plans import quality
from recurra.plans.dimensions import date_dimension, merge_users, plan_dimension, users_dimension
from samples import state, states

START = datetime(2023, 1, 1)


def at(day):
    return START + timedelta(days=day)


def versions(df):
    return [
        (r["user_id"], r["subscription_tier"], r["account_status"], r["start_date"], r["end_date"],
         r["is_current"])
        for r in df.orderBy("user_sk").collect()
    ]


def test_calendar(spark):
    days = {r["calendar_date"]: r for r in date_dimension(spark, "2023-12-30", "2024-03-01").collect()}
    assert len(days) == 63
    leap = days[date(2024, 2, 29)]
    assert (leap["date_sk"], leap["quarter_name"], leap["month_name"], leap["day_name"]) == (
        20240229, "Q1-2024", "February", "Thursday")
    assert leap["is_month_end"] and not leap["is_weekend"] and leap["day_of_week"] == 4
    assert days[date(2023, 12, 31)]["is_weekend"] and days[date(2024, 1, 1)]["is_month_start"]
    assert leap["fiscal_quarter"] == "FQ1" and leap["month_year"] == "2024-02"


def test_history_collapses_and_closes(spark):
    users = users_dimension(states(spark, [
        state("a", "2023-01-01", "free", "trial"),
        state("a", "2023-01-08", "pro", "active"),
        state("a", "2023-02-08", "pro", "active"),
        state("a", "2023-03-08", "pro", "canceled"),
        state("b", "2023-01-03", "free", "trial"),
    ]))
    assert versions(users) == [
        ("a", "free", "trial", at(0), at(7), False),
        ("a", "pro", "active", at(7), at(66), False),
        ("a", "pro", "canceled", at(66), None, True),
        ("b", "free", "trial", at(2), None, True),
    ]
    assert [r[0] for r in users.orderBy("user_sk").select("user_sk").collect()] == [1, 2, 3, 4]
    assert quality.broken_continuity(users).count() == 0
    assert quality.not_one_current(users).count() == 0


def two_versions(spark):
    return users_dimension(states(spark, [
        state("u", at(10).isoformat(), "free", "trial"),
        state("u", at(20).isoformat(), "pro", "active"),
    ]))


def test_lookup_at_a_point_in_time(spark):
    asked = spark.createDataFrame([("u", at(d)) for d in (5, 10, 19, 20, 99)],
                                  "user_id string, t timestamp_ntz")
    found = resolve_versions(asked, two_versions(spark), "t").orderBy("t").collect()
    # Before the first version the last one stands in.
    assert [r["user_sk"] for r in found] == [2, 1, 1, 2, 2]


def test_lookup_with_many_rows_and_versions_of_one_user(spark, hot_limit):
    hot_limit(20)
    users = users_dimension(states(spark, [
        state("u", at(d).isoformat(), "pro" if d % 2 else "free", "active")
        for d in range(0, 100)
    ]))
    asked = spark.createDataFrame(
        [("u", at(d) + timedelta(hours=h)) for d in range(0, 100) for h in (0, 23)],
        "user_id string, t timestamp_ntz")
    found = resolve_versions(asked, users, "t", ["user_sk", "start_date"]).collect()
    assert len(found) == 200
    assert all(r["start_date"] <= r["t"] < r["start_date"] + timedelta(days=1) for r in found)


def test_lookup_in_a_gap_falls_back_to_the_last_version(spark):
    users = two_versions(spark).collect()
    gap = [tuple(users[0])[:8] + (at(10), at(12), False), tuple(users[1])]
    frame = spark.createDataFrame(gap, two_versions(spark).schema)
    asked = spark.createDataFrame([("u", at(15))], "user_id string, t timestamp_ntz")
    assert resolve_versions(asked, frame, "t").first()["user_sk"] == 2


def test_unknown_user_and_plan_fail(spark):
    asked = spark.createDataFrame([("x", at(1), "plan_x")],
                                  "user_id string, t timestamp_ntz, plan_id string")
    with pytest.raises(Exception, match="no dimension record for user x"):
        resolve_versions(asked, two_versions(spark), "t").collect()
    with pytest.raises(Exception, match="unknown plan plan_x"):
        resolve_plan_sk(asked, plan_dimension(spark)).collect()
    lenient = resolve_versions(asked, two_versions(spark), "t", strict=False)
    assert lenient.first()["user_sk"] is None


def test_merge(spark):
    before = users_dimension(states(spark, [
        state(u, at(0).isoformat(), "free", "trial", f"{u}@old") for u in "abcde"
    ]))
    batch = states(spark, [
        state("a", at(5).isoformat(), "pro", "trial", "a@new"),
        state("b", at(5).isoformat(), "free", "canceled", "b@new"),
        state("c", at(5).isoformat(), "free", "trial", "c@new"),
        state("d", at(-5).isoformat(), "pro", "active", "d@new"),
        state("e", at(5).isoformat(), "pro", "active", "e@new"),
        state("e", at(6).isoformat(), "pro", "active", "e@new"),
        state("e", at(7).isoformat(), "pro", "canceled", "e@new"),
        state("n", at(5).isoformat(), "free", "trial", "n@new"),
    ])
    result = merge_users(before, batch)
    rows = {
        (r["user_sk"], r["user_id"], r["email"], r["start_date"], r["end_date"], r["is_current"])
        for r in result.dimension.collect()
    }
    assert rows == {
        (1, "a", "a@old", at(0), at(5), False), (6, "a", "a@new", at(5), None, True),
        (2, "b", "b@old", at(0), at(5), False), (7, "b", "b@new", at(5), None, True),
        (3, "c", "c@old", at(0), None, True),
        (4, "d", "d@old", at(0), None, True),
        (5, "e", "e@old", at(0), at(5), False), (8, "e", "e@new", at(5), at(7), False),
        (9, "e", "e@new", at(7), None, True),
        (10, "n", "n@new", at(5), None, True),
    }
    assert [r["user_id"] for r in result.rejects.collect()] == ["d"]
    assert quality.broken_continuity(result.dimension).count() == 0
