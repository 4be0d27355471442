"""The monthly snapshot: hand-made life cycles and random ones against the plain loop."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from recurra.plans.dimensions import plan_dimension, users_dimension
from recurra.plans.facts import events_fact, monthly_snapshot, monthly_states, resolved_events
from samples import (
    CANCEL, PAID, SIGNUP, UPGRADE, event, loop_snapshot, one_state_per_user, raw_events,
    snapshot_rows, state, states,
)


def built(spark, events, start=2023, end=2023):
    users = users_dimension(one_state_per_user(spark, events))
    fact = resolved_events(raw_events(spark, events), users, plan_dimension(spark))
    return snapshot_rows(monthly_states(fact, start, end))


def money(*values):
    return tuple(Decimal(v).quantize(Decimal("0.01")) for v in values)


def test_full_life_cycle(spark):
    rows = built(spark, [
        event("u", "2023-01-05", SIGNUP),
        event("u", "2023-01-15", PAID, 29, 29),
        event("u", "2023-02-14", PAID, 0, 29),
        event("u", "2023-03-16", UPGRADE, 70, 99),
        event("u", "2023-04-15", PAID, -70, 29),
        event("u", "2023-05-15", CANCEL),
    ])
    assert rows == {
        (202301, "u"): money(29, 29, 0, 0, 0, 29, 29) + (True,),
        (202302, "u"): money(29, 0, 0, 0, 0, 0, 58) + (True,),
        (202303, "u"): money(99, 0, 70, 0, 0, 70, 157) + (True,),
        (202304, "u"): money(29, 0, 0, 70, 0, -70, 186) + (True,),
        (202305, "u"): money(0, 0, 0, 0, 29, -29, 186) + (False,),
    }


def test_activation_and_upgrade_in_one_month_is_all_new(spark):
    rows = built(spark, [event("u", "2023-12-02", PAID, 29), event("u", "2023-12-09", UPGRADE, 70)])
    assert rows == {(202312, "u"): money(99, 99, 0, 0, 0, 99, 0) + (True,)}


def test_activation_and_cancellation_in_one_month(spark):
    rows = built(spark, [event("u", "2023-12-02", PAID, 29), event("u", "2023-12-09", CANCEL)])
    assert rows == {(202312, "u"): money(0, 29, 0, 0, 29, 0, 0) + (False,)}


def test_return_in_the_month_of_cancellation_is_expansion(spark):
    rows = built(spark, [
        event("u", "2023-11-02", PAID, 29),
        event("u", "2023-12-02", CANCEL),
        event("u", "2023-12-09", PAID, 99),
    ])
    assert rows[202312, "u"] == money(99, 0, 99, 0, 29, 70, 0) + (True,)


def test_unpaid_trial_leaves_no_rows(spark):
    assert built(spark, [event("u", "2023-03-01", SIGNUP), event("u", "2023-03-12", CANCEL)]) == {}


def test_quiet_months_are_carried(spark):
    rows = built(spark, [event("u", "2023-01-10", PAID, "24.17", 290)])
    assert sorted(k[0] for k in rows) == [202300 + m for m in range(1, 13)]
    assert {r[0] for r in rows.values()} == {Decimal("24.17")}
    assert [m for (m, _), r in rows.items() if r[1] != 0] == [202301]


def test_floor_at_zero_keeps_the_user_active(spark):
    rows = built(spark, [event("u", "2023-11-02", PAID, 29), event("u", "2023-12-02", PAID, -50)])
    assert rows[202312, "u"] == money(0, 0, 0, 50, 0, -29, 0) + (True,)


def test_month_ends_at_its_last_whole_second(spark):
    edge = datetime(2023, 1, 31, 23, 59, 59)
    rows = built(spark, [
        event("a", edge, PAID, 10, 1), event("b", edge + timedelta(milliseconds=500), PAID, 10, 1),
    ])
    assert min(k for k in rows if k[1] == "a")[0] == 202301
    assert min(k for k in rows if k[1] == "b")[0] == 202302


def random_events(seed, users, hot_share=0.0):
    rng = random.Random(seed)
    kinds = [SIGNUP, PAID, PAID, PAID, UPGRADE, CANCEL, "payment_failed", "refund", "downgrade"]
    events = []
    for n in range(users * 12):
        user = "hot" if rng.random() < hot_share else f"u{rng.randrange(users):03d}"
        # Few distinct instants, so that ties and same-month sequences are common.
        ts = datetime(2022, 11, 1) + timedelta(days=rng.randrange(900), hours=rng.choice([0, 12]))
        events.append(event(user, ts, rng.choice(kinds), rng.randrange(-60, 90),
                            rng.choice([0, 0, 15, 29]), event_id=f"e{n:05d}"))
    return events


@pytest.mark.parametrize("seed", [1, 2])
def test_random_users_match_the_loop(spark, seed):
    events = random_events(seed, 60)
    assert built(spark, events, 2023, 2024) == loop_snapshot(events, 2023, 2024)


def test_hot_user_matches_the_loop(spark, hot_limit):
    hot_limit(50)
    events = random_events(3, 40, hot_share=0.4)
    assert built(spark, events, 2023, 2024) == loop_snapshot(events, 2023, 2024)


def test_numbers_are_dense_and_stored_fact_suffices(spark):
    events = random_events(4, 30)
    users = users_dimension(one_state_per_user(spark, events))
    fact = events_fact(raw_events(spark, events), users, plan_dimension(spark))
    numbers = [r[0] for r in fact.orderBy("event_timestamp", "event_id").select("event_sk").collect()]
    assert numbers == list(range(1, len(events) + 1))
    snapshot = monthly_snapshot(fact, users, 2023, 2024)
    keys = [r[0] for r in snapshot.orderBy("snapshot_month_sk", "user_id")
            .select("snapshot_sk").collect()]
    assert keys == list(range(1, len(keys) + 1))
    assert snapshot_rows(snapshot) == loop_snapshot(events, 2023, 2024)


def test_version_at_month_end(spark):
    events = [event("u", "2023-01-10", PAID, 29), event("u", "2023-06-10", CANCEL)]
    users = users_dimension(states(spark, [
        state("u", "2023-01-10", "free", "trial"),
        state("u", "2023-02-28T23:59:59", "pro", "active"),
        state("u", "2023-04-01", "pro", "paused"),
        state("u", "2023-04-20", "pro", "active"),
        state("u", "2024-05-01", "free", "active"),
    ]))
    fact = resolved_events(raw_events(spark, events), users, plan_dimension(spark))
    keys = {
        r["snapshot_month_sk"]: r["user_sk"] for r in monthly_states(fact, 2023, 2023, users).collect()
    }
    assert keys == {202301: 1, 202302: 2, 202303: 2, 202304: 4, 202305: 4, 202306: 4}
    # With the version of February to March taken out, the newest one stands in.
    gap = users.where("user_sk <> 2")
    keys = {
        r["snapshot_month_sk"]: r["user_sk"] for r in monthly_states(fact, 2023, 2023, gap).collect()
    }
    assert keys == {202301: 1, 202302: 5, 202303: 5, 202304: 4, 202305: 4, 202306: 4}
