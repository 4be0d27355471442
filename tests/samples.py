"""Small billing inputs, and the monthly rules restated as a plain loop."""

from __future__ import annotations

import calendar
from datetime import date, datetime, timedelta
from decimal import Decimal

from recurra.schemas import RAW_EVENT, USER_STATE

PAID, UPGRADE, CANCEL, SIGNUP = "invoice_paid", "upgrade", "cancellation", "signup"


def event(user, when, kind, delta=0, net=0, plan="plan_starter_m", discount=0, event_id=None):
    ts = when if isinstance(when, datetime) else datetime.fromisoformat(when)
    return {
        "event_id": event_id or f"{user}-{ts.isoformat()}-{kind}",
        "user_id": user, "plan_id": plan, "event_type": kind, "quantity": 1,
        "gross_amount_usd": Decimal(net) + Decimal(discount),
        "discount_amount_usd": Decimal(discount), "tax_amount_usd": Decimal(0),
        "net_amount_usd": Decimal(net), "mrr_delta_usd": Decimal(delta),
        "event_timestamp": ts,
    }


def raw_events(spark, events):
    rows = [tuple(e[c] for c in RAW_EVENT.names) for e in events]
    return spark.createDataFrame(rows, RAW_EVENT)


def state(user, when, tier, status, email="a@example.com"):
    return (user, email, "DE", "organic", "USD", tier, status, datetime.fromisoformat(when))


def states(spark, rows):
    return spark.createDataFrame(rows, USER_STATE)


def one_state_per_user(spark, events):
    firsts = {}
    for e in events:
        ts = firsts.get(e["user_id"], e["event_timestamp"])
        firsts[e["user_id"]] = min(ts, e["event_timestamp"])
    return states(spark, [
        state(u, ts.isoformat(), "free", "trial") for u, ts in sorted(firsts.items())
    ])


def loop_snapshot(events, start_year, end_year):
    """Month by month, event by event: the rules the snapshot has to reproduce."""
    out, held = {}, {}
    ordered = sorted(events, key=lambda e: (e["event_timestamp"], e["event_id"]))
    for year in range(start_year, end_year + 1):
        for month in range(1, 13):
            first = date(year, month, 1)
            last = date(year, month, calendar.monthrange(year, month)[1])
            low = datetime.combine(first - timedelta(days=1), datetime.min.time())
            low += timedelta(seconds=86399)
            high = datetime.combine(last, datetime.min.time()) + timedelta(seconds=86399)
            now = [e for e in ordered if low < e["event_timestamp"] <= high]
            for user in {e["user_id"] for e in now} | set(held):
                mrr0, active0, cumulative = held.get(user, (Decimal(0), False, Decimal(0)))
                mrr, active = mrr0, active0
                new = up = down = churn = revenue = Decimal(0)
                for e in (e for e in now if e["user_id"] == user):
                    revenue += e["net_amount_usd"]
                    delta = e["mrr_delta_usd"]
                    if e["event_type"] in (PAID, UPGRADE):
                        if not active0 and mrr0 == 0:
                            new += delta
                        elif delta > 0:
                            up += delta
                        else:
                            down -= delta
                        mrr, active = mrr + delta, True
                    elif e["event_type"] == CANCEL:
                        churn, mrr, active = churn + mrr, Decimal(0), False
                mrr = max(Decimal(0), mrr)
                cumulative += revenue
                held[user] = (mrr, active, cumulative)
                if active or churn > 0 or revenue > 0:
                    out[year * 100 + month, user] = tuple(
                        Decimal(x).quantize(Decimal("0.01"))
                        for x in (mrr, new, up, down, churn, mrr - mrr0, cumulative)
                    ) + (active,)
    return out


def snapshot_rows(df):
    return {
        (r["snapshot_month_sk"], r["user_id"]): (
            r["mrr_usd"], r["new_mrr_usd"], r["expansion_mrr_usd"], r["contraction_mrr_usd"],
            r["churned_mrr_usd"], r["net_mrr_movement_usd"], r["cumulative_revenue_usd"],
            r["is_active_subscriber"],
        )
        for r in df.collect()
    }
