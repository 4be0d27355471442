"""Time the headline queries: the build from raw tables, then queries on the built star.

Reads ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]`` and prints one JSON line. A query's
time is the mean of its timed runs, all rows fetched, as the published figures were taken.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

from recurra.plans import kpis, quality, rollups, views
from recurra.plans.build import build_star
from recurra.session import build_session, shared_dir
from recurra.sources.billing import BillingInputs, activity_events
from recurra.sources.warehouse import EVENTS

RUNS = 5


def timed(run, runs: int = RUNS) -> float:
    run()  # compiles the plan's code
    start = time.perf_counter()
    for _ in range(runs):
        run()
    return (time.perf_counter() - start) / runs


def measure(spark: SparkSession, folder: str) -> dict[str, float]:
    times: dict[str, float] = {}
    # Starts the JVM side; not part of any figure.
    spark.read.parquet(f"{folder}/nation.parquet").count()

    start = time.perf_counter()
    star = build_star(
        spark, BillingInputs(spark, folder), f"{shared_dir(spark)}/recurra-bench-{uuid.uuid4().hex}",
        1995, 2001,
    )
    times["warehouse_build"] = time.perf_counter() - start

    events, users = star[EVENTS], star["dim_users"]
    dates, plans = star["dim_date"], star["dim_subscription_plan"]
    snapshot = star["fact_monthly_financial_snapshot"]
    queries = {
        "month_rollup": lambda: rollups.month_rollup(events, 1998, 6),
        "annual_plan_revenue": lambda: rollups.annual_plan_revenue(events, dates, plans, 1998),
        "paid_revenue_top15": lambda: rollups.paid_revenue_top(events, dates, plans),
        "mrr_waterfall": lambda: kpis.mrr_waterfall(snapshot),
        "saas_metrics": lambda: kpis.saas_metrics(snapshot),
        "cohort_retention": lambda: kpis.cohort_retention(snapshot),
        "ltv_arpu": lambda: kpis.ltv_by_tier(users, events),
        "headline": lambda: kpis.headline(snapshot),
        "dq_waterfall_identity": lambda: quality.waterfall_gaps(snapshot),
    }
    for name, query in queries.items():
        # A new frame each time: a collected one would keep its shuffle results.
        times[name] = timed(lambda: query().collect())

    def all_rows(query):
        return lambda: query().write.format("noop").mode("overwrite").save()

    large = {
        "active_subscriptions": lambda: views.active_subscriptions(users, events, plans),
        "customer_journey": lambda: views.customer_journey(events, users, plans, dates),
        "dunning_recovery": lambda: rollups.dunning_recovery(activity_events(spark, folder)),
    }
    for name, query in large.items():
        times[name] = timed(all_rows(query), 2)
    return times


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = measure(spark, folder)
    spark.stop()
    print(json.dumps({
        "metric": "warehouse build and queries", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": {k: round(v, 4) for k, v in times.items()},
        "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
