"""DuckDB SQL for every registered query, written against the raw tables.

The billing inputs, dimensions and facts are restated here as chained CTEs; each query
takes the ones it needs. The snapshot follows its segment definition over a full user x
month spine, a different route from the one the library takes.
"""

from __future__ import annotations

# Years of the order tables, which fix the columns of the cohort matrix; all else takes its span
# from the data.
YEARS = 7

CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, needs: tuple[str, ...], sql: str) -> None:
    CTE[name] = (needs, sql)


def _with(names: tuple[str, ...], sql: str) -> str:
    picked: list[str] = []

    def add(name: str) -> None:
        if name in picked:
            return
        for need in CTE[name][0]:
            add(need)
        picked.append(name)

    for name in names:
        add(name)
    body = ",\n".join(f"{n} AS MATERIALIZED ({CTE[n][1]})" for n in picked)
    return f"WITH {body}\n{sql}" if picked else sql


def _r(x: str, digits: int = 2) -> str:
    scale = f"{10 ** digits}.0::DOUBLE"
    return f"(floor(({x})::DOUBLE * {scale} + 0.5::DOUBLE) / {scale})"


def _q(part: str, whole: str) -> str:
    return f"(({part})::DOUBLE / nullif(({whole})::DOUBLE, 0))"


def _pct(part: str, whole: str, digits: int = 2) -> str:
    return _r(f"{_q(part, whole)} * 100.0::DOUBLE", digits)


def _usd(x: str) -> str:
    return f"('$' || format('{{:,.2f}}', coalesce(({x})::DOUBLE, 0::DOUBLE)))"


def _pct_text(x: str) -> str:
    return f"(format('{{:,.1f}}', coalesce(({x})::DOUBLE, 0::DOUBLE)) || '%')"


def _ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def _day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


_cte("plans", (), """
  SELECT *, CASE WHEN billing_interval = 'annual'
                 THEN round((base_price_usd / 12)::DECIMAL(14,6), 2)
                 ELSE base_price_usd END::DECIMAL(12,2) AS mrr,
         lower(split_part(plan_code, '_', 1)) AS tier
  FROM (SELECT plan_sk::BIGINT AS plan_sk, plan_id, plan_code, plan_name, billing_interval,
               tier_level::BIGINT AS tier_level, base_price_usd::DECIMAL(10,2) AS base_price_usd,
               seat_limit::BIGINT AS seat_limit
        FROM (VALUES
          (1, 'plan_free', 'FREE_TIER', 'Free Community', 'monthly', 1, 0.00, 1),
          (2, 'plan_starter_m', 'STARTER_MONTHLY', 'Starter Monthly', 'monthly', 2, 29.00, 3),
          (3, 'plan_starter_a', 'STARTER_ANNUAL', 'Starter Annual', 'annual', 2, 290.00, 3),
          (4, 'plan_pro_m', 'PRO_MONTHLY', 'Pro Monthly', 'monthly', 3, 99.00, 10),
          (5, 'plan_pro_a', 'PRO_ANNUAL', 'Pro Annual', 'annual', 3, 990.00, 10),
          (6, 'plan_ent_m', 'ENTERPRISE_MONTHLY', 'Enterprise Monthly', 'monthly', 4, 499.00, 100),
          (7, 'plan_ent_a', 'ENTERPRISE_ANNUAL', 'Enterprise Annual', 'annual', 4, 4990.00, 100)
        ) t(plan_sk, plan_id, plan_code, plan_name, billing_interval, tier_level,
            base_price_usd, seat_limit))""")

_cte("lines", (), """
  SELECT l_orderkey, price, disc, ((price - disc) * l_tax::DECIMAL(4,2))::DECIMAL(12,2) AS tax
  FROM (SELECT l_orderkey, l_tax, price,
               (price * l_discount::DECIMAL(4,2))::DECIMAL(12,2) AS disc
        FROM (SELECT *, l_extendedprice::DECIMAL(12,2) AS price FROM lineitem))""")

_cte("totals", ("lines",), """
  SELECT l_orderkey, sum(price) AS gross, sum(disc) AS discount, sum(tax) AS tax
  FROM lines GROUP BY l_orderkey""")

_cte("kinds", ("plans",), """
  SELECT o.*, p.mrr, p.tier, p.plan_sk,
         CASE WHEN nth = 1 THEN 'signup'
              WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'cancellation'
              WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED'
                THEN 'payment_failed'
              WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'refund'
              ELSE 'paid' END AS kind
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth
        FROM (SELECT 'usr_' || o_custkey AS user_id, 'evt_' || o_orderkey AS event_id,
                     o_custkey, o_orderkey, o_orderstatus, o_orderpriority,
                     o_orderdate + to_seconds(o_orderkey % 86400) AS ts,
                     CASE o_orderpriority WHEN '1-URGENT' THEN 'plan_ent_m'
                       WHEN '2-HIGH' THEN 'plan_pro_m' WHEN '3-MEDIUM' THEN 'plan_starter_m'
                       WHEN '4-NOT SPECIFIED' THEN 'plan_starter_a'
                       WHEN '5-LOW' THEN 'plan_pro_a'
                       ELSE CAST(error('no plan for priority') AS VARCHAR) END AS plan_id
              FROM orders)) o
  LEFT JOIN plans p USING (plan_id)""")

_cte("moves", ("kinds",), """
  SELECT event_id,
         CASE WHEN kind = 'paid' THEN mrr - coalesce(lag(held) OVER w, 0) ELSE 0 END AS delta,
         coalesce(lag(kind) OVER w, '') = 'paid' AS in_segment
  FROM (SELECT *, CASE WHEN kind = 'paid' THEN mrr ELSE 0 END AS held
        FROM kinds WHERE kind IN ('paid', 'cancellation'))
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")


def _raw(name: str, refund_net: str) -> None:
    _cte(name, ("kinds", "moves", "totals"), f"""
  SELECT k.event_id, k.user_id, k.plan_id, k.plan_sk, k.ts, 1 AS quantity,
         CASE WHEN kind <> 'paid' THEN kind
              WHEN m.in_segment AND m.delta > 0 THEN 'upgrade' ELSE 'invoice_paid' END
           AS event_type,
         (CASE WHEN kind IN ('paid', 'payment_failed') THEN coalesce(t.gross, 0) ELSE 0 END)
           ::DECIMAL(12,2) AS gross,
         (CASE WHEN kind = 'paid' THEN coalesce(t.discount, 0) ELSE 0 END)::DECIMAL(12,2)
           AS discount,
         (CASE WHEN kind = 'paid' THEN coalesce(t.tax, 0) ELSE 0 END)::DECIMAL(12,2) AS tax,
         (CASE WHEN kind = 'paid' THEN coalesce(t.gross - t.discount, 0)
               WHEN kind = 'refund' THEN {refund_net} ELSE 0 END)::DECIMAL(12,2) AS net,
         coalesce(m.delta, 0)::DECIMAL(12,2) AS delta
  FROM kinds k LEFT JOIN moves m USING (event_id)
  LEFT JOIN totals t ON t.l_orderkey = k.o_orderkey""")


_raw("raw", "0")
_raw("raw_refunds", "coalesce(t.discount - t.gross, 0)")

_cte("states", ("kinds",), """
  SELECT k.user_id, lower(c.c_name) || '@example.com' AS email, n.n_name AS country,
         lower(c.c_mktsegment) AS channel, 'USD' AS currency, k.ts, k.event_id AS seq,
         CASE kind WHEN 'paid' THEN k.tier
                   WHEN 'cancellation' THEN coalesce(k.tier_before, 'free')
                   ELSE 'free' END AS tier,
         CASE kind WHEN 'paid' THEN 'active' WHEN 'cancellation' THEN 'canceled'
                   ELSE 'trial' END AS status
  FROM (SELECT *, last_value(CASE WHEN kind = 'paid' THEN tier END IGNORE NULLS) OVER (
                    PARTITION BY user_id ORDER BY ts, event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS tier_before
        FROM kinds) k
  LEFT JOIN customer c ON c.c_custkey = k.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  WHERE kind IN ('signup', 'paid', 'cancellation')""")


def _versions(name: str, source: str, where: str) -> None:
    _cte(name, (source,), f"""
  SELECT *, row_number() OVER (
           ORDER BY user_id, start_date, is_current, end_date, seq) AS user_sk
  FROM (SELECT *, end_date IS NULL AS is_current
        FROM (SELECT user_id, email, country, channel, currency, tier, status, seq,
                     ts AS start_date,
                     lead(ts) OVER (PARTITION BY user_id ORDER BY ts, seq) AS end_date
              FROM (SELECT *, lag(tier || '/' || status) OVER (
                                PARTITION BY user_id ORDER BY ts, seq) AS before
                    FROM {source} WHERE {where})
              WHERE before IS DISTINCT FROM tier || '/' || status))""")


_versions("users", "states", "true")

_cte("newest", ("users",), """
  SELECT user_id, max(user_sk) AS last_sk FROM users GROUP BY user_id""")


def _asof(rows: str, at: str, columns: str) -> str:
    return f"""
  SELECT {columns}, coalesce(u.user_sk, w.last_sk) AS user_sk
  FROM {rows} e JOIN newest w USING (user_id)
  LEFT JOIN users u ON u.user_id = e.user_id AND u.start_date <= {at}
       AND (u.end_date IS NULL OR {at} < u.end_date)"""


_cte("ev", ("raw", "users", "newest"), _asof("raw", "e.ts", "e.*"))

_cte("dates", (), """
  SELECT (year(d) * 10000 + month(d) * 100 + day(d))::BIGINT AS date_sk, d AS calendar_date,
         year(d) AS year, quarter(d) AS quarter,
         'Q' || quarter(d) || '-' || year(d) AS quarter_name
  FROM (SELECT unnest(generate_series(low, high, INTERVAL 1 DAY))::DATE AS d
        FROM (SELECT make_date(year(min(o_orderdate)) - 1, 1, 1) AS low,
                     make_date(year(max(o_orderdate)) + 1, 12, 31) AS high FROM orders))""")


def _snapshot(suffix: str, raw: str) -> None:
    last = "(SELECT max(year(o_orderdate)) * 12 + 11 FROM orders)"
    _cte(f"m_ev{suffix}", (raw,), f"""
  SELECT *, CASE WHEN cancel THEN 1 ELSE 0 END AS c,
         coalesce(sum(CASE WHEN cancel THEN 1 ELSE 0 END) OVER (
           PARTITION BY user_id ORDER BY ts, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg
  FROM (SELECT *, event_type = 'cancellation' AS cancel,
               event_type IN ('invoice_paid', 'upgrade') AS paid,
               year(ts + INTERVAL 999999 MICROSECONDS) * 12
                 + month(ts + INTERVAL 999999 MICROSECONDS) - 1 AS ix
        FROM {raw})""")
    _cte(f"m_seg{suffix}", (f"m_ev{suffix}",), f"""
  SELECT user_id, ix, seg, sum(CASE WHEN paid THEN delta ELSE 0 END) AS x,
         max(c) AS closed, bool_or(paid) AS anyp
  FROM m_ev{suffix} GROUP BY ALL""")
    _cte(f"m_mon{suffix}", (f"m_ev{suffix}",), f"""
  SELECT user_id, ix, max(seg + c) AS open_seg, sum(net) AS revenue, sum(discount) AS discount,
         sum(CASE WHEN paid AND delta > 0 THEN delta ELSE 0 END) AS gain,
         sum(CASE WHEN paid AND delta < 0 THEN -delta ELSE 0 END) AS loss,
         last(plan_sk ORDER BY ts, event_id) AS plan_sk
  FROM m_ev{suffix} GROUP BY ALL""")
    _cte(f"m_fill{suffix}", (f"m_mon{suffix}",), f"""
  SELECT s.user_id, s.ix, coalesce(m.revenue, 0) AS revenue, coalesce(m.discount, 0) AS discount,
         coalesce(m.gain, 0) AS gain, coalesce(m.loss, 0) AS loss,
         last_value(m.open_seg IGNORE NULLS) OVER w AS open_seg,
         last_value(m.plan_sk IGNORE NULLS) OVER w AS plan_sk,
         sum(coalesce(m.revenue, 0)) OVER w AS cumulative
  FROM (SELECT user_id, unnest(generate_series(low, {last})) AS ix
        FROM (SELECT user_id, min(ix) AS low FROM m_mon{suffix} GROUP BY user_id)) s
  LEFT JOIN m_mon{suffix} m USING (user_id, ix)
  WINDOW w AS (PARTITION BY s.user_id ORDER BY s.ix
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
    _cte(f"m_run{suffix}", (f"m_fill{suffix}", f"m_seg{suffix}"), f"""
  SELECT *, s - least(0, min(s) OVER (PARTITION BY user_id, open_seg ORDER BY ix
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS mrr
  FROM (SELECT f.*, sum(coalesce(g.x, 0)) OVER w AS s,
               max(coalesce(g.anyp, false)) OVER w AS active
        FROM m_fill{suffix} f LEFT JOIN m_seg{suffix} g
          ON g.user_id = f.user_id AND g.ix = f.ix AND g.seg = f.open_seg
        WINDOW w AS (PARTITION BY f.user_id, f.open_seg ORDER BY f.ix
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""")
    _cte(f"m_lag{suffix}", (f"m_run{suffix}",), f"""
  SELECT *, coalesce(lag(mrr) OVER w, 0) AS prev_mrr,
         coalesce(lag(active) OVER w, false) AS was_active,
         coalesce(lag(open_seg) OVER w, 0) AS prev_seg
  FROM m_run{suffix} WINDOW w AS (PARTITION BY user_id ORDER BY ix)""")
    _cte(f"m_churn{suffix}", (f"m_lag{suffix}", f"m_seg{suffix}"), f"""
  SELECT l.user_id, l.ix,
         sum(g.x + CASE WHEN g.seg = l.prev_seg THEN l.prev_mrr ELSE 0 END) AS churned
  FROM m_seg{suffix} g JOIN m_lag{suffix} l USING (user_id, ix)
  WHERE g.closed = 1 GROUP BY ALL""")
    _cte(f"snap{suffix}", (f"m_lag{suffix}", f"m_churn{suffix}"), f"""
  SELECT ((ix // 12) * 100 + ix % 12 + 1)::BIGINT AS month_sk,
         last_day(make_date(ix // 12, ix % 12 + 1, 1)) AS snapshot_date,
         user_id, plan_sk, active, mrr, mrr * 12 AS arr,
         CASE WHEN fresh THEN gain - loss ELSE 0 END AS new_mrr,
         CASE WHEN fresh THEN 0 ELSE gain END AS expansion,
         CASE WHEN fresh THEN 0 ELSE loss END AS contraction,
         churned, mrr - prev_mrr AS movement, discount, cumulative
  FROM (SELECT l.*, coalesce(c.churned, 0) AS churned,
               NOT was_active AND prev_mrr = 0 AS fresh
        FROM m_lag{suffix} l LEFT JOIN m_churn{suffix} c USING (user_id, ix))
  WHERE active OR churned > 0 OR revenue > 0""")


_snapshot("", "raw")
_snapshot("_refunds", "raw_refunds")

_cte("ev_refunds", ("raw_refunds", "users", "newest"), _asof("raw_refunds", "e.ts", "e.*"))
_cte("snap_refunds_sk", ("snap_refunds", "users", "newest"), _asof(
    "(SELECT *, snapshot_date::TIMESTAMP + INTERVAL 86399 SECONDS AS month_end FROM snap_refunds)",
    "e.month_end", "e.*"))

_cte("snap_sk", ("snap", "users", "newest"), _asof(
    "(SELECT *, snapshot_date::TIMESTAMP + INTERVAL 86399 SECONDS AS month_end FROM snap)",
    "e.month_end", "e.*"))

_cte("monthly", ("snap",), """
  SELECT month_sk, snapshot_date, sum(mrr) AS ending, sum(arr) AS arr, sum(new_mrr) AS new_mrr,
         sum(expansion) AS expansion, sum(contraction) AS contraction, sum(churned) AS churned,
         sum(movement) AS movement,
         count(DISTINCT CASE WHEN active THEN user_id END) AS users,
         count(DISTINCT CASE WHEN churned > 0 THEN user_id END) AS churned_users
  FROM snap GROUP BY ALL""")

_cte("waterfall", ("monthly",), f"""
  SELECT month_sk AS month_id, snapshot_date, coalesce(before, 0)::DOUBLE AS starting_mrr,
         new_mrr::DOUBLE AS new_mrr, expansion::DOUBLE AS expansion_mrr,
         contraction::DOUBLE AS contraction_mrr, churned::DOUBLE AS churned_mrr,
         movement::DOUBLE AS net_mrr_movement, ending::DOUBLE AS ending_mrr,
         arr::DOUBLE AS ending_arr, users AS active_subscribers,
         {_pct('ending - before', 'before')} AS mrr_growth_rate_pct
  FROM (SELECT *, lag(ending) OVER (ORDER BY month_sk) AS before FROM monthly)""")

_cte("metrics", ("monthly",), f"""
  SELECT month_sk AS month_id, snapshot_date, ending::DOUBLE AS ending_mrr,
         users AS active_subscribers,
         {_r(_q('ending', 'users'))} AS arpa_usd,
         {_r(_q('new_mrr + expansion', 'churned + contraction'))} AS saas_quick_ratio,
         {_pct('churned', 'start_mrr')} AS gross_revenue_churn_pct,
         {_pct('start_mrr + expansion - contraction - churned', 'start_mrr')}
           AS net_revenue_retention_nrr_pct,
         {_pct('churned_users', 'start_users')} AS logo_churn_pct
  FROM (SELECT *, lag(ending) OVER (ORDER BY month_sk) AS start_mrr,
               lag(users) OVER (ORDER BY month_sk) AS start_users FROM monthly)
  WHERE start_mrr > 0""")

_cte("cohorts", ("snap",), f"""
  WITH first_month AS (SELECT user_id, min(month_sk) AS cohort FROM snap WHERE active
                       GROUP BY user_id),
       sizes AS (SELECT cohort, count(DISTINCT user_id) AS users0, sum(mrr) AS mrr0
                 FROM first_month JOIN snap USING (user_id) WHERE month_sk = cohort
                 GROUP BY cohort),
       act AS (SELECT cohort, month_sk,
                      (month_sk // 100 - cohort // 100) * 12 + month_sk % 100 - cohort % 100
                        AS month_offset,
                      count(DISTINCT CASE WHEN active THEN user_id END) AS active_users,
                      sum(CASE WHEN active THEN mrr ELSE 0 END) AS active_mrr
               FROM first_month JOIN snap USING (user_id) GROUP BY ALL)
  SELECT cohort AS cohort_month_sk, month_offset::BIGINT AS month_offset,
         month_sk AS active_calendar_month, users0 AS cohort_users_month_0, active_users,
         {_pct('active_users', 'users0')} AS user_retention_rate_pct,
         mrr0::DOUBLE AS cohort_mrr_month_0, active_mrr::DOUBLE AS active_mrr,
         {_pct('active_mrr', 'mrr0')} AS net_dollar_retention_ndr_pct
  FROM act JOIN sizes USING (cohort) WHERE month_offset >= 0""")

_cte("ltv", ("ev", "users"), f"""
  WITH life AS (
    SELECT u.user_id, u.tier, u.channel, u.country, min(e.ts) AS first_ts, max(e.ts) AS last_ts,
           sum(e.net) AS revenue,
           max(CASE WHEN u.is_current AND u.status = 'canceled' THEN 1 ELSE 0 END) AS gone
    FROM users u JOIN ev e USING (user_sk) GROUP BY ALL),
  tiers AS (
    SELECT tier, count(DISTINCT user_id) AS customers,
           count(DISTINCT CASE WHEN gone = 1 THEN user_id END) AS churned,
           sum(revenue) AS revenue,
           {_r(_q('sum(revenue)', 'count(*)'))} AS arpu,
           sum(extract(day FROM last_ts - first_ts))::DOUBLE AS days, count(*) AS profiles
    FROM life GROUP BY tier)
  SELECT tier AS subscription_tier, customers AS total_customers, churned AS churned_customers,
         revenue::DOUBLE AS aggregate_tier_revenue_usd,
         arpu AS realized_arpu_per_customer_usd,
         {_r('days / profiles / 30.4375::DOUBLE', 1)} AS avg_tenure_months,
         {_pct('churned', 'customers')} AS tier_churn_rate_pct,
         {_r(f"arpu / nullif({_q('churned', 'customers')}, 0)")} AS modeled_ltv_usd
  FROM tiers""")

_cte("activity", (), """
  SELECT event_id::VARCHAR AS event_id, user_id::VARCHAR AS user_id, ts,
         CASE event_type WHEN 'error' THEN 'payment_failed' WHEN 'purchase' THEN 'invoice_paid'
                         ELSE event_type END AS event_type,
         (CASE WHEN event_type = 'purchase' THEN value::DECIMAL(12,2) ELSE 0 END)
           ::DECIMAL(12,2) AS net,
         value::DECIMAL(12,2) AS delta
  FROM events""")

_cte("terms", ("kinds",), """
  SELECT user_id, o_orderkey AS user_sk, ts AS start_date, ts + INTERVAL 30 DAY AS end_date,
         o_orderstatus = 'O' AS is_current
  FROM kinds""")


_CALENDAR_COLUMNS = """
  (year(d) * 10000 + month(d) * 100 + day(d))::BIGINT AS date_sk,
  strftime(d, '%Y-%m-%d') AS calendar_date, year(d)::BIGINT AS year,
  quarter(d)::BIGINT AS quarter, 'Q' || quarter(d) || '-' || year(d) AS quarter_name,
  month(d)::BIGINT AS month, strftime(d, '%B') AS month_name,
  strftime(d, '%Y-%m') AS month_year, day(d)::BIGINT AS day_of_month,
  isodow(d)::BIGINT AS day_of_week, strftime(d, '%A') AS day_name,
  isodow(d) >= 6 AS is_weekend, day(d) = 1 AS is_month_start, last_day(d) = d AS is_month_end,
  'FQ' || quarter(d) AS fiscal_quarter, year(d)::BIGINT AS fiscal_year"""


def _span(table: str, column: str) -> str:
    return (f"SELECT unnest(generate_series(min({column})::DATE, max({column})::DATE, "
            f"INTERVAL 1 DAY))::DATE AS d FROM {table}")


_USER_COLUMNS = f"""user_sk, user_id, email, country, channel AS acquisition_channel,
  currency AS billing_currency, tier AS subscription_tier, status AS account_status,
  {_ts('start_date')} AS start_date, {_ts('end_date')} AS end_date, is_current"""


def _rollup(source: str, low: str, high: str) -> str:
    return f"""
  SELECT event_type, count(*) AS event_count, sum(net)::DOUBLE AS total_revenue,
         {_q('sum(delta)', 'count(*)')} AS avg_mrr_delta
  FROM {source} WHERE ts >= TIMESTAMP '{low}' AND ts < TIMESTAMP '{high}'
  GROUP BY event_type"""


def _quarters(where: str, users: str, revenue: str) -> str:
    return f"""
  SELECT d.year::BIGINT AS year, d.quarter_name, p.plan_name,
         count(DISTINCT e.user_sk) AS {users}, sum(e.net)::DOUBLE AS {revenue}
  FROM ev e JOIN dates d ON d.calendar_date = e.ts::DATE JOIN plans p ON p.plan_sk = e.plan_sk
  WHERE {where} GROUP BY ALL"""


def _trailing(name: str) -> str:
    return f"(SELECT * FROM {name} ORDER BY month_id DESC LIMIT 12)"


def _merge(suffix: str, cut: str, since: str) -> None:
    """Users before ``cut`` and a batch from ``since`` on, applied one after another."""
    users, batch, applied = (f"{n}{suffix}" for n in ("old_users", "batch", "applied"))
    _versions(users, "states", f"ts < {cut}")
    _cte(batch, ("states", users), f"""
  SELECT s.*, o.start_date AS opened, o.user_sk AS o_sk, o.tier AS o_tier, o.status AS o_status
  FROM states s LEFT JOIN {users} o ON o.user_id = s.user_id AND o.is_current
  WHERE s.ts >= {since}""")
    _cte(applied, (batch,), f"""
  SELECT * FROM (
    SELECT *, coalesce(lag(tier || '/' || status) OVER (
                         PARTITION BY user_id ORDER BY ts, seq),
                       o_tier || '/' || o_status) AS before
    FROM {batch} WHERE opened IS NULL OR ts >= opened)
  WHERE before IS DISTINCT FROM tier || '/' || status""")
    _cte(f"numbered{suffix}", (applied, users), f"""
  SELECT *, coalesce((SELECT max(user_sk) FROM {users}), 0)
              + row_number() OVER (ORDER BY user_id, ts, end_date IS NULL, end_date, seq)
              AS user_sk
  FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, seq) AS end_date
        FROM {applied})""")
    _cte(f"merged{suffix}", (f"numbered{suffix}", applied, users), f"""
  SELECT user_sk, user_id, email, country, channel, currency, tier, status, start_date,
         CASE WHEN is_current THEN (SELECT min(a.ts) FROM {applied} a WHERE a.user_id = o.user_id)
              ELSE end_date END AS end_date,
         is_current AND NOT EXISTS (SELECT 1 FROM {applied} a WHERE a.user_id = o.user_id)
           AS is_current
  FROM {users} o
  UNION ALL
  SELECT user_sk, user_id, email, country, channel, currency, tier, status, ts, end_date,
         end_date IS NULL
  FROM numbered{suffix}""")


_merge("", "TIMESTAMP '1999-01-01'", "TIMESTAMP '1998-07-01'")
_LAST_DAYS = "(SELECT max(o_orderdate)::TIMESTAMP - INTERVAL 1 DAY FROM orders)"
_merge("_last_days", _LAST_DAYS, _LAST_DAYS)

_SNAP_COLUMNS = f"""row_number() OVER (ORDER BY month_sk, user_id) AS snapshot_sk,
  month_sk AS snapshot_month_sk, {_day('snapshot_date')} AS snapshot_date, user_sk, user_id,
  plan_sk, active AS is_active_subscriber, mrr::DOUBLE AS mrr_usd, arr::DOUBLE AS arr_usd,
  new_mrr::DOUBLE AS new_mrr_usd, expansion::DOUBLE AS expansion_mrr_usd,
  contraction::DOUBLE AS contraction_mrr_usd, churned::DOUBLE AS churned_mrr_usd,
  movement::DOUBLE AS net_mrr_movement_usd, discount::DOUBLE AS discount_applied_usd,
  cumulative::DOUBLE AS cumulative_revenue_usd"""

_EVENT_COLUMNS = f"""row_number() OVER (ORDER BY ts, event_id) AS event_sk, event_id, user_sk,
  plan_sk, (year(ts) * 10000 + month(ts) * 100 + day(ts))::BIGINT AS date_sk, event_type,
  quantity::BIGINT AS quantity, gross::DOUBLE AS gross_amount_usd,
  discount::DOUBLE AS discount_amount_usd, tax::DOUBLE AS tax_amount_usd,
  net::DOUBLE AS net_amount_usd, delta::DOUBLE AS mrr_delta_usd,
  {_ts('ts')} AS event_timestamp"""

_WATERFALL_USD = ["starting_mrr", "new_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr",
                  "ending_mrr", "ending_arr"]

QUERIES: dict[str, tuple[tuple[str, ...], str]] = {
    "date_dimension": ((), f"""
      SELECT {_CALENDAR_COLUMNS}, coalesce(n, 0) AS orders
      FROM ({_span('orders', 'o_orderdate')})
      LEFT JOIN (SELECT o_orderdate::DATE AS d, count(*) AS n FROM orders GROUP BY 1) USING (d)"""),
    "date_dimension_extend": ((), f"""
      SELECT {_CALENDAR_COLUMNS}
      FROM ({_span('orders', 'o_orderdate')} UNION {_span('events', 'ts')})"""),
    "plan_dimension": (("plans", "kinds"), """
      SELECT p.plan_sk, plan_id, plan_code, plan_name, billing_interval, tier_level,
             base_price_usd::DOUBLE AS base_price_usd, seat_limit, true AS is_active,
             count(k.event_id) AS events
      FROM plans p LEFT JOIN kinds k USING (plan_id) GROUP BY ALL"""),
    "plan_mrr": (("plans", "kinds"), """
      SELECT plan_id, p.tier, p.mrr::DOUBLE AS monthly_mrr_usd, count(*) AS payments,
             (p.mrr * count(*))::DOUBLE AS listed_mrr_usd
      FROM plans p JOIN kinds k USING (plan_id) WHERE kind = 'paid'
      GROUP BY plan_id, p.tier, p.mrr"""),
    "invoice_pricing": ((), """
      SELECT country, count(*) AS lines, sum(gross)::DOUBLE AS gross_amount_usd,
             sum(disc)::DOUBLE AS discount_amount_usd, sum(gross - disc)::DOUBLE AS net_amount_usd,
             sum(CASE WHEN country IN ('NATION_2', 'NATION_7')
                      THEN round((gross - disc) * 0.08::DECIMAL(4,2), 2) ELSE 0 END)::DOUBLE
               AS tax_amount_usd
      FROM (SELECT country, gross,
                   round(gross * l_discount::DECIMAL(4,2), 2)::DECIMAL(12,2) AS disc
            FROM (SELECT n_name AS country, l_discount, l_extendedprice::DECIMAL(12,2) AS gross
                  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
                  LEFT JOIN customer ON c_custkey = o_custkey
                  LEFT JOIN nation ON n_nationkey = c_nationkey))
      GROUP BY country"""),
    "billing_events": (("raw",), f"""
      SELECT event_id, user_id, plan_id, event_type, quantity::BIGINT AS quantity,
             gross::DOUBLE AS gross_amount_usd, discount::DOUBLE AS discount_amount_usd,
             tax::DOUBLE AS tax_amount_usd, net::DOUBLE AS net_amount_usd,
             delta::DOUBLE AS mrr_delta_usd, {_ts('ts')} AS event_timestamp
      FROM raw"""),
    "mrr_deltas": (("raw", "plans"), """
      SELECT event_id, event_type, (coalesce(target - held, 0))::DOUBLE AS mrr_delta_usd
      FROM (SELECT *, coalesce(last_value(target IGNORE NULLS) OVER (
                        PARTITION BY user_id ORDER BY ts, event_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held
            FROM (SELECT r.*, CASE WHEN event_type IN ('invoice_paid', 'upgrade') THEN p.mrr
                                   WHEN event_type = 'cancellation' THEN 0 END AS target
                  FROM raw r JOIN plans p USING (plan_id)))"""),
    "users_scd2": (("users",), f"SELECT {_USER_COLUMNS} FROM users"),
    "scd2_merge": (("merged",), f"SELECT {_USER_COLUMNS} FROM merged"),
    "scd2_merge_stored": (("merged",), f"SELECT {_USER_COLUMNS} FROM merged"),
    "scd2_merge_buckets": (("merged_last_days",), f"SELECT {_USER_COLUMNS} FROM merged_last_days"),
    "scd2_merge_log": (("batch", "numbered"), f"""
      SELECT user_id, tier AS subscription_tier, status AS account_status,
             {_ts('ts')} AS effective_ts, action,
             CASE WHEN action <> 'rejected' THEN coalesce(
               last_value(new_sk IGNORE NULLS) OVER (
                 PARTITION BY user_id ORDER BY ts, seq
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), o_sk) END AS user_sk
      FROM (SELECT b.*, n.user_sk AS new_sk,
                   CASE WHEN b.opened IS NOT NULL AND b.ts < b.opened THEN 'rejected'
                        WHEN n.user_sk IS NULL THEN 'kept'
                        WHEN n.before IS NULL THEN 'inserted' ELSE 'opened' END AS action
            FROM batch b LEFT JOIN numbered n ON n.user_id = b.user_id AND n.seq = b.seq)"""),
    "scd2_merge_rejects": (("batch",), f"""
      SELECT user_id, tier AS subscription_tier, status AS account_status,
             {_ts('ts')} AS effective_ts
      FROM batch WHERE ts < opened"""),
    "asof_user_version": (("raw", "users", "newest"), f"""
      SELECT event_id, user_sk, u.tier AS subscription_tier, u.status AS account_status,
             {_ts('u.start_date')} AS start_date
      FROM ({_asof('raw', 'e.ts', 'e.event_id')}) JOIN users u USING (user_sk)"""),
    "asof_fallback": (("raw", "users", "newest"),
                      _asof("raw", "(e.ts - INTERVAL 400 DAY)", "e.event_id")),
    "events_fact": (("ev",), f"SELECT {_EVENT_COLUMNS} FROM ev"),
    "asof_overlapping": (("raw", "terms"), f"""
      SELECT e.event_id, coalesce(min(t.user_sk) FILTER (t.start_date <= e.at AND e.at < t.end_date),
                                  max(t.user_sk)) AS user_sk,
             {_ts("""coalesce(arg_min(t.end_date, t.user_sk) FILTER (t.start_date <= e.at AND e.at < t.end_date),
                      arg_max(t.end_date, t.user_sk))""")} AS end_date
      FROM (SELECT *, ts + INTERVAL 9 DAY AS at FROM raw) e JOIN terms t USING (user_id)
      GROUP BY e.event_id"""),
    "events_append_twice": (("ev",), f"SELECT {_EVENT_COLUMNS} FROM ev"),
    "ranges_declared": (("raw",), """
      SELECT CASE WHEN ts >= TIMESTAMP '1996-01-01' AND ts < TIMESTAMP '1999-01-01'
                  THEN strftime(ts, '%Y_%m') ELSE 'default' END AS slice,
             count(*) AS events, sum(net)::DOUBLE AS revenue
      FROM raw GROUP BY 1"""),
    "events_between": (("ev",), f"""
      SELECT event_type, count(*) AS events, sum(net)::DOUBLE AS revenue,
             {_ts('min(ts)')} AS first_event, {_ts('max(ts)')} AS last_event
      FROM ev WHERE ts >= TIMESTAMP '1996-12-31 12:00:00' AND ts < TIMESTAMP '1998-03-01'
      GROUP BY event_type"""),
    "snapshot_extend": (("snap_sk",), f"SELECT {_SNAP_COLUMNS} FROM snap_sk"),
    "events_append": (("ev",), f"SELECT {_EVENT_COLUMNS} FROM ev"),
    "monthly_snapshot": (("snap_sk",), f"SELECT {_SNAP_COLUMNS} FROM snap_sk"),
    "mrr_waterfall": (("waterfall",), f"""
      SELECT * REPLACE ({_day('snapshot_date')} AS snapshot_date) FROM waterfall"""),
    "saas_metrics": (("metrics",), f"""
      SELECT * REPLACE ({_day('snapshot_date')} AS snapshot_date) FROM metrics"""),
    "cohort_retention": (("cohorts",), "SELECT * FROM cohorts"),
    "cohort_first_rows": (("cohorts",), """
      SELECT * FROM cohorts ORDER BY cohort_month_sk, month_offset LIMIT 25"""),
    "cohort_matrix": (("cohorts",), "SELECT cohort_month_sk, " + ", ".join(
        f"max(CASE WHEN month_offset = {k} THEN user_retention_rate_pct END) AS m{k}"
        for k in range(12 * YEARS)) + " FROM cohorts GROUP BY cohort_month_sk"),
    "ltv_arpu": (("ltv",), "SELECT * FROM ltv"),
    "ltv_charted": (("ltv",), """
      SELECT subscription_tier, modeled_ltv_usd FROM ltv WHERE modeled_ltv_usd > 0"""),
    "active_subscriptions": (("ev", "users", "plans"), f"""
      SELECT u.user_id, u.email, u.country, u.channel AS acquisition_channel,
             u.tier AS subscription_tier, u.status AS account_status, p.plan_code, p.plan_name,
             p.billing_interval, p.base_price_usd::DOUBLE AS current_plan_price,
             {_ts('u.start_date')} AS tier_effective_date,
             date_diff('day', u.start_date::DATE, DATE '2002-01-01') AS days_on_current_tier,
             r.paid::DOUBLE AS lifetime_paid_amount_usd, r.invoices AS total_successful_invoices
      FROM users u
      JOIN (SELECT user_sk, last(plan_sk ORDER BY ts, event_id) AS plan_sk, sum(net) AS paid,
                   count(*) FILTER (event_type = 'invoice_paid') AS invoices
            FROM ev GROUP BY user_sk) r USING (user_sk)
      JOIN plans p ON p.plan_sk = r.plan_sk
      WHERE u.is_current AND u.status = 'active'"""),
    "customer_journey": (("ev", "users", "plans"), f"""
      SELECT e.event_id, e.user_id, u.email, {_ts('e.ts')} AS event_timestamp,
             {_day('e.ts')} AS calendar_date, e.event_type, p.plan_name, p.billing_interval,
             e.net::DOUBLE AS net_amount_usd, e.delta::DOUBLE AS mrr_delta_usd,
             (sum(e.delta) OVER w)::DOUBLE AS running_user_mrr_usd,
             (sum(e.net) OVER w)::DOUBLE AS cumulative_cash_collected_usd,
             row_number() OVER w AS event_sequence_number
      FROM ev e JOIN users u USING (user_sk) JOIN plans p ON p.plan_sk = e.plan_sk
      WINDOW w AS (PARTITION BY e.user_id ORDER BY e.ts, e.event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
    "activity_journey": (("activity",), f"""
      SELECT event_id, user_id, {_ts('ts')} AS event_timestamp,
             (sum(delta) OVER w)::DOUBLE AS running_value,
             row_number() OVER w AS event_sequence_number
      FROM activity
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
    "month_rollup": (("raw",), _rollup("raw", "1998-06-01", "1998-07-01")),
    "month_rollup_partitioned": (("raw",), _rollup("raw", "1998-06-01", "1998-07-01")),
    "activity_month_rollup": (("activity",), _rollup("activity", "2024-01-01", "2024-02-01")),
    "annual_plan_revenue": (("ev", "dates", "plans"),
                            _quarters("d.year = 1998", "paying_users", "quarterly_revenue")),
    "paid_revenue_top15": (("ev", "dates", "plans"), _quarters(
        "e.event_type = 'invoice_paid'", "total_paying_users", "total_revenue_usd")
        + " ORDER BY year DESC, quarter_name DESC, total_revenue_usd DESC, plan_name LIMIT 15"),
    "star_sql": (("ev", "dates", "plans"), """
      SELECT d.year::BIGINT AS year, p.tier_level, count(*) AS events,
             sum(e.net)::DOUBLE AS revenue
      FROM ev e JOIN dates d ON d.calendar_date = e.ts::DATE
      JOIN plans p ON p.plan_sk = e.plan_sk
      WHERE e.event_type IN ('invoice_paid', 'upgrade') GROUP BY ALL"""),
    "waterfall_report": (("waterfall",), f"""
      SELECT month_id::VARCHAR AS month, {', '.join(f'{_usd(c)} AS {c}' for c in _WATERFALL_USD)},
             format('{{:,}}', active_subscribers) AS active_users,
             {_pct_text('mrr_growth_rate_pct')} AS mom_growth
      FROM {_trailing('waterfall')}"""),
    "metrics_report": (("metrics",), f"""
      SELECT month_id::VARCHAR AS month, {_usd('arpa_usd')} AS arpa,
             coalesce(format('{{:,.2f}}', saas_quick_ratio), '-') AS quick_ratio,
             {_pct_text('gross_revenue_churn_pct')} AS gross_revenue_churn,
             {_pct_text('net_revenue_retention_nrr_pct')} AS net_revenue_retention,
             {_pct_text('logo_churn_pct')} AS logo_churn
      FROM {_trailing('metrics')}"""),
    "ltv_report": (("ltv",), f"""
      SELECT upper(subscription_tier) AS tier, format('{{:,}}', total_customers) AS total_customers,
             format('{{:,}}', churned_customers) AS churned,
             {_usd('aggregate_tier_revenue_usd')} AS tier_revenue,
             {_usd('realized_arpu_per_customer_usd')} AS realized_arpu,
             format('{{:,.1f}}', avg_tenure_months) AS avg_tenure,
             {_pct_text('tier_churn_rate_pct')} AS churn_rate,
             {_usd('modeled_ltv_usd')} AS modeled_ltv
      FROM ltv"""),
    "headline": (("waterfall", "metrics"), """
      SELECT w.month_id, w.ending_mrr, w.ending_arr, w.active_subscribers, w.net_mrr_movement,
             w.mrr_growth_rate_pct, w.starting_mrr AS previous_ending_mrr, m.saas_quick_ratio,
             m.net_revenue_retention_nrr_pct, m.gross_revenue_churn_pct, m.arpa_usd
      FROM (SELECT * FROM waterfall ORDER BY month_id DESC LIMIT 1) w,
           (SELECT * FROM metrics ORDER BY month_id DESC LIMIT 1) m"""),
    "mrr_movement_long": (("waterfall",), " UNION ALL ".join(
        f"SELECT month_id, {_day('snapshot_date')} AS snapshot_date, '{n}' AS component, "
        f"{x} AS amount_usd FROM waterfall"
        for n, x in [("new", "new_mrr"), ("expansion", "expansion_mrr"),
                     ("contraction", "0 - contraction_mrr"), ("churned", "0 - churned_mrr"),
                     ("ending", "ending_mrr")])),
    "partition_slices": (("raw",), """
      SELECT CASE WHEN ts >= TIMESTAMP '1996-01-01' AND ts < TIMESTAMP '2000-01-01'
                  THEN strftime(ts, '%Y_%m') ELSE 'default' END AS slice,
             count(*) AS events, sum(net)::DOUBLE AS revenue
      FROM raw GROUP BY 1"""),
    "dunning_recovery": (("activity",), f"""
      SELECT f.user_id, f.event_id AS failed_event_id, {_ts('f.ts')} AS failed_at,
             p.event_id AS recovery_event_id, {_ts('p.ts')} AS recovered_at,
             p.net::DOUBLE AS recovered_usd, p.event_id IS NOT NULL AS is_recovered
      FROM (SELECT * FROM activity WHERE event_type = 'payment_failed') f
      LEFT JOIN (SELECT * FROM activity WHERE event_type = 'invoice_paid') p
        ON p.user_id = f.user_id AND p.ts > f.ts AND p.ts <= f.ts + INTERVAL 2 DAY
      QUALIFY row_number() OVER (PARTITION BY f.event_id ORDER BY p.ts, p.event_id) = 1"""),
    "billing_dunning": (("raw",), f"""
      SELECT count(*) AS failures, count(paid_at) AS recovered,
             sum(CASE WHEN paid_at IS NOT NULL THEN paid_net END)::DOUBLE AS recovered_usd,
             {_pct('count(paid_at)', 'count(*)')} AS recovery_rate_pct
      FROM (SELECT f.event_id, min(p.ts) AS paid_at, arg_min(p.net, p.ts) AS paid_net
            FROM raw f LEFT JOIN raw p ON p.user_id = f.user_id AND p.event_type = 'invoice_paid'
                 AND p.ts > f.ts AND p.ts <= f.ts + INTERVAL 60 DAY
            WHERE f.event_type = 'payment_failed' GROUP BY f.event_id)"""),
    "table_row_counts": (("dates", "plans", "users", "ev", "snap"), """
      SELECT 'dim_date' AS table_name, count(*) AS rows FROM dates
      UNION ALL SELECT 'dim_subscription_plan', count(*) FROM plans
      UNION ALL SELECT 'dim_users', count(*) FROM users
      UNION ALL SELECT 'fact_subscription_events', count(*) FROM ev
      UNION ALL SELECT 'fact_monthly_financial_snapshot', count(*) FROM snap"""),
    "dq_unique_keys": ((), """
      SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS rows
      FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""),
    "dq_orphans": ((), """
      SELECT o_orderkey, count(*) AS rows FROM orders
      WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 1"""),
    "dq_not_null": (("users",), """
      SELECT 'end_date' AS column_name, count(*) AS nulls FROM users WHERE end_date IS NULL"""),
    "dq_expired_without_end": (("terms",), """
      SELECT user_id, user_sk FROM terms WHERE NOT is_current AND user_sk % 5 = 0"""),
    "dq_ends_before_start": (("terms",), f"""
      SELECT user_id, user_sk, {_ts('start_date')} AS start_date,
             {_ts('(start_date - INTERVAL 1 DAY)')} AS end_date
      FROM terms WHERE user_sk % 3 = 0"""),
    "dq_snapshot_orphans": (("snap", "plans"), """
      SELECT plan_sk, count(*) AS rows FROM snap
      WHERE plan_sk IN (SELECT plan_sk FROM plans WHERE billing_interval <> 'monthly')
      GROUP BY plan_sk"""),
    "dq_month_user_unique": (("raw",), """
      SELECT (year(ts) * 100 + month(ts))::BIGINT AS month, user_id, count(*) AS rows
      FROM raw GROUP BY 1, 2 HAVING count(*) > 1"""),
    "dq_declared_nulls": (("raw",), """
      SELECT 'event_type' AS column_name, count(*) AS nulls FROM raw WHERE event_type = 'refund'
      HAVING count(*) > 0
      UNION ALL SELECT 'plan_id', count(*) FROM raw WHERE event_type = 'cancellation'
      HAVING count(*) > 0"""),
    "dq_natural_keys": ((), f"""
      SELECT {_day('o_orderdate')} AS calendar_date, count(*) AS rows
      FROM orders GROUP BY o_orderdate HAVING count(*) > 1"""),
    "dq_event_key": ((), """
      SELECT user_id::VARCHAR AS user_id,
             CASE event_type WHEN 'error' THEN 'payment_failed' WHEN 'purchase' THEN 'invoice_paid'
                  ELSE event_type END AS event_type, count(*) AS rows
      FROM events GROUP BY 1, 2 HAVING count(*) > 1"""),
    "dq_single_current": (("terms",), """
      SELECT user_id, count(*) FILTER (is_current) AS current_versions FROM terms
      GROUP BY user_id HAVING count(*) FILTER (is_current) <> 1"""),
    "dq_scd2_intervals": (("terms",), f"""
      SELECT user_id, user_sk, {_ts('start_date')} AS start_date, {_ts('end_date')} AS end_date,
             {_ts('next_start')} AS next_start
      FROM (SELECT *, lead(start_date) OVER (PARTITION BY user_id ORDER BY start_date, user_sk)
                        AS next_start FROM terms)
      WHERE next_start IS NOT NULL AND end_date <> next_start"""),
    "dq_arr_identity": (("snap", "plans"), """
      SELECT month_sk AS snapshot_month_sk, user_id, mrr::DOUBLE AS mrr_usd,
             listed::DOUBLE AS arr_usd
      FROM (SELECT s.*, CASE WHEN billing_interval = 'annual' THEN base_price_usd
                             ELSE base_price_usd * 12 END AS listed
            FROM snap s JOIN plans USING (plan_sk))
      WHERE abs(listed - mrr * 12) >= 0.05"""),
    "dq_waterfall_identity": (("snap",), """
      SELECT month_sk AS snapshot_month_sk, expected::DOUBLE AS expected, actual::DOUBLE AS actual
      FROM (SELECT month_sk, actual, coalesce(lag(actual) OVER (ORDER BY month_sk), 0) + moved
                     AS expected
            FROM (SELECT month_sk, sum(mrr) AS actual,
                         sum(new_mrr + expansion - contraction) AS moved
                  FROM snap GROUP BY month_sk))
      WHERE abs(expected - actual) >= 0.10"""),
    "dq_cumulative_monotone": (("snap_refunds",), """
      SELECT user_id, snapshot_month_sk, cumulative_revenue_usd, previous_usd
      FROM (SELECT user_id, month_sk AS snapshot_month_sk,
                   cumulative::DOUBLE AS cumulative_revenue_usd,
                   (lag(cumulative) OVER (PARTITION BY user_id ORDER BY month_sk))::DOUBLE
                     AS previous_usd FROM snap_refunds)
      WHERE cumulative_revenue_usd < previous_usd"""),
    "run_checks": (("raw_refunds", "ev_refunds", "snap_refunds_sk", "users", "dates", "plans"), """
      SELECT * FROM (WITH d AS (SELECT * FROM dates WHERE year >= 1997),
      p AS (SELECT * FROM plans WHERE billing_interval = 'monthly'),
      u AS (SELECT * REPLACE (CASE WHEN user_sk % 7 <> 0 THEN email END AS email)
            FROM users WHERE user_sk % 10 <> 0),
      e0 AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS event_sk FROM ev_refunds),
      e AS (SELECT * FROM e0 UNION ALL SELECT * FROM e0 WHERE event_sk % 8 = 0),
      s AS (SELECT *, CASE WHEN month_sk % 100 = 12 THEN mrr ELSE arr END AS arr_given
            FROM snap_refunds_sk),
      per_user AS (
        SELECT user_id, count(*) FILTER (is_current) AS current,
               count(*) FILTER (next_start IS NOT NULL AND end_date IS DISTINCT FROM next_start)
                 AS broken
        FROM (SELECT *, lead(start_date) OVER (PARTITION BY user_id ORDER BY start_date, user_sk)
                          AS next_start FROM u) GROUP BY user_id),
      months AS (
        SELECT month_sk, sum(mrr) AS actual, sum(new_mrr + expansion - contraction - churned) AS moved
        FROM s GROUP BY 1)
      SELECT 'declared columns present' AS check_name,
             (count(email) < count(*))::BIGINT AS violations FROM u
      UNION ALL SELECT 'surrogate keys present', 0
      UNION ALL SELECT 'events within the ranges', count(*) FROM e
        WHERE NOT (ts >= TIMESTAMP '1996-01-01' AND ts < TIMESTAMP '2000-01-01')
      UNION ALL SELECT unnest(['date_sk unique', 'plan_sk unique', 'user_sk unique',
        'calendar_date unique', 'plan_id unique', 'snapshot per month and user unique',
        'expired versions end', 'versions end after start']), 0
      UNION ALL SELECT 'event key unique', count(*) FROM e0 WHERE event_sk % 8 = 0
      UNION ALL SELECT 'event user exists', count(DISTINCT user_sk) FROM e
        WHERE user_sk NOT IN (SELECT user_sk FROM u)
      UNION ALL SELECT 'event plan exists', count(DISTINCT plan_sk) FROM e
        WHERE plan_sk NOT IN (SELECT plan_sk FROM p)
      UNION ALL SELECT 'event date exists', count(DISTINCT ts::DATE) FROM e
        WHERE ts::DATE NOT IN (SELECT calendar_date FROM d)
      UNION ALL SELECT 'snapshot user exists', count(DISTINCT user_sk) FROM s
        WHERE user_sk NOT IN (SELECT user_sk FROM u)
      UNION ALL SELECT 'snapshot plan exists', count(DISTINCT plan_sk) FROM s
        WHERE plan_sk NOT IN (SELECT plan_sk FROM p)
      UNION ALL SELECT 'one current version', count(*) FROM per_user WHERE current <> 1
      UNION ALL SELECT 'versions are contiguous', sum(broken)::BIGINT FROM per_user
      UNION ALL SELECT 'ARR is twelve MRR', count(*) FROM s WHERE abs(arr_given - mrr * 12) >= 0.05
      UNION ALL SELECT 'waterfall adds up', count(*) FROM (
        SELECT actual, coalesce(lag(actual) OVER (ORDER BY month_sk), 0) + moved AS expected
        FROM months) WHERE abs(expected - actual) >= 0.10
      UNION ALL SELECT 'cumulative revenue never falls', count(*) FROM (
        SELECT cumulative < lag(cumulative) OVER (PARTITION BY user_id ORDER BY month_sk) AS falls
        FROM s) WHERE falls)"""),
    "star_end_to_end": (("ev", "raw", "users", "plans", "snap"), """
      SELECT h.*, b.raw_events, b.raw_revenue, j.journey_events, j.longest_journey,
             coalesce(a.active_users, 0) AS active_users,
             (SELECT sum(mrr)::DOUBLE FROM snap
              WHERE month_sk = (SELECT max(month_sk) FROM snap)) AS ending_mrr
      FROM (SELECT e.event_type, u.country, count(*) AS events, count(DISTINCT u.user_id) AS users,
                   sum(e.net)::DOUBLE AS revenue, max(p.tier_level) AS highest_tier
            FROM ev e JOIN users u USING (user_sk) JOIN plans p ON p.plan_sk = e.plan_sk
            GROUP BY ALL) h
      JOIN (SELECT event_type, count(*) AS raw_events, sum(net)::DOUBLE AS raw_revenue
            FROM raw GROUP BY 1) b USING (event_type)
      JOIN (SELECT event_type, count(*) AS journey_events, max(place) AS longest_journey
            FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place
                  FROM ev) GROUP BY 1) j USING (event_type)
      LEFT JOIN (SELECT country, count(*) AS active_users FROM users
                 WHERE is_current AND status = 'active' AND user_sk IN (SELECT user_sk FROM ev)
                 GROUP BY 1) a USING (country)
      WHERE h.event_type <> 'refund'"""),
    "console_top15": (("ev", "dates", "plans"), "SELECT *, true AS more FROM (" + _quarters(
        "e.event_type = 'invoice_paid'", "total_paying_users", "total_revenue_usd")
        + ") ORDER BY year DESC, quarter_name DESC, total_revenue_usd DESC, plan_name LIMIT 9"),
    "dq_outside_ranges": (("raw",), f"""
      SELECT event_id, {_ts('ts')} AS event_timestamp FROM raw
      WHERE NOT (ts >= TIMESTAMP '1996-01-01' AND ts < TIMESTAMP '2000-01-01')"""),
}


def oracle_sql() -> dict[str, str]:
    return {name: _with(needs, sql) for name, (needs, sql) in QUERIES.items()}
