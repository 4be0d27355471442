-- What was billed against what the star holds of it, by country of the user's version.
WITH billed AS (
    SELECT event_type, count(*) AS raw_events, sum(net_amount_usd) AS raw_revenue
    FROM raw_billing
    GROUP BY event_type
),
journeys AS (
    SELECT event_type, count(*) AS journey_events, max(event_sequence_number) AS longest_journey
    FROM vw_customer_journey
    GROUP BY event_type
),
held AS (
    SELECT f.event_type, u.country, count(*) AS events, count(DISTINCT u.user_id) AS users,
           sum(f.net_amount_usd) AS revenue, max(p.tier_level) AS highest_tier
    FROM fact_subscription_events f
    JOIN dim_users u ON u.user_sk = f.user_sk
    JOIN dim_subscription_plan p ON p.plan_sk = f.plan_sk
    JOIN dim_date d ON d.date_sk = f.date_sk
    GROUP BY f.event_type, u.country
)
SELECT h.event_type, h.country, h.events, h.users, h.revenue, h.highest_tier,
       b.raw_events, b.raw_revenue, j.journey_events, j.longest_journey,
       (SELECT count(*) FROM vw_active_subscriptions a WHERE a.country = h.country) AS active_users,
       (SELECT sum(mrr_usd) FROM fact_monthly_financial_snapshot
        WHERE snapshot_month_sk = (SELECT max(snapshot_month_sk)
                                   FROM fact_monthly_financial_snapshot)) AS ending_mrr
FROM held h JOIN billed b USING (event_type) JOIN journeys j USING (event_type)
WHERE h.event_type <> :left_out
