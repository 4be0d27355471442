"""Declared schemas of the star, and conforming a frame to one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

PRICE = T.DecimalType(10, 2)
MONEY = T.DecimalType(12, 2)
CUMULATIVE = T.DecimalType(14, 2)


def _schema(required: dict[str, T.DataType], optional: dict[str, T.DataType] | None = None):
    fields = [T.StructField(n, t, False) for n, t in required.items()]
    fields += [T.StructField(n, t, True) for n, t in (optional or {}).items()]
    return T.StructType(fields)


_STR, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
_BOOL, _DATE, _TS = T.BooleanType(), T.DateType(), T.TimestampNTZType()

DIM_DATE = _schema({
    "date_sk": _INT, "calendar_date": _DATE, "year": _INT, "quarter": _INT,
    "quarter_name": _STR, "month": _INT, "month_name": _STR, "month_year": _STR,
    "day_of_month": _INT, "day_of_week": _INT, "day_name": _STR, "is_weekend": _BOOL,
    "is_month_start": _BOOL, "is_month_end": _BOOL, "fiscal_quarter": _STR,
    "fiscal_year": _INT,
})

DIM_PLAN = _schema({
    "plan_sk": _INT, "plan_id": _STR, "plan_code": _STR, "plan_name": _STR,
    "billing_interval": _STR, "tier_level": _INT, "base_price_usd": PRICE,
    "seat_limit": _INT, "is_active": _BOOL,
})

# The history a user frame starts from: one row per observed state.
USER_STATE = _schema({
    "user_id": _STR, "email": _STR, "country": _STR, "acquisition_channel": _STR,
    "billing_currency": _STR, "subscription_tier": _STR, "account_status": _STR,
    "effective_ts": _TS,
})

# The same with what orders states of one instant, such as the event's id.
SEQUENCED_STATE = T.StructType([*USER_STATE.fields, T.StructField("sequence", _STR, True)])

DIM_USERS = T.StructType([
    T.StructField("user_sk", _LONG, False),
    *[f for f in USER_STATE.fields if f.name != "effective_ts"],
    T.StructField("start_date", _TS, False),
    T.StructField("end_date", _TS, True),
    T.StructField("is_current", _BOOL, False),
])

_AMOUNTS = {
    "gross_amount_usd": MONEY, "discount_amount_usd": MONEY, "tax_amount_usd": MONEY,
    "net_amount_usd": MONEY, "mrr_delta_usd": MONEY,
}

RAW_EVENT = _schema({
    "event_id": _STR, "user_id": _STR, "plan_id": _STR, "event_type": _STR,
    "quantity": _INT, **_AMOUNTS, "event_timestamp": _TS,
})

FACT_EVENTS = _schema({
    "event_sk": _LONG, "event_id": _STR, "user_sk": _LONG, "plan_sk": _INT,
    "date_sk": _INT, "event_type": _STR, "quantity": _INT, **_AMOUNTS,
    "event_timestamp": _TS,
})

FACT_SNAPSHOT = _schema({
    "snapshot_sk": _LONG, "snapshot_month_sk": _INT, "snapshot_date": _DATE,
    "user_sk": _LONG, "user_id": _STR, "plan_sk": _INT, "is_active_subscriber": _BOOL,
    "mrr_usd": MONEY, "arr_usd": MONEY, "new_mrr_usd": MONEY, "expansion_mrr_usd": MONEY,
    "contraction_mrr_usd": MONEY, "churned_mrr_usd": MONEY, "net_mrr_movement_usd": MONEY,
    "discount_applied_usd": MONEY, "cumulative_revenue_usd": CUMULATIVE,
})

STAR = {
    "dim_date": DIM_DATE,
    "dim_subscription_plan": DIM_PLAN,
    "dim_users": DIM_USERS,
    "fact_subscription_events": FACT_EVENTS,
    "fact_monthly_financial_snapshot": FACT_SNAPSHOT,
}

# Column defaults applied when a source leaves the value out.
DEFAULTS = {
    "billing_currency": "USD", "quantity": 1, "is_active": True,
    **{name: 0 for name in _AMOUNTS},
    **{f.name: 0 for f in FACT_SNAPSHOT.fields if f.name.endswith("_usd")},
}


def with_load_time(df: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Add ``created_at``: the load time given, else the time the query runs."""
    now = F.localtimestamp() if loaded_at is None else loaded_at
    return df.withColumn("created_at", now.cast("timestamp_ntz"))


def enforce_schema(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Project ``df`` onto ``schema``: order, types and defaults for missing or NULL values."""
    defaults = DEFAULTS if defaults is None else defaults
    columns = []
    for field in schema.fields:
        present = field.name in df.columns
        if not present and field.name not in defaults and not field.nullable:
            raise ValueError(f"column {field.name} is required")
        value = F.col(field.name) if present else F.lit(None)
        value = value.cast(field.dataType)
        if field.name in defaults:
            value = F.coalesce(value, F.lit(defaults[field.name]).cast(field.dataType))
        columns.append(value.alias(field.name))
    return df.select(*columns)
