"""Pricing rules: plan price to MRR, invoice amounts, tier of a plan code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Sales tax rate and the countries it applies to.
TAX_RATE = "0.08"
TAXED_COUNTRIES = ("United States", "Canada")


def monthly_mrr(price: Column, interval: Column) -> Column:
    """Monthly share of a plan price: a twelfth, to the cent, of an annual one."""
    share = F.when(interval == "annual", price / F.lit(12)).otherwise(price)
    return F.round(share, 2).cast("decimal(12,2)")


def tier_of(plan_code: Column) -> Column:
    """``PRO_ANNUAL`` -> ``pro``."""
    return F.lower(F.split(plan_code, "_")[0])


def price_invoice(
    df: DataFrame,
    gross: Column,
    discount_rate: Column,
    country: Column,
    tax_rate: str = TAX_RATE,
    taxed: Sequence[str] = TAXED_COUNTRIES,
) -> DataFrame:
    """Add gross, discount, net and tax amounts; the tax is on the net amount."""
    money = "decimal(12,2)"
    return (
        df.withColumn("gross_amount_usd", gross.cast(money))
        .withColumn(
            "discount_amount_usd",
            F.round(F.col("gross_amount_usd") * discount_rate.cast("decimal(4,2)"), 2).cast(money),
        )
        .withColumn(
            "net_amount_usd",
            (F.col("gross_amount_usd") - F.col("discount_amount_usd")).cast(money),
        )
        .withColumn(
            "tax_amount_usd",
            F.when(
                country.isin(*taxed),
                F.round(F.col("net_amount_usd") * F.lit(tax_rate).cast("decimal(4,2)"), 2),
            ).otherwise(F.lit(0)).cast(money),
        )
    )
