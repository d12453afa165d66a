"""Ratios that are null on a zero denominator, and the insurance indicators built on them."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.functions.scalar import as_column

# fixed column names of the twelve liability terms
LIABILITY_TERMS = (
    "deposited_margin", "prepaid_premium", "insurance_security_fund",
    "unexpired_liability_reserve", "life_insurance_liability_reserve",
    "long_term_health_insurance_liability_reserve", "payable_claims",
    "payable_policy_dividends", "unpaid_claims_reserve", "payable_reinsurance_accounts",
    "policyholder_deposits_and_investment_funds", "satellite_launch_insurance_fund",
)

# fixed business type names: property, life, property reinsurance, life reinsurance
BUSINESS_TYPES = ("财险业务", "人身险业务", "再保财险业务", "再保人身险业务")


def safe_ratio(num: Column | str, den: Column | str, scale: int = 1) -> Column:
    num, den = as_column(num), as_column(den)
    ratio = num / F.when(den != 0, den)
    return ratio * F.lit(scale) if scale != 1 else ratio


def insurance_ratios(df: DataFrame, keys=("company_id", "business_type"),
                     types=BUSINESS_TYPES) -> DataFrame:
    liabilities = reduce(add, (F.col(c) for c in LIABILITY_TERMS))
    both = F.col("total_liabilities") + F.col("owner_equity")
    return df.where(F.col("business_type").isin(*types)).select(
        *keys,
        safe_ratio("unpaid_claims_reserve", "owner_equity").alias("unpaid_claims_reserve_to_equity_ratio"),
        liabilities.alias("insurance_liabilities"),
        both.alias("total_liabilities_and_equity"),
        safe_ratio(liabilities, both, 100).alias("insurance_liability_ratio"),
    )


def liability_share(df: DataFrame, types=BUSINESS_TYPES) -> DataFrame:
    """The second form: no company and no reserve ratio."""
    return insurance_ratios(df, ("business_type",), types).select(
        "business_type",
        F.col("insurance_liabilities").alias("insurance_liability"),
        "total_liabilities_and_equity",
        "insurance_liability_ratio",
    )


def solvency_ratios(df: DataFrame, types=BUSINESS_TYPES) -> DataFrame:
    assets, owed = F.col("admitted_assets"), F.col("admitted_liabilities")
    begin, end = F.col("beginning_actual_capital"), F.col("ending_actual_capital")
    return df.where(F.col("business_type").isin(*types)).select(
        "business_type",
        safe_ratio(assets - owed, "minimum_capital", 100).alias("solvency_ratio"),
        safe_ratio(end - begin, begin, 100).alias("actual_capital_change_rate"),
        safe_ratio(owed, assets, 100).alias("admitted_asset_liability_ratio"),
    )
