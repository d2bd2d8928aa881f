"""Optional filters of an investigation view, their options and date bounds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EVERYTHING = "All"
OPTION_COLUMNS = {
    "merchant_risk_tiers": "merchant_risk_tier",
    "channels": "channel_std",
    "countries": "country_std",
}
FRAUD_CHOICES = {"Fraud Only": True, "Non-Fraud Only": False}


def filter_condition(df: DataFrame, date_start: dt.date | str | None = None, date_end: dt.date | str | None = None,
                     merchant_risk_tier: str | None = None, channel: str | None = None,
                     country: str | None = None, fraud: str | None = None) -> Column:
    """The conjunction of the given filters; dates are inclusive.

    None, "All", and filters on columns the frame lacks do not restrict anything.
    """
    conditions = []
    if "txn_date" in df.columns:
        if date_start:
            conditions.append(F.col("txn_date") >= F.lit(date_start).cast("date"))
        if date_end:
            conditions.append(F.col("txn_date") <= F.lit(date_end).cast("date"))
    equal = {"merchant_risk_tier": merchant_risk_tier, "channel_std": channel, "country_std": country}
    for column, value in equal.items():
        if value and value != EVERYTHING and column in df.columns:
            conditions.append(F.col(column) == value)
    if fraud in FRAUD_CHOICES and "is_fraud" in df.columns:
        conditions.append(F.col("is_fraud") == FRAUD_CHOICES[fraud])
    combined = F.lit(True)
    for condition in conditions:
        combined = combined & condition
    return combined


def apply_filters(df: DataFrame, **filters) -> DataFrame:
    return df.where(filter_condition(df, **filters))


def filter_options(df: DataFrame) -> DataFrame:
    """Distinct values per filter, sorted: one row each, found in one grouped pass."""
    pairs = [
        F.struct(F.lit(name).alias("filter_name"), F.col(column).alias("option_value"))
        for name, column in OPTION_COLUMNS.items() if column in df.columns
    ]
    if not pairs:
        return df.sparkSession.createDataFrame([], "filter_name string, option_value string")
    options = df.select(F.inline(F.array(*pairs))).where(F.col("option_value").isNotNull())
    return options.distinct().orderBy("filter_name", "option_value")


def date_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min("txn_date").alias("date_min"), F.max("txn_date").alias("date_max"))
