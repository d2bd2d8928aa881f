"""Grouped fraud statistics. Missing keys are left out; totals count known labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.functions.numbers import percent


def fraud_by(df: DataFrame, **keys: str) -> DataFrame:
    """Fraud, total and rate per key; ``keys`` maps output names to columns."""
    known = df
    for column in keys.values():
        known = known.where(F.col(column).isNotNull())
    fraud, total = F.count_if(F.col("is_fraud")), F.count("is_fraud")
    return known.groupBy(*[F.col(column).alias(name) for name, column in keys.items()]).agg(
        fraud.alias("fraud_count"), total.alias("total_count"), percent(fraud, total).alias("fraud_rate")
    )


def fraud_trends(df: DataFrame) -> DataFrame:
    """Per day, oldest first."""
    daily = fraud_by(df, date="txn_date")
    return daily.withColumn("non_fraud_count", F.col("total_count") - F.col("fraud_count")).orderBy("date")


def geographic_analysis(df: DataFrame) -> DataFrame:
    return fraud_by(df, country="country_std").orderBy(F.desc_nulls_last("fraud_rate"), "country")


def channel_analysis(df: DataFrame) -> DataFrame:
    return fraud_by(df, channel="channel_std").orderBy(F.desc_nulls_last("fraud_rate"), "channel")


def hourly_patterns(df: DataFrame) -> DataFrame:
    return fraud_by(df.withColumn("_hour", F.hour("txn_ts")), hour="_hour").orderBy("hour")


def top_risky_merchants(df: DataFrame, top_n: int = 20) -> DataFrame:
    stats = fraud_by(df, merchant_id="merchant_id_clean", risk_tier="merchant_risk_tier")
    return stats.orderBy(F.desc("fraud_count"), "merchant_id", "risk_tier").limit(top_n)


def top_risky_cards(df: DataFrame, top_n: int = 20) -> DataFrame:
    """Cards by fraud count with amount and mean score (0.5 when not scored).

    Without a card column: the transactions with the highest score.
    """
    if "card_id_clean" not in df.columns:
        return df.orderBy(F.desc_nulls_last("risk_score"), "txn_id_clean").limit(top_n).select(
            F.col("txn_id_clean").alias("transaction_id"), "risk_score", "is_fraud", "amount"
        )
    score = F.avg("risk_score") if "risk_score" in df.columns else F.lit(0.5)
    fraud, total = F.count_if(F.col("is_fraud")), F.count("is_fraud")
    stats = df.where(F.col("card_id_clean").isNotNull()).groupBy(F.col("card_id_clean").alias("card_id")).agg(
        fraud.alias("fraud_count"), total.alias("total_count"),
        F.coalesce(F.sum("amount"), F.lit(0)).alias("total_amount"), score.alias("avg_risk_score"),
        percent(fraud, total).alias("fraud_rate"),
    )
    return stats.orderBy(F.desc("fraud_count"), "card_id").limit(top_n)
