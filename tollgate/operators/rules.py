"""Rule score, risk bands, scenario fraud prior."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions.numbers import clip

HIGH_FROM = 0.6
MEDIUM_FROM = 0.3


def rule_score(df: DataFrame) -> Column:
    """0-100 points from the signals the frame has; a missing value is neutral."""
    have = set(df.columns)
    parts: list[Column] = []

    def number(name: str, neutral: float) -> Column:
        return F.coalesce(F.col(name).cast("double"), F.lit(neutral))

    def flag(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(False)).cast("int")

    if "txns_last_24h" in have:
        parts.append(clip(number("txns_last_24h", 0.0) / 30.0 * 25, 0, 25))
    if "amount_vs_card_avg" in have:
        parts.append(clip((F.abs(number("amount_vs_card_avg", 1.0)) - 1.0) * 10, 0, 20))
    if "is_high_risk_merchant" in have:
        parts.append(flag("is_high_risk_merchant") * 15)
    if "is_emulator_device" in have:
        parts.append(flag("is_emulator_device") * 15)
    if "merchant_fraud_rate_30d" in have:
        parts.append(clip(number("merchant_fraud_rate_30d", 0.0) / 0.5 * 15, 0, 15))
    if "declined_txns_last_24h" in have:
        parts.append(clip(number("declined_txns_last_24h", 0.0) / 5.0 * 10, 0, 10))
    score = F.lit(0.0)
    for part in parts:
        score = score + part
    return clip(score, 0, 100)


def risk_band(score: Column) -> Column:
    return F.when(score >= HIGH_FROM, "HIGH").when(score >= MEDIUM_FROM, "MEDIUM").otherwise("LOW")


def with_band(df: DataFrame) -> DataFrame:
    return df.withColumn("risk_band", risk_band(F.col("risk_score")))


def score_by_rules(df: DataFrame) -> DataFrame:
    """Add ``risk_score`` (rule points over 100) and ``risk_band``."""
    return with_band(df.withColumn("risk_score", rule_score(df) / 100.0))


def scenario_prior(df: DataFrame) -> DataFrame:
    """Add ``fraud_prior``: the scenario probability of fraud from amount, merchant, device and country."""
    amount = F.coalesce(F.col("amount").cast("double"), F.lit(0.0))
    tier = F.upper(F.coalesce("merchant_risk_tier", F.lit("LOW")))
    foreign = F.col("country_std").isNotNull() & (F.col("country_std") != "IN")
    emulator = F.coalesce(F.col("is_emulator") == 1, F.lit(False))
    prior = (
        F.lit(0.003)
        + F.when(amount > 10000, 0.03).otherwise(0.0)
        + F.when(amount > 50000, 0.07).otherwise(0.0)
        + F.when(tier == "HIGH", 0.04).when(tier == "MEDIUM", 0.01).otherwise(0.0)
        + F.when(emulator, 0.03).otherwise(0.0)
        + F.when(foreign, 0.02).otherwise(0.0)
    )
    return df.withColumn("fraud_prior", F.least(prior, F.lit(0.3)))
