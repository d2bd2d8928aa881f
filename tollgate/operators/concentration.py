"""How fraud concentrates on merchants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.operators.ranking import unique_positions

PARETO_PCT = 80


def merchant_totals(df: DataFrame) -> DataFrame:
    """Transactions, fraud and fraud rate per merchant; rows need a merchant and a label."""
    known = df.where(F.col("merchant_id_clean").isNotNull() & F.col("is_fraud").isNotNull())
    fraud, total = F.count_if(F.col("is_fraud")), F.count(F.lit(1))
    return known.groupBy("merchant_id_clean").agg(
        total.alias("total_txns"), fraud.alias("total_fraud_txns"), (fraud / total * 100).alias("fraud_rate")
    )


def pareto(df: DataFrame) -> DataFrame:
    """Merchants by falling fraud count with rank (from 1) and cumulative share of all fraud."""
    ranked = unique_positions(merchant_totals(df), "total_fraud_txns", "merchant_id_clean")
    share = F.col("running_key") / F.nullif(F.col("total_key"), F.lit(0)) * 100
    return ranked.select(
        "merchant_id_clean", "total_txns", "total_fraud_txns", "fraud_rate",
        share.alias("cumulative_fraud_pct"), (F.col("position") + 1).alias("merchant_rank"),
    )


def top_merchants(df: DataFrame, top_n: int = 20) -> DataFrame:
    return pareto(df).where(F.col("merchant_rank") <= top_n).orderBy("merchant_rank")


def top_share(df: DataFrame, top_n: int = 20) -> DataFrame:
    """Fraud at the first ``top_n`` merchants and its share of all fraud."""
    top = F.when(F.col("merchant_rank") <= top_n, F.col("total_fraud_txns"))
    return pareto(df).agg(
        F.coalesce(F.sum(top), F.lit(0)).alias("top_fraud_txns"),
        (F.coalesce(F.sum(top), F.lit(0)) / F.nullif(F.sum("total_fraud_txns"), F.lit(0)) * 100).alias("top_fraud_pct"),
    )


def concentration(df: DataFrame) -> DataFrame:
    """The 80 % point and the shares reached at rank 10 and 50."""
    share, rank = F.col("cumulative_fraud_pct"), F.col("merchant_rank")
    within = share <= PARETO_PCT
    merchants = F.count(F.lit(1))

    def share_at(n: int):
        return F.max(F.when(rank <= n, share)).alias(f"top_{n}_pct")

    return pareto(df).agg(
        merchants.alias("merchants"),
        F.count_if(within).alias("p80_merchants"),
        F.max(F.when(within, rank)).alias("p80_rank"),
        F.max(F.when(within, share)).alias("p80_share_pct"),
        (F.count_if(within) / F.nullif(merchants, F.lit(0)) * 100).alias("p80_merchant_pct"),
        share_at(10), share_at(50),
    )
