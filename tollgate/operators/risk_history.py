"""Thirty-day fraud and decline history of cards and merchants.

Rows are added up per key and day before the shuffle, so a busy merchant costs one row
a day. The rolling windows run over those daily rows only: a window partition is never
longer than the number of calendar days in the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.schemas import RISK_HISTORY

WINDOW_DAYS = 30
RATE_DIGITS = 9


def daily_rates(df: DataFrame, key: str) -> DataFrame:
    """Per key and day: transactions, fraud rate, decline rate. An unknown label counts as not fraud."""
    known = df.where(F.col(key).isNotNull() & F.col("txn_ts").isNotNull())
    count = F.count(F.lit(1))
    return known.groupBy(key, F.to_date("txn_ts").alias("day")).agg(
        count.alias("txn_count"),
        (F.count_if(F.col("is_fraud")) / count).alias("fraud_rate"),
        (F.count_if(F.col("is_declined")) / count).alias("decline_rate"),
    )


def rolling_history(daily: DataFrame, key: str, prefix: str) -> DataFrame:
    """Day and the 30 before it: summed counts, plain mean of the daily rates."""
    day_number = F.datediff("day", F.lit("1970-01-01").cast("date"))
    month = Window.partitionBy(key).orderBy("day_number").rangeBetween(-WINDOW_DAYS, Window.currentRow)
    return daily.withColumn("day_number", day_number).select(
        key,
        "day",
        F.sum("txn_count").over(month).alias(f"{prefix}_txn_count_30d"),
        F.round(F.avg("fraud_rate").over(month), RATE_DIGITS).alias(f"{prefix}_fraud_rate_30d"),
        F.round(F.avg("decline_rate").over(month), RATE_DIGITS).alias(f"{prefix}_decline_rate_30d"),
    )


def card_history(df: DataFrame) -> DataFrame:
    return rolling_history(daily_rates(df, "card_id_clean"), "card_id_clean", "card")


def merchant_history(df: DataFrame) -> DataFrame:
    return rolling_history(daily_rates(df, "merchant_id_clean"), "merchant_id_clean", "merchant")


def join_history(df: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Attach a key's history on the day of the transaction; 0 where there is none."""
    facts = history.withColumnsRenamed({key: "_key", "day": "_day"})
    added = [c for c in facts.columns if c not in ("_key", "_day")]
    matches = (F.col(key) == F.col("_key")) & (F.to_date("txn_ts") == F.col("_day"))
    joined = df.join(facts, matches, "left").drop("_key", "_day")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in added})


def add_risk_history(df: DataFrame) -> DataFrame:
    """The six history features, one output row per input row."""
    out = join_history(df, card_history(df), "card_id_clean")
    out = join_history(out, merchant_history(df), "merchant_id_clean")
    return out.select(*df.columns, *RISK_HISTORY)


def recent_slice(df: DataFrame, days: int = 30) -> DataFrame:
    """Rows of the last ``days`` days before the newest transaction.

    The edge is found once, when the frame is made, and enters the plan as a plain value, so that every
    reading of the slice can push it down to a stored table.
    """
    edge = df.agg((F.max("txn_ts") - F.make_dt_interval(F.lit(days))).alias("edge")).first()["edge"]
    if edge is None:
        return df.where(F.lit(False))
    return df.where(F.col("txn_ts") >= F.lit(edge).cast(df.schema["txn_ts"].dataType))


def add_risk_history_to_recent(df: DataFrame, days: int = 30) -> DataFrame:
    """History computed on the recent slice only, so its first days see no earlier rows."""
    return add_risk_history(recent_slice(df, days))
