"""Checks on stored stage tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.functions.numbers import percent
from tollgate.operators.profiling import missing_counts
from tollgate.operators.risk_history import recent_slice

NULL_LIMIT_PCT = 50


def row_parity(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of two stages and whether they match; a repeated dimension key shows up here."""
    counted = before.agg(F.count(F.lit(1)).alias("rows_before"))
    rows_after = after.select(F.count(F.lit(1))).scalar()
    return counted.select(
        "rows_before", rows_after.alias("rows_after"),
        F.abs(F.col("rows_before") - rows_after).alias("difference"),
        (F.col("rows_before") == rows_after).alias("rows_match"),
    )


def required_columns(df: DataFrame, required: list[str]) -> DataFrame:
    rows = [(c, c in df.columns) for c in required]
    return df.sparkSession.createDataFrame(rows, "column_name string, present boolean")


def required_values(df: DataFrame, required: list[str]) -> DataFrame:
    """Required columns, whether the frame has them, and in how many rows they hold a value."""
    counts = df.agg(*[(F.count(c) if c in df.columns else F.lit(0).cast("bigint")).alias(f"n{i}") for i, c in enumerate(required)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(c in df.columns).alias("present"), F.col(f"n{i}").alias("value_count"))
        for i, c in enumerate(required)])))


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL rows per feature; OK under half."""
    rate = F.col("null_count") / F.nullif(F.col("row_count"), F.lit(0)) * 100
    return missing_counts(df, columns).select(
        "column_name", "row_count", "null_count",
        percent(F.col("null_count"), F.col("row_count"), 1).alias("null_pct"),
        F.when(rate < NULL_LIMIT_PCT, "OK").otherwise("WARN").alias("status"),
    )


def _mean(column: str):
    """Exact for whole numbers and DECIMAL: the sum is taken before the division."""
    return (F.sum(column).cast("double") / F.nullif(F.count(column), F.lit(0))).alias(f"avg_{column}")


def card_activity_statistics(df: DataFrame) -> DataFrame:
    return df.where(F.col("txn_ts").isNotNull()).agg(
        F.count(F.lit(1)).alias("row_count"), _mean("txns_last_24h"), F.max("txns_last_24h").alias("max_txns_last_24h"),
        _mean("amt_last_24h"), _mean("amount_vs_card_avg"), _mean("distinct_merchants_last_24h"),
    )


def risk_history_statistics(df: DataFrame) -> DataFrame:
    return df.where(F.col("txn_ts").isNotNull()).agg(
        F.count(F.lit(1)).alias("row_count"),
        _mean("card_txn_count_30d"), F.max("card_txn_count_30d").alias("max_card_txn_count_30d"),
        _mean("card_fraud_rate_30d"), _mean("merchant_txn_count_30d"), _mean("merchant_fraud_rate_30d"),
    )


def recent_slice_parity(features: DataFrame, validation: DataFrame, days: int = 30) -> DataFrame:
    """Rows the recent slice should have against the rows of the validation table."""
    return row_parity(recent_slice(features, days), validation)


def first_rows(df: DataFrame, columns: list[str], rows: int = 10) -> DataFrame:
    """The first rows by id that have a timestamp."""
    return df.where(F.col("txn_ts").isNotNull()).orderBy("txn_id_clean").limit(rows).select(columns)


def newest_rows(df: DataFrame, columns: list[str], rows: int = 10) -> DataFrame:
    timed = df.where(F.col("txn_ts").isNotNull())
    return timed.orderBy(F.desc("txn_ts"), "txn_id_clean").limit(rows).select(columns)
