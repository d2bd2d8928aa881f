"""Raw text rows -> typed, standardised rows. One narrow projection: no filter, join or dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.functions import cleaning as c
from tollgate.schemas import RAW_COLUMNS, staged_columns


def keep_raw(raw: DataFrame) -> DataFrame:
    """Rename every input column to ``<name>_raw``."""
    return raw.select([F.col(name).alias(f"{name}_raw") for name in RAW_COLUMNS["raw_transactions"]])


def add_clean(df: DataFrame) -> DataFrame:
    """Trimmed copies, empty text as NULL."""
    return df.withColumns({
        f"{name}_clean": c.blank_to_null(F.col(f"{name}_raw"))
        for name in RAW_COLUMNS["raw_transactions"]
    })


def add_typed(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "txn_ts": c.parse_timestamp(F.col("txn_ts_clean")),
        "amount": c.parse_amount(F.col("amount_clean")),
        "is_fraud": c.parse_flag(F.col("is_fraud_clean")),
    })


def add_standard(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "auth_result_std": c.standardise(F.col("auth_result_clean"), c.AUTH_RESULTS),
        "channel_std": c.standardise(F.col("channel_clean"), c.CHANNEL_SYNONYMS),
        "country_std": c.standardise_country(F.col("country_clean")),
    })


def add_derived(df: DataFrame) -> DataFrame:
    amount = F.col("amount")
    return df.withColumns({
        "txn_date": F.to_date("txn_ts"),
        "txn_hour": F.hour("txn_ts"),
        "is_declined": c.true_or_false(F.col("auth_result_std") == "DECLINED"),
        "is_zero_amount": c.true_or_false(amount == 0),
        "is_negative_amt": c.true_or_false(amount < 0),
        "is_high_amount": c.true_or_false(amount > c.HIGH_AMOUNT),
    })


def stage_transactions(raw: DataFrame) -> DataFrame:
    """All of the above, in the 31-column stage layout."""
    df = raw.transform(keep_raw).transform(add_clean).transform(add_typed)
    return df.transform(add_standard).transform(add_derived).select(staged_columns())
