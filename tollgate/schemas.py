"""Table layouts: raw inputs, columns each stage adds, the BI extract."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw table layouts, every column text.
RAW_COLUMNS = {
    "raw_transactions": [
        "txn_id", "txn_ts", "amount", "card_id", "merchant_id",
        "device_id", "channel", "country", "auth_result", "is_fraud",
    ],
    "raw_merchants": ["merchant_id", "merchant_name", "mcc", "country", "risk_tier"],
    "raw_devices": ["device_id", "os", "browser", "is_emulator"],
    "raw_cards": ["card_id", "bin", "issuer", "card_type"],
    "raw_rule_hits": ["txn_id", "rule_name", "rule_score"],
    "raw_investigator_notes": ["txn_id", "note_text", "created_at"],
}

# Columns added by each stage.
STAGED_TYPED = [
    "txn_ts", "amount", "is_fraud", "auth_result_std", "channel_std", "country_std",
    "txn_date", "txn_hour", "is_declined", "is_zero_amount", "is_negative_amt", "is_high_amount",
]
ENRICHED_ADDED = [
    "merchant_category", "merchant_country", "merchant_risk_tier",
    "device_type", "os", "is_emulator",
    "card_network", "card_type", "issuing_country",
    "is_high_risk_merchant", "is_foreign_transaction", "is_emulator_device",
]
CARD_ACTIVITY = [
    "txns_last_1h", "txns_last_24h", "amt_last_24h", "declined_txns_last_24h",
    "amount_vs_card_avg", "distinct_merchants_last_24h",
]
RISK_HISTORY = [
    "card_txn_count_30d", "card_fraud_rate_30d", "card_decline_rate_30d",
    "merchant_txn_count_30d", "merchant_fraud_rate_30d", "merchant_decline_rate_30d",
]

# The 17 columns of the BI extract.
EXTRACT_COLUMNS = [
    "txn_id_clean", "txn_ts", "txn_date",
    "amount", "channel_std", "country_std",
    "is_fraud", "is_declined",
    "txns_last_24h", "amount_vs_card_avg", "declined_txns_last_24h",
    "merchant_id_clean", "merchant_risk_tier", "merchant_txn_count_30d", "merchant_fraud_rate_30d",
    "is_high_risk_merchant", "is_emulator_device",
]

# Model inputs.
MODEL_FEATURES = [
    "txns_last_24h", "declined_txns_last_24h", "merchant_fraud_rate_30d",
    "is_high_risk_merchant", "is_emulator_device",
]


def raw_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS[table]])


def staged_columns() -> list[str]:
    raw = RAW_COLUMNS["raw_transactions"]
    clean = [c for c in raw if c != "is_fraud"]
    return [f"{c}_raw" for c in raw] + [f"{c}_clean" for c in clean] + STAGED_TYPED


def enriched_columns() -> list[str]:
    return staged_columns() + ENRICHED_ADDED


def feature_columns() -> list[str]:
    return enriched_columns() + CARD_ACTIVITY


def risk_columns() -> list[str]:
    return feature_columns() + RISK_HISTORY


EXTRACT_SCHEMA = T.StructType([
    T.StructField("txn_id_clean", T.StringType()),
    T.StructField("txn_ts", T.TimestampNTZType()),
    T.StructField("txn_date", T.DateType()),
    T.StructField("amount", T.DecimalType(12, 2)),
    T.StructField("channel_std", T.StringType()),
    T.StructField("country_std", T.StringType()),
    T.StructField("is_fraud", T.BooleanType()),
    T.StructField("is_declined", T.BooleanType()),
    T.StructField("txns_last_24h", T.LongType()),
    T.StructField("amount_vs_card_avg", T.DoubleType()),
    T.StructField("declined_txns_last_24h", T.LongType()),
    T.StructField("merchant_id_clean", T.StringType()),
    T.StructField("merchant_risk_tier", T.StringType()),
    T.StructField("merchant_txn_count_30d", T.LongType()),
    T.StructField("merchant_fraud_rate_30d", T.DoubleType()),
    T.StructField("is_high_risk_merchant", T.BooleanType()),
    T.StructField("is_emulator_device", T.BooleanType()),
])
