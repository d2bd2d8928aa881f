"""Left joins of staged transactions with merchant, device and card dimensions.

Join strategy is left to Catalyst: a dimension under the broadcast threshold is
broadcast by its measured size, a larger one is joined by shuffle, where adaptive
execution splits keys that hold many transactions (missing keys among them).
Transaction keys are cleaned, dimension keys are not; a repeated dimension key
repeats the transaction, which the row-parity check reports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions.cleaning import blank_to_null, parse_emulator, true_or_false
from tollgate.schemas import ENRICHED_ADDED


def _left_join(df: DataFrame, dimension: DataFrame, key: str, dimension_key: str,
               added: dict[str, Column]) -> DataFrame:
    side = dimension.select(
        F.col(dimension_key).alias("_dimension_key"),
        *[value.alias(name) for name, value in added.items()],
    )
    return df.join(side, df[key] == side["_dimension_key"], "left").drop("_dimension_key")


def add_merchant(df: DataFrame, merchants: DataFrame) -> DataFrame:
    return _left_join(df, merchants, "merchant_id_clean", "merchant_id", {
        "merchant_category": blank_to_null(F.col("mcc")),
        "merchant_country": blank_to_null(F.col("country")),
        "merchant_risk_tier": blank_to_null(F.col("risk_tier")),
    })


def add_device(df: DataFrame, devices: DataFrame) -> DataFrame:
    return _left_join(df, devices, "device_id_clean", "device_id", {
        "device_type": blank_to_null(F.col("os")),
        "os": blank_to_null(F.col("os")),
        "is_emulator": parse_emulator(blank_to_null(F.col("is_emulator"))),
    })


def add_card(df: DataFrame, cards: DataFrame, issuing_country: str | None = None) -> DataFrame:
    """``issuing_country`` names a card column that holds it; today's cards have none."""
    issued = blank_to_null(F.col(issuing_country)) if issuing_country else F.lit(None).cast("string")
    return _left_join(df, cards, "card_id_clean", "card_id", {
        "card_network": blank_to_null(F.col("issuer")),
        "card_type": blank_to_null(F.col("card_type")),
        "issuing_country": issued,
    })


def add_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "is_high_risk_merchant": true_or_false(F.upper("merchant_risk_tier") == "HIGH"),
        "is_foreign_transaction": true_or_false(F.col("country_std") != F.col("issuing_country")),
        "is_emulator_device": true_or_false(F.col("is_emulator") == 1),
    })


def enrich_transactions(staged: DataFrame, merchants: DataFrame, devices: DataFrame,
                        cards: DataFrame, issuing_country: str | None = None) -> DataFrame:
    df = staged.transform(add_merchant, merchants).transform(add_device, devices)
    df = df.transform(add_card, cards, issuing_country).transform(add_flags)
    return df.select(*staged.columns, *ENRICHED_ADDED)
