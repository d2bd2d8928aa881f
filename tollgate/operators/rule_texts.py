"""Rule-based explanations as columns: threshold texts and a one-line assessment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions import wording as w
from tollgate.functions.formatting import fill, fixed


def _when(condition: Column, text: Column | str) -> Column:
    return F.when(condition, text if isinstance(text, Column) else F.lit(text))


def _texts() -> dict[str, Column]:
    velocity, declines = F.col("txns_last_24h"), F.col("declined_txns_last_24h")
    ratio, rate = F.col("amount_vs_card_avg"), F.col("merchant_fraud_rate_30d")
    return {
        "velocity": _when(velocity > 10, fill(w.RULE_VELOCITY, velocity.cast("string"))),
        "amount": _when(F.abs(ratio - 1.0) > 0.5, fill(w.RULE_AMOUNT, fixed(ratio, 2))),
        "merchant": _when(F.col("is_high_risk_merchant"), w.RULE_MERCHANT),
        "emulator": _when(F.col("is_emulator_device"), w.RULE_EMULATOR),
        "rate": _when(rate > 0.1, fill(w.RULE_MERCHANT_RATE, fixed(rate * 100, 1))),
        "declines": _when(declines > 2, fill(w.RULE_DECLINES, declines.cast("string"))),
    }


ORDER = ["velocity", "amount", "merchant", "emulator", "rate", "declines"]
ORDER_WITHOUT_AMOUNT = ["velocity", "declines", "merchant", "emulator", "rate"]


def rule_explanation(order: list[str] | None = None) -> Column:
    """An array of the texts whose threshold is passed, or one default text."""
    texts = _texts()
    found = F.array_compact(F.array(*[texts[name] for name in (order or ORDER)]))
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(w.RULE_NONE)))


def explain_by_rules(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    return df.withColumn("explanations", rule_explanation(order))


def _factors(*pairs: tuple[Column, str]) -> Column:
    return F.concat_ws(", ", *[F.when(condition, F.lit(name)) for condition, name in pairs])


def assess_risk(df: DataFrame) -> DataFrame:
    """Add ``assessment``: one line from band, label and the strongest factors."""
    score = F.when(F.col("risk_score") > 1.0, F.col("risk_score") / 100.0).otherwise(F.col("risk_score"))
    fraud = F.coalesce("is_fraud", F.lit(False))
    velocity, merchant = F.col("txns_last_24h"), F.col("is_high_risk_merchant")
    strong = _factors(
        (velocity > 10, w.FACTOR_VELOCITY),
        (F.col("declined_txns_last_24h") > 2, w.FACTOR_DECLINES),
        (merchant, w.FACTOR_MERCHANT),
        (F.col("is_emulator_device"), w.FACTOR_EMULATOR),
        (F.col("merchant_fraud_rate_30d") > 0.1, w.FACTOR_MERCHANT_RATE),
    )
    moderate = _factors((velocity > 5, w.FACTOR_SOME_VELOCITY), (merchant, w.FACTOR_MERCHANT))
    high = F.coalesce((F.col("risk_band") == "HIGH") | (score >= 0.6), F.lit(False))
    medium = F.coalesce((F.col("risk_band") == "MEDIUM") | (score >= 0.3), F.lit(False))
    text = (
        F.when(high & fraud, w.ASSESS_HIGH_CONFIRMED)
        .when(high & (strong != ""), fill(w.ASSESS_HIGH_FACTORS, strong))
        .when(high, w.ASSESS_HIGH)
        .when(medium & (moderate != ""), fill(w.ASSESS_MEDIUM_FACTORS, moderate))
        .when(medium, w.ASSESS_MEDIUM)
        .when(fraud, w.ASSESS_LOW_CONFIRMED)
        .otherwise(w.ASSESS_LOW)
    )
    return df.withColumn("assessment", text)
