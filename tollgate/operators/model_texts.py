"""Model explanations as columns: contributions of the regression and their texts.

All of it is column arithmetic with the model's few constants, so whole tables are
explained in the same pass that reads them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions import wording as w
from tollgate.functions.formatting import fill, fixed, signed
from tollgate.operators.model import ScoringModel
from tollgate.schemas import MODEL_FEATURES

SHAP_FLOOR = 0.001
FLAGS = MODEL_FEATURES[3:]
CONTEXTS = {
    "txns_last_24h": (10, w.VELOCITY_CONTEXT),
    "declined_txns_last_24h": (2, w.DECLINE_CONTEXT),
    "merchant_fraud_rate_30d": (0.1, w.MERCHANT_CONTEXT),
}


def feature_value(df: DataFrame, feature: str) -> Column:
    """The value an explanation uses: 0 where missing."""
    if feature not in df.columns:
        return F.lit(0.0)
    return F.coalesce(F.col(feature).cast("double"), F.lit(0.0))


def value_text(feature: str, value: Column, with_context: bool) -> Column:
    if feature in FLAGS:
        shown = F.when(value != 0, "Yes").otherwise("No")
    elif feature == "merchant_fraud_rate_30d":
        shown = fixed(value * 100, 1)
    else:
        shown = fixed(value, 0)
    text = fill(w.VALUE_TEXTS[feature], shown)
    if with_context and feature in CONTEXTS:
        limit, (above, below) = CONTEXTS[feature]
        text = F.concat(text, F.when(value > limit, above).otherwise(below))
    return text


def direction(contribution: Column) -> Column:
    return F.when(contribution > 0, "increases").otherwise("decreases")


def add_contributions(df: DataFrame, model: ScoringModel) -> DataFrame:
    """Add ``base_value`` and ``shap_<feature>`` in log-odds.

    For a linear model the Shapley value of a feature is its coefficient times the
    distance from the background mean, the mean of all training rows; base and
    contributions add up to the log-odds.
    """
    columns = {"base_value": F.lit(model.intercept)}
    for feature, coefficient, mean, deviation in zip(model.features, model.coefficients, model.means, model.deviations):
        z = (feature_value(df, feature) - F.lit(mean)) / F.lit(deviation if deviation else 1.0)
        columns[f"shap_{feature}"] = z * F.lit(coefficient)
    return df.withColumns(columns)


def in_order(entries: list[tuple[Column, Column]]) -> Column:
    """An array of (size, text) structs, largest size first; ties keep their order."""
    structs = [
        F.struct((-size).alias("size"), F.lit(i).alias("place"), text.alias("text"))
        for i, (size, text) in enumerate(entries)
    ]
    return F.array_sort(F.array(*structs))


def texts_above(entries: Column, floor: float, none_text: str) -> Column:
    kept = F.transform(F.filter(entries, lambda e: e["size"] < -floor), lambda e: e["text"])
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(F.lit(none_text)))


def explain_by_contributions(df: DataFrame, model: ScoringModel) -> DataFrame:
    """Add ``explanations``: one text per contributing feature, strongest first."""
    explained = add_contributions(df, model)
    entries = []
    for feature in model.features:
        shap, value = F.col(f"shap_{feature}"), feature_value(df, feature)
        text = F.concat(
            F.lit(f"**{w.FEATURE_TITLES[feature]}** (SHAP: "), signed(shap, 3), F.lit("): "), direction(shap),
            F.lit(" fraud probability by "), fixed(F.abs(shap) * 100, 1), F.lit("% - "),
            value_text(feature, value, with_context=True),
        )
        entries.append((F.abs(shap), text))
    texts = texts_above(in_order(entries), SHAP_FLOOR, w.SHAP_NONE)
    return explained.withColumn("explanations", texts).select(*df.columns, "explanations")


def explain_by_coefficients(df: DataFrame, model: ScoringModel) -> DataFrame:
    """Add ``explanations`` from the coefficients: the order is the same for every row."""
    ranked = sorted(zip(model.features, model.coefficients), key=lambda pair: -abs(pair[1]))
    texts = []
    for shown, (feature, coefficient) in enumerate(ranked):
        if abs(coefficient) <= 0.0001 and shown >= 3:
            continue
        level = "high" if abs(coefficient) > 0.5 else "medium" if abs(coefficient) > 0.2 else "low"
        effect = "increases" if coefficient > 0 else "decreases"
        value = value_text(feature, feature_value(df, feature), with_context=feature == "txns_last_24h")
        texts.append(F.concat(
            F.lit(f"**{w.FEATURE_TITLES[feature]}** ({level} impact): {effect} fraud risk - "),
            value, F.lit(f" [Coefficient: {coefficient:.3f}]"),
        ))
    return df.withColumn("explanations", F.array(*texts))


def contribution_bars(df: DataFrame, model: ScoringModel) -> DataFrame:
    """One row per transaction and feature: contribution and sign, strongest first."""
    explained = add_contributions(df, model)
    bars = F.array_sort(F.array(*[
        F.struct((-F.abs(f"shap_{f}")).alias("size"), F.lit(i).alias("place"), F.lit(f).alias("feature"),
                 F.col(f"shap_{f}").alias("shap_value"))
        for i, f in enumerate(model.features)
    ]))
    unfolded = explained.select("txn_id_clean", F.posexplode(bars).alias("bar", "entry"))
    value = F.col("entry.shap_value")
    return unfolded.select(
        "txn_id_clean", (F.col("bar") + 1).alias("bar"), F.col("entry.feature").alias("feature"),
        value.alias("shap_value"), F.when(value > 0, "red").otherwise("green").alias("bar_color"),
    )
