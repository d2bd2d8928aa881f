"""Rows as an investigator sees them: order, format, pages, look-ups, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions import wording as w
from tollgate.functions.formatting import band_mark, currency, fixed, share_text
from tollgate.operators.ranking import global_positions

PAGE_ROWS = 1000


def overview_order(df: DataFrame) -> list[Column]:
    """Highest score first, else newest day first; missing last; ties by hashed id."""
    ties = [F.md5(F.coalesce("txn_id_clean", F.lit(""))), F.col("txn_id_clean").asc_nulls_first()]
    if "risk_score" in df.columns:
        return [F.col("risk_score").desc_nulls_last(), *ties]
    if "txn_date" in df.columns:
        return [F.col("txn_date").desc_nulls_last(), *ties]
    return ties


def sort_overview(df: DataFrame) -> DataFrame:
    return df.orderBy(*overview_order(df))


def fraud_mark(label: Column) -> Column:
    return F.when(label, w.LABEL_MARKS[True]).when(~label, w.LABEL_MARKS[False])


def display_table(df: DataFrame, titles: dict[str, str] | None = None) -> DataFrame:
    """The display columns the frame has, formatted and under their titles."""
    titles = w.DISPLAY_TITLES if titles is None else titles
    formats = {
        "amount": currency(F.col("amount")),
        "is_fraud": fraud_mark(F.col("is_fraud")),
        "risk_score": share_text(F.col("risk_score")),
        "risk_band": F.concat(band_mark(F.col("risk_band")), F.lit(" "), F.col("risk_band")),
    }
    return df.select([
        formats.get(name, F.col(name)).alias(title) for name, title in titles.items() if name in df.columns
    ])


def page(df: DataFrame, number: int, rows: int = PAGE_ROWS) -> DataFrame:
    """Page ``number`` (from 1) in overview order.

    The page is located by counts, so a late page does not gather the pages before it.
    """
    if "risk_score" in df.columns:
        place = F.coalesce("risk_score", F.lit(-1.0))
    elif "txn_date" in df.columns:
        place = F.coalesce(F.datediff("txn_date", F.lit("1970-01-01").cast("date")), F.lit(-1_000_000)).cast("double")
    else:
        place = F.lit(0.0)
    span = ((number - 1) * rows, number * rows)
    found = global_positions(df.withColumn("_place", place), "_place", "txn_id_clean", span=span)
    return found.orderBy("position").select(df.columns)


def page_count(df: DataFrame, rows: int = PAGE_ROWS) -> DataFrame:
    total = F.count(F.lit(1))
    return df.agg(total.alias("total_rows"), F.ceil(total / rows).cast("bigint").alias("pages"))


def find_transaction(df: DataFrame, txn_id: str) -> DataFrame:
    """The first row of a transaction id in overview order."""
    return sort_overview(df.where(F.col("txn_id_clean") == txn_id)).limit(1)


def transaction_ids(df: DataFrame) -> DataFrame:
    return df.select("txn_id_clean").distinct()


def option_label(df: DataFrame) -> DataFrame:
    """Add ``option_label``: id, band, score, amount, fraud text."""
    score = F.coalesce("risk_score", F.lit(0.5))
    band = F.coalesce("risk_band", F.lit("MEDIUM"))
    score_text = F.when(score <= 1.0, F.concat(fixed(score * 100, 1), F.lit("%"))).otherwise(fixed(score, 1))
    fraud = F.when(F.col("is_fraud"), w.OPTION_FRAUD).otherwise(w.OPTION_LEGITIMATE)
    risk = F.concat(band_mark(band), F.lit(" "), band, F.lit(" ("), score_text, F.lit(")"))
    return df.withColumn("option_label", F.concat_ws(" | ", "txn_id_clean", risk, currency(F.col("amount")), fraud))


def risk_parameters(df: DataFrame) -> DataFrame:
    """The values behind a score as (transaction, parameter, value) rows."""
    missing = F.lit(w.NOT_AVAILABLE)
    yes_no = F.when(F.col("is_emulator_device"), "Yes").otherwise("No")
    high_risk = F.when(F.col("is_high_risk_merchant"), "Yes").otherwise("No")
    rate = F.concat(fixed(F.col("merchant_fraud_rate_30d") * 100, 1), F.lit("%"))
    values = {
        "Transactions (24h)": F.col("txns_last_24h").cast("string"),
        "Declined (24h)": F.col("declined_txns_last_24h").cast("string"),
        "Amount vs Card Avg": F.concat(fixed(F.col("amount_vs_card_avg"), 2), F.lit("x")),
        "Amount": currency(F.col("amount")),
        "Merchant Risk": F.col("merchant_risk_tier"),
        "Merchant Fraud Rate (30d)": rate,
        "High-Risk Merchant": high_risk,
        "Emulator Device": yes_no,
    }
    pairs = F.array(*[
        F.struct(F.lit(name).alias("parameter"), F.coalesce(value, missing).alias("value"))
        for name, value in values.items()
    ])
    return df.select("txn_id_clean", F.inline(pairs))
