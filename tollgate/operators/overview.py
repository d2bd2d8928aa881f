"""Key figures of a (filtered) transaction set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions.numbers import half_even, percent
from tollgate.operators.ranking import exact_quantiles

BANDS = ["LOW", "MEDIUM", "HIGH"]
PLACEHOLDER_SCORE = 0.5
CATEGORIES = ["merchant_risk_tier", "channel_std", "country_std"]


def dataset_overview(df: DataFrame, filters: Column) -> DataFrame:
    """All rows against the rows that pass ``filters``, in one pass.

    Rows are first added up per combination of the three small-domain categories, so
    their distinct counts need no extra copy of the data.
    """
    inside = F.coalesce(filters, F.lit(False))
    amount = F.when(inside, F.col("amount"))
    parts = df.groupBy(*CATEGORIES).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(inside).alias("inside"),
        F.count_if(inside & F.col("is_fraud")).alias("fraud"),
        F.count_if(inside & ~F.col("is_fraud")).alias("non_fraud"),
        F.sum(amount).alias("amount"),
        F.count(amount).alias("amounts"),
        F.min(F.when(inside, F.col("txn_date"))).alias("first_day"),
        F.max(F.when(inside, F.col("txn_date"))).alias("last_day"),
    )
    seen = F.col("inside") > 0

    def distinct(column: str) -> Column:
        return F.count_distinct(F.when(seen, F.col(column)))

    fraud, inside_rows = F.sum("fraud"), F.sum("inside")
    amounts = F.nullif(F.sum("amounts"), F.lit(0))
    return parts.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(inside_rows, F.lit(0)).alias("filtered_rows"),
        F.coalesce(fraud, F.lit(0)).alias("fraud_count"),
        F.coalesce(F.sum("non_fraud"), F.lit(0)).alias("non_fraud_count"),
        percent(fraud, inside_rows).alias("fraud_pct"),
        F.min("first_day").alias("date_min"),
        F.max("last_day").alias("date_max"),
        (F.sum("amount").cast("double") / amounts).alias("amount_avg"),
        F.sum("amount").alias("amount_sum"),
        distinct("merchant_risk_tier").alias("tiers"),
        distinct("channel_std").alias("channels"),
        distinct("country_std").alias("countries"),
    )


def filtered_statistics(df: DataFrame, filters: Column) -> DataFrame:
    """Filtered rows against all rows: counts, rates and their difference, bands, scores, amounts."""
    inside = F.coalesce(filters, F.lit(False))
    rows, all_rows = F.count_if(inside), F.count(F.lit(1))
    fraud = F.count_if(inside & F.col("is_fraud"))
    non_fraud = F.count_if(inside & ~F.col("is_fraud"))
    fraud_all = F.count_if(F.col("is_fraud"))
    some = F.nullif(rows, F.lit(0))
    rate, rate_all = fraud / some * 100, fraud_all / F.nullif(all_rows, F.lit(0)) * 100
    amount = F.when(inside, F.col("amount"))
    bands = {band: F.count_if(inside & (F.col("risk_band") == band)) for band in BANDS}
    figures = df.agg(
        rows.alias("filtered_rows"), all_rows.alias("total_rows"), (rows - all_rows).alias("rows_delta"),
        fraud.alias("fraud_count"), non_fraud.alias("non_fraud_count"),
        half_even(rate, 2).alias("fraud_pct"), percent(non_fraud, rows).alias("non_fraud_pct"),
        half_even(rate_all, 2).alias("fraud_pct_all"), half_even(rate - rate_all, 2).alias("fraud_pct_delta"),
        *[count.alias(f"{band.lower()}_count") for band, count in bands.items()],
        *[percent(count, rows).alias(f"{band.lower()}_pct") for band, count in bands.items()],
        F.avg(F.when(inside, F.col("risk_score"))).alias("risk_score_avg"),
        F.sum(amount).alias("amount_sum"),
        (F.sum(amount).cast("double") / F.nullif(F.count(amount), F.lit(0))).alias("amount_avg"),
        F.max(amount).alias("amount_max"), F.min(amount).alias("amount_min"),
    )
    median = exact_quantiles(df.where(inside), "amount", {"amount_median": 0.5}).scalar()
    return figures.withColumn("amount_median", median)


def value_breakdown(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows per value of each category and their share of all rows; missing values are not listed."""
    columns = CATEGORIES if columns is None else columns
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.select(F.sum("rows")).scalar()
    pairs = F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).alias("category_value")) for c in columns])
    listed = counts.select("rows", F.inline(pairs)).where(F.col("category_value").isNotNull())
    listed = listed.groupBy("category", "category_value").agg(F.sum("rows").alias("row_count"))
    return listed.select(
        "category", "category_value", "row_count", percent(F.col("row_count"), total).alias("row_pct")
    ).orderBy("category", F.desc("row_count"), "category_value")


def band_distribution(df: DataFrame) -> DataFrame:
    """Rows per band, bands without rows included."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("risk_band") == b).alias(b) for b in BANDS]
    )
    pairs = F.array(*[
        F.struct(
            F.lit(band).alias("risk_band"), F.col(band).alias("row_count"),
            F.coalesce(percent(F.col(band), F.col("total"), 1), F.lit(0.0)).alias("row_pct"),
        )
        for band in BANDS
    ])
    return counts.select(F.inline(pairs))


def unscored_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("risk_score") == PLACEHOLDER_SCORE).alias("unscored_rows"))
