"""What a feature table holds: size, labels, types, missing values, signal samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.functions.numbers import percent
from tollgate.operators import ranking
from tollgate.operators.evaluation import class_name
from tollgate.operators.sampling import proportional_sample

# Columns an analysis expects.
KEY_COLUMNS = [
    "txn_id_clean", "txn_ts", "amount", "is_fraud",
    "txns_last_24h", "amt_last_24h", "distinct_merchants_last_24h",
    "card_txn_count_30d", "card_fraud_rate_30d", "merchant_txn_count_30d", "merchant_fraud_rate_30d",
]
RATIO_CEILING = 10


def table_profile(df: DataFrame, key_columns: list[str] | None = None) -> DataFrame:
    """Row and column counts, and 1 or 0 for each key column's presence."""
    facts = {"columns": len(df.columns)}
    facts |= {f"has {c}": int(c in df.columns) for c in (key_columns or KEY_COLUMNS)}
    pairs = [F.struct(F.lit("rows").alias("metric"), F.col("rows").alias("metric_value"))]
    pairs += [
        F.struct(F.lit(name).alias("metric"), F.lit(value).cast("bigint").alias("metric_value"))
        for name, value in facts.items()
    ]
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.inline(F.array(*pairs)))


def label_distribution(df: DataFrame) -> DataFrame:
    name = F.when(F.col("is_fraud"), "Fraud").when(~F.col("is_fraud"), "Non-Fraud").otherwise("Unknown")
    counts = df.groupBy(name.alias("label")).agg(F.count(F.lit(1)).alias("row_count"))
    total = counts.select(F.sum("row_count")).scalar()
    return counts.select("label", "row_count", percent(F.col("row_count"), total).alias("row_pct")).orderBy("label")


FAMILIES = {
    "numeric": (T.NumericType,), "string": (T.StringType,), "boolean": (T.BooleanType,),
    "datetime": (T.DateType, T.TimestampType, T.TimestampNTZType),
}


def type_families(df: DataFrame) -> DataFrame:
    """Columns per type family."""
    rows = [
        (name, sum(isinstance(field.dataType, kinds) for field in df.schema.fields))
        for name, kinds in FAMILIES.items()
    ]
    return df.sparkSession.createDataFrame(rows, "type_family string, column_count int")


def family_values(df: DataFrame) -> DataFrame:
    """Columns per type family, and how many values they hold in all rows."""
    names = {field.name: family for field in df.schema.fields for family, kinds in FAMILIES.items() if isinstance(field.dataType, kinds)}
    family = F.create_map(*[F.lit(text) for pair in names.items() for text in pair])
    present = missing_counts(df, list(names)).groupBy(family[F.col("column_name")].alias("type_family")).agg(
        F.count(F.lit(1)).cast("int").alias("column_count"), F.sum(F.col("row_count") - F.col("null_count")).alias("value_count"))
    return type_families(df).select("type_family").join(present, "type_family", "left").fillna(0)


def missing_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL rows and their share per column: every column in one pass."""
    columns = columns or df.columns
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"), F.col("_rows").alias("row_count"))
        for c in columns
    ])
    return counted.select(F.inline(pairs))


def most_missing(df: DataFrame, top_n: int = 10) -> DataFrame:
    counts = missing_counts(df).where(F.col("null_count") > 0)
    return counts.select(
        "column_name", "null_count", percent(F.col("null_count"), F.col("row_count")).alias("null_pct")
    ).orderBy(F.desc("null_count"), "column_name").limit(top_n)


SIGNALS = {
    "txns_last_24h": "txns_last_24h IS NOT NULL",
    "amount_vs_card_avg": f"amount_vs_card_avg < {RATIO_CEILING}",
    "merchant_fraud_rate_30d": "merchant_fraud_rate_30d IS NOT NULL",
}


def signal_rows(df: DataFrame, signal: str) -> DataFrame:
    return df.where(SIGNALS[signal]).where(F.col("is_fraud").isNotNull())


def signal_sample(df: DataFrame, signal: str, rows: int, seed: int = 42) -> DataFrame:
    """A class-proportional sample of the rows that carry a signal, with its class name."""
    sample = proportional_sample(signal_rows(df, signal), rows, seed=seed)
    return sample.withColumn("transaction_type", class_name(F.col("is_fraud")))


def signal_boxes(df: DataFrame, signal: str) -> DataFrame:
    """Box summary of a signal by class, over all its rows."""
    named = signal_rows(df, signal).withColumn("transaction_type", class_name(F.col("is_fraud")))
    return ranking.box_summary(named, signal, "transaction_type")


def signal_histogram(df: DataFrame, signal: str, bins: int = 50) -> DataFrame:
    """Rows per bin and class over common bin edges."""
    named = signal_rows(df, signal).withColumn("transaction_type", class_name(F.col("is_fraud")))
    return ranking.histogram(named, signal, "transaction_type", bins, shared_edges=True)
