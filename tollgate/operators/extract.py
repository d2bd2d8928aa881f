"""The class-balanced BI extract and its summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.functions.numbers import percent
from tollgate.operators.sampling import budgeted_sample, class_counts, hash_order, sample_budget
from tollgate.schemas import EXTRACT_COLUMNS

SEED = 42


def extract_projection(df: DataFrame) -> DataFrame:
    return df.select(EXTRACT_COLUMNS)


def extract_plan(df: DataFrame, target_rows: int) -> DataFrame:
    """Available rows per class and how many the extract will take."""
    taken = sample_budget(target_rows)
    return class_counts(df).select(
        "fraud_count", "non_fraud_count", "total_count",
        taken.alias("non_fraud_taken"), (F.col("fraud_count") + taken).alias("expected_rows"),
    )


def build_extract(df: DataFrame, target_rows: int, seed: int = SEED) -> DataFrame:
    """Every fraud row and a sample of the others, 17 columns."""
    return budgeted_sample(extract_projection(df), target_rows, seed=seed)


def shuffle_rows(df: DataFrame, seed: int = SEED) -> DataFrame:
    """Rows in a repeatable random order."""
    return df.orderBy(hash_order("txn_id_clean", seed + 1), "txn_id_clean")


def extract_summary(extract: DataFrame) -> DataFrame:
    counts = class_counts(extract)
    rows = F.col("total_count")
    return counts.select(
        rows.alias("total_rows"), "fraud_count", percent(F.col("fraud_count"), rows).alias("fraud_pct"),
        "non_fraud_count", percent(F.col("non_fraud_count"), rows).alias("non_fraud_pct"),
        F.lit(len(extract.columns)).alias("columns_exported"),
    )


def preview(extract: DataFrame, rows: int = 2) -> DataFrame:
    """The first rows of the shuffled extract."""
    return shuffle_rows(extract).limit(rows)
