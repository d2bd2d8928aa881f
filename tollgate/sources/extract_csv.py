"""The BI extract as CSV: distributed write, typed read-back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.schemas import EXTRACT_COLUMNS, EXTRACT_SCHEMA
from tollgate.sources.raw_csv import MISSING_TOKENS
from tollgate.sources.shared import path_exists

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def write_extract(extract: DataFrame, path: str) -> None:
    """One part file per task, each with a header."""
    (extract.write.mode("overwrite").option("header", True)
     .option("timestampNTZFormat", TIME_FORMAT).csv(path))


def extract_size(spark: SparkSession, path: str) -> DataFrame:
    """Number and bytes of the written files, from their listing alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    return files.select("length").agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )


def read_extract(spark: SparkSession, path: str) -> DataFrame:
    """Typed rows; text that does not fit its type is NULL; a missing path is an empty frame."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], EXTRACT_SCHEMA)
    text = T.StructType([T.StructField(name, T.StringType()) for name in EXTRACT_COLUMNS])
    rows = (
        spark.read.schema(text).option("header", True).option("enforceSchema", False)
        .option("quote", '"').option("escape", '"').csv(path)
    )

    def typed(field: T.StructField):
        value = F.when(~F.col(field.name).isin(MISSING_TOKENS), F.col(field.name))
        return value.try_cast(field.dataType).alias(field.name)

    return rows.select([typed(field) for field in EXTRACT_SCHEMA.fields])
