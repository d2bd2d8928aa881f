"""Raw CSV inputs: folder scans, reloads, appends, and load reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.schemas import RAW_COLUMNS, raw_schema
from tollgate.sources import tables
from tollgate.sources.shared import path_exists

# Text a CSV reader in the reference environment takes as missing.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
CSV_FILES = "*.[cC][sS][vV]"


def read_raw(spark: SparkSession, path: str, table: str, missing_tokens: bool = True,
             multiline: bool = False) -> DataFrame:
    """Every CSV file of a folder (or one file) as text columns.

    Header names must match the layout. A missing path gives an empty frame of that
    layout. ``multiline`` allows line breaks inside quotes but makes files unsplittable.
    """
    schema = raw_schema(table)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = (
        spark.read.schema(schema).option("header", True).option("enforceSchema", False)
        .option("quote", '"').option("escape", '"').option("multiLine", multiline)
    )
    if not path.lower().endswith(".csv"):
        reader = reader.option("pathGlobFilter", CSV_FILES)
    df = reader.csv(path)
    if not missing_tokens:
        return df
    return df.select([
        F.when(~F.col(c).isin(MISSING_TOKENS), F.col(c)).alias(c) for c in df.columns
    ])


def write_raw(df: DataFrame, path: str) -> None:
    """Text columns as CSV with a header, spaces kept."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


LOADS = "raw_loads"


def reload_raw(spark: SparkSession, paths: dict[str, str], database: str) -> DataFrame:
    """Replace the raw tables by the files at ``paths`` and report stored and read rows.

    A table without a path, or whose path is missing, ends up empty. All tables are read and counted beside the
    old ones first; only when every one is complete are they swapped in, so a failing file changes none.
    """
    staged: dict[str, tuple[str, int]] = {}
    try:
        for table in RAW_COLUMNS:
            rows = (
                read_raw(spark, paths[table], table) if table in paths
                else spark.createDataFrame([], raw_schema(table))
            )
            staged[table] = tables.write_beside(rows, f"{database}.{table}")
    except BaseException:
        for name, _ in staged.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        raise
    for table, (name, _) in staged.items():
        tables.swap_in(spark, name, f"{database}.{table}")
    if spark.catalog.tableExists(f"{database}.{LOADS}"):
        spark.sql(f"DROP TABLE {database}.{LOADS}")
    return load_report(
        {table: spark.table(f"{database}.{table}") for table in RAW_COLUMNS}, {table: n for table, (_, n) in staged.items()})


def append_raw(spark: SparkSession, path: str, table: str, database: str) -> int:
    """Add one file to a raw table; returns the rows read.

    The file is read whole into a staged table first, so a file that fails adds nothing.
    """
    name = f"{database}.{table}"
    staged, rows = tables.write_beside(read_raw(spark, path, table), name)
    try:
        spark.table(staged).write.mode("append").format("parquet").saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE {staged}")
    return rows


def append_raw_once(spark: SparkSession, path: str, table: str, database: str) -> int:
    """Add one file to a raw table unless a load of that file is on record; returns the rows added.

    Loads are on record in ``raw_loads`` (table, file, rows in the table before and after). The intention is recorded first: if a job
    dies in between, the next call sees from the table's row count whether its rows went in.
    """
    log, name, file = f"{database}.{LOADS}", f"{database}.{table}", path.rstrip("/").rsplit("/", 1)[-1]
    layout = "table_name string, file_name string, rows_before bigint, rows_after bigint"
    if not spark.catalog.tableExists(log):
        spark.createDataFrame([], layout).write.format("parquet").saveAsTable(log)
    stored = spark.table(name).count()
    known = spark.table(log).where((F.col("table_name") == table) & (F.col("file_name") == file)).agg(
        F.max("rows_after").alias("after")).first()
    if known["after"] is not None and stored >= known["after"]:
        return 0
    staged, rows = tables.write_beside(read_raw(spark, path, table), name)
    try:
        spark.createDataFrame([(table, file, stored, stored + rows)], layout).write.mode("append").format("parquet").saveAsTable(log)
        spark.table(staged).write.mode("append").format("parquet").saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE {staged}")
    return rows


def load_report(stored: dict[str, DataFrame], loaded: dict[str, int]) -> DataFrame:
    """Rows stored and rows loaded, per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("stored_rows")).select(
            F.lit(table).alias("table_name"), "stored_rows",
            F.lit(loaded.get(table, 0)).cast("bigint").alias("loaded_rows"),
        )
        for table, df in stored.items()
    ]
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("matches", F.col("stored_rows") == F.col("loaded_rows")).orderBy("table_name")
