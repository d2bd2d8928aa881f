"""Catalog: database and raw-table set-up, stage tables, table checks."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.schemas import RAW_COLUMNS, raw_schema
from tollgate.sources.shared import path_exists, remove_folder


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create the database and its empty raw tables where they do not exist yet.

    ``location`` is a folder all executors reach; without it the session's warehouse holds the tables.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    for table in RAW_COLUMNS:
        if not spark.catalog.tableExists(f"{database}.{table}"):
            empty = spark.createDataFrame([], raw_schema(table))
            empty.write.format("parquet").saveAsTable(f"{database}.{table}")


def store_counted(df: DataFrame, save: Callable[[DataFrame], None]) -> int:
    """Write a frame and count its rows in the same pass."""
    seen = Observation()
    save(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def _drop_staged(spark: SparkSession, name: str) -> None:
    """Drop a staged table and what a failed write has left where it would be."""
    database, table = name.rsplit(".", 1) if "." in name else (spark.catalog.currentDatabase(), name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    place = spark.catalog.getDatabase(database).locationUri
    if path_exists(spark, f"{place}/{table.lower()}"):
        remove_folder(spark, f"{place}/{table.lower()}")


def write_beside(df: DataFrame, name: str) -> tuple[str, int]:
    """Store a frame as a staged table beside ``name`` and compare the stored rows with those written.

    Gives the staged name and its rows. If writing or comparing fails, nothing is left.
    """
    spark = df.sparkSession
    staged = f"{name}__new_{uuid4().hex[:12]}"
    try:
        written = store_counted(df, lambda rows: rows.write.format("parquet").saveAsTable(staged))
        stored = spark.table(staged).count()
        if stored != written:
            raise ValueError(f"{name}: {written} rows written, {stored} stored")
    except BaseException:
        _drop_staged(spark, staged)
        raise
    return staged, written


def swap_in(spark: SparkSession, staged: str, name: str) -> None:
    """Put a complete staged table in the place of ``name``; the old one goes last, and comes back if the swap fails."""
    old = f"{name}__old_{uuid4().hex[:12]}" if spark.catalog.tableExists(name) else None
    if old:
        spark.sql(f"ALTER TABLE {name} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    except BaseException:
        if old:
            spark.sql(f"ALTER TABLE {old} RENAME TO {name}")
        raise
    if old:
        spark.sql(f"DROP TABLE {old}")


def recover_swaps(spark: SparkSession, database: str) -> list[str]:
    """After a driver that died while swapping: bring back old tables whose name is vacant, drop what is left over.

    Gives the names brought back. No other job may be swapping tables of the database meanwhile.
    """
    names = {t.name for t in spark.catalog.listTables(database)}
    back = []
    for name in sorted(names):
        base, _, rest = name.partition("__old_")
        if rest and base not in names:
            spark.sql(f"ALTER TABLE {database}.{name} RENAME TO {database}.{base}")
            names.add(base)
            back.append(base)
        elif rest or "__new_" in name:
            _drop_staged(spark, f"{database}.{name}")
    return back


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """Drop-and-create a table from a frame: written beside, counted, then swapped in.

    A frame that fails leaves the old table as it is; the frame may read that same table.
    """
    staged, _ = write_beside(df, name)
    swap_in(df.sparkSession, staged, name)
    return df.sparkSession.table(name)


def read_source(spark: SparkSession, *, table: str | None = None, path: str | None = None,
                jdbc: dict[str, str] | None = None) -> DataFrame:
    """A stored table, a Parquet folder, or a JDBC source.

    For a large JDBC table pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions``, or a single task reads it all.
    """
    if table:
        return spark.table(table)
    if path:
        return spark.read.parquet(path)
    if jdbc:
        return spark.read.format("jdbc").options(**jdbc).load()
    raise ValueError("name a table, a path or JDBC options")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    names = [(t.name,) for t in spark.catalog.listTables(database)]
    return spark.createDataFrame(names, T.StructType([T.StructField("table_name", T.StringType())]))


def check_table(spark: SparkSession, table: str, required: list[str]) -> DataFrame:
    """One row per required column: does the table have it? No table, no columns."""
    present = set()
    if spark.catalog.tableExists(table):
        present = {column.name for column in spark.catalog.listColumns(table)}
    rows = [(table, bool(present), column, column in present) for column in required]
    return spark.createDataFrame(
        rows, "table_name string, table_exists boolean, column_name string, column_exists boolean"
    )


def run_stage(spark: SparkSession, name: str, build: Callable[[], DataFrame],
              verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Build a stage, store it as a table, and return the verification of the stored rows."""
    stored = replace_table(build(), name)
    return verify(stored)
