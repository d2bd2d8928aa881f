"""Sources, sinks and catalog operators as queries; each loads rows of the test tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from tollgate.operators import profiling, quality
from tollgate.plans import fixtures, stages
from tollgate.plans.registry import ID, _as_csv, plain, query, risk
from tollgate.schemas import EXTRACT_COLUMNS, RAW_COLUMNS
from tollgate.sources import extract_csv, raw_csv, tables
from tollgate.sources.shared import shared_folder


def _database(spark) -> str:
    name = f"load_{uuid4().hex}"
    tables.create_database(spark, name, f"{shared_folder(spark)}/{name}")
    return name


def _row_counts(spark, database):
    parts = [spark.table(f"{database}.{t}").agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
             for t in RAW_COLUMNS]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query
def a02_multi_file_scan(spark, sf):
    """Many files of a folder are one table."""
    path = _as_csv(spark, "raw_transactions", fixtures.raw_transactions(spark, sf).repartition(5))
    return raw_csv.read_raw(spark, path, "raw_transactions")


@query
def a03_missing_input(spark, sf):
    """A missing file is an empty table of the same layout."""
    path = _as_csv(spark, "raw_cards", fixtures.cards(spark, sf))
    both = [raw_csv.read_raw(spark, p, "raw_cards").agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("input"), "row_count")
            for n, p in (("present", path), ("missing", f"{path}-missing"))]
    return both[0].unionByName(both[1])


@query
def a04_truncate_and_reload(spark, sf):
    """Loading twice leaves the rows of one load."""
    database = _database(spark)
    paths = {name: _as_csv(spark, name, df) for name, df in fixtures.raw_tables(spark, sf).items()}
    raw_csv.reload_raw(spark, paths, database)
    return plain(raw_csv.reload_raw(spark, paths, database))


@query
def a05_append(spark, sf):
    """A file appended twice doubles the rows; the count read is returned each time."""
    database = _database(spark)
    path = _as_csv(spark, "raw_merchants", fixtures.merchants(spark, sf))
    read = [raw_csv.append_raw(spark, path, "raw_merchants", database) for _ in range(2)]
    return spark.table(f"{database}.raw_merchants").agg(F.count(F.lit(1)).alias("stored_rows")).withColumns(
        {"first_read": F.lit(read[0]).cast("bigint"), "second_read": F.lit(read[1]).cast("bigint")})


@query
def a04_failed_reload(spark, sf):
    """A reload that fails at one file leaves every table as it was."""
    database = _database(spark)
    paths = {name: _as_csv(spark, name, df) for name, df in fixtures.raw_tables(spark, sf).items()}
    raw_csv.reload_raw(spark, paths, database)
    try:
        # The merchants' file has other columns than the table of cards.
        raw_csv.reload_raw(spark, paths | {"raw_devices": f"{paths['raw_devices']}-none", "raw_cards": paths["raw_merchants"]}, database)
        failed = False
    except Exception:
        failed = True
    return _row_counts(spark, database).withColumn("reload_failed", F.lit(failed))


@query
def a05_append_once(spark, sf):
    """A file that is on record is not added again; another one is."""
    database = _database(spark)
    path = _as_csv(spark, "raw_merchants", fixtures.merchants(spark, sf))
    other = f"{path}-more"
    raw_csv.write_raw(fixtures.merchants(spark, sf), other)
    added = [raw_csv.append_raw_once(spark, p, "raw_merchants", database) for p in (path, path, other)]
    return spark.table(f"{database}.raw_merchants").agg(F.count(F.lit(1)).alias("stored_rows")).withColumns(
        {f"load_{i}": F.lit(n).cast("bigint") for i, n in enumerate(added)})


@query
def a07_table_scan(spark, sf):
    database = _database(spark)
    tables.replace_table(fixtures.cards(spark, sf), f"{database}.raw_cards")
    return tables.read_source(spark, table=f"{database}.raw_cards")


@query
def a08_recreate_table(spark, sf):
    """The second version of a table replaces the first, layout included."""
    database = _database(spark)
    tables.replace_table(fixtures.devices(spark, sf), f"{database}.stage")
    return tables.replace_table(fixtures.devices(spark, sf).select("device_id", "os"), f"{database}.stage")


@query
def a09_database_and_raw_tables(spark, sf):
    """Creating twice keeps what is there."""
    database = _database(spark)
    raw_csv.append_raw(spark, _as_csv(spark, "raw_cards", fixtures.cards(spark, sf)), "raw_cards", database)
    tables.create_database(spark, database)
    return _row_counts(spark, database)


@query
def a11_bad_values(spark, sf):
    """Dates and flags that do not parse come back as missing."""
    path = f"{shared_folder(spark)}/extract-{uuid4().hex}"
    rows = risk(spark, sf).select(EXTRACT_COLUMNS)
    bad = F.col(ID).endswith("7")
    text = rows.withColumns({
        "txn_ts": F.when(bad, "soon").otherwise(F.date_format("txn_ts", extract_csv.TIME_FORMAT)),
        "txn_date": F.when(bad, "2024-99-01").otherwise(F.col("txn_date").cast("string")),
        "is_high_risk_merchant": F.when(bad, "maybe").otherwise(F.col("is_high_risk_merchant").cast("string")),
    })
    text.write.option("header", True).csv(path)
    return plain(extract_csv.read_extract(spark, path).select(ID, "txn_ts", "txn_date", "is_high_risk_merchant", "is_fraud"))


@query
def a12_run_and_verify_stage(spark, sf):
    raw = fixtures.raw_transactions(spark, sf)
    return tables.run_stage(
        spark, f"{_database(spark)}.stg_transactions", lambda: stages.staged(spark, sf), lambda out: quality.row_parity(raw, out))


@query
def a13_catalog_checks(spark, sf):
    """Tables of a database, and required columns of the one that was loaded."""
    database = _database(spark)
    tables.replace_table(fixtures.cards(spark, sf), f"{database}.raw_cards")
    checks = tables.check_table(spark, f"{database}.raw_cards", ["card_id", "bin", "no_such_column"]).unionByName(
        tables.check_table(spark, f"{database}.no_such_table", ["card_id"]))
    listed = tables.list_tables(spark, database).agg(F.count(F.lit(1)).alias("tables_listed"))
    rows = spark.table(f"{database}.raw_cards").agg(F.count(F.lit(1)).alias("row_count"))
    short = F.element_at(F.split("table_name", r"\."), -1)
    return checks.withColumn("table_name", short).crossJoin(F.broadcast(listed)).crossJoin(F.broadcast(rows))


@query
def m03_type_families(spark, sf):
    """Columns and stored values per type family."""
    return plain(profiling.family_values(risk(spark, sf)))


@query
def n02_required_columns(spark, sf):
    return quality.required_values(risk(spark, sf), ["txns_last_24h", "merchant_fraud_rate_30d", "no_such_column"])
