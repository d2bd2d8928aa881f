import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tollgate.operators import quality
from tollgate.schemas import EXTRACT_SCHEMA, RAW_COLUMNS
from tollgate.sources import extract_csv, raw_csv, tables
from tollgate.sources.shared import shared_folder, write_and_read

HEADER = ",".join(RAW_COLUMNS["raw_transactions"])


@pytest.fixture()
def database(spark):
    name = "raw_check"
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    tables.create_database(spark, name)
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture()
def transactions(tmp_path):
    folder = tmp_path / "transactions"
    folder.mkdir()
    (folder / "jan.csv").write_text(HEADER + '\nt1,2024-01-01 00:00:00, 5.0 ,c1,m1,d1,web,NA,APPROVED,1\n')
    (folder / "feb.CSV").write_text(HEADER + '\nt2,,null,"a ""b"", c",m1,d1,,IN,,0\nt3,x,1,c,m,d,w,IN,A,0\n')
    (folder / "notes.txt").write_text("not a table\n")
    return str(folder)


def test_folder_scan_takes_any_case_and_missing_tokens(spark, transactions):
    rows = {r["txn_id"]: r for r in raw_csv.read_raw(spark, transactions, "raw_transactions").collect()}
    assert sorted(rows) == ["t1", "t2", "t3"]
    assert rows["t1"]["amount"] == " 5.0 " and rows["t1"]["country"] is None
    assert rows["t2"]["txn_ts"] is None and rows["t2"]["amount"] is None and rows["t2"]["card_id"] == 'a "b", c'
    kept = raw_csv.read_raw(spark, transactions, "raw_transactions", missing_tokens=False)
    assert kept.where("txn_id = 't1'").first()["country"] == "NA"


def test_wrong_header_is_refused(spark, tmp_path):
    path = tmp_path / "cards.csv"
    path.write_text("card_id,issuer,bin,card_type\nc,i,b,t\n")
    with pytest.raises(Exception):
        raw_csv.read_raw(spark, str(path), "raw_cards").collect()


def test_missing_path_is_an_empty_frame(spark):
    df = raw_csv.read_raw(spark, "/nowhere/cards.csv", "raw_cards")
    assert df.columns == RAW_COLUMNS["raw_cards"] and df.isEmpty()


def test_reload_append_and_reconcile(spark, transactions, database, tmp_path):
    paths = {"raw_transactions": transactions, "raw_cards": "/nowhere/cards.csv"}
    for _ in range(2):
        report = {r["table_name"]: r for r in raw_csv.reload_raw(spark, paths, database).collect()}
    assert len(report) == 6 and report["raw_transactions"]["stored_rows"] == 3 and report["raw_cards"]["stored_rows"] == 0
    assert all(r["matches"] for r in report.values())
    more = tmp_path / "mar.csv"
    more.write_text(HEADER + "\nt4,,,,,,,,,\n")
    assert raw_csv.append_raw(spark, str(more), "raw_transactions", database) == 1
    assert spark.table(f"{database}.raw_transactions").count() == 4


def test_a_failing_load_keeps_the_old_tables(spark, transactions, database, tmp_path):
    raw_csv.reload_raw(spark, {"raw_transactions": transactions}, database)
    before = {t: spark.table(f"{database}.{t}").count() for t in RAW_COLUMNS}
    bad = tmp_path / "bad.csv"
    bad.write_text("card_id,issuer,bin,card_type\nc,i,b,t\n")
    other = tmp_path / "other.csv"
    other.write_text(HEADER + "\nt9,,,,,,,,,\n")
    with pytest.raises(Exception):
        # The first table is complete beside the old one when the last one fails.
        raw_csv.reload_raw(spark, {"raw_transactions": str(other), "raw_cards": str(bad)}, database)
    with pytest.raises(Exception):
        raw_csv.append_raw(spark, str(bad), "raw_cards", database)
    assert {t: spark.table(f"{database}.{t}").count() for t in RAW_COLUMNS} == before
    assert {r["table_name"] for r in tables.list_tables(spark, database).collect()} == set(RAW_COLUMNS)


def test_a_failing_stage_keeps_the_old_table(spark, database):
    name = f"{database}.stage"
    tables.replace_table(spark.range(5).toDF("x"), name)
    fails = spark.range(2000).repartition(8).select(F.when(F.col("id") == 1999, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("x"))
    with pytest.raises(Exception):
        tables.replace_table(fails, name)
    assert sorted(r["x"] for r in spark.table(name).collect()) == [0, 1, 2, 3, 4]
    # The new rows may be computed from the old ones.
    assert tables.replace_table(spark.table(name).where("x > 2"), name).count() == 2
    assert [t.name for t in spark.catalog.listTables(database) if "__" in t.name] == []
    # What a failed write has left does not stand in the way.
    with pytest.raises(Exception):
        tables.replace_table(fails, f"{database}.fresh")
    assert tables.replace_table(spark.range(3).toDF("x"), f"{database}.fresh").count() == 3


def test_a_swap_that_stopped_halfway_is_recovered(spark, database):
    name = f"{database}.stage"
    tables.replace_table(spark.range(5).toDF("x"), name)
    staged, _ = tables.write_beside(spark.range(7).toDF("x"), name)
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old_1")
    assert tables.recover_swaps(spark, database) == ["stage"] and spark.table(name).count() == 5
    assert {t.name for t in spark.catalog.listTables(database)} == {*RAW_COLUMNS, "stage"}


def test_a_file_is_appended_once(spark, database, tmp_path):
    path = tmp_path / "mar.csv"
    path.write_text(HEADER + "\nt4,,,,,,,,,\nt5,,,,,,,,,\n")
    again = tmp_path / "apr.csv"
    again.write_text(HEADER + "\nt6,,,,,,,,,\n")
    got = [raw_csv.append_raw_once(spark, str(p), "raw_transactions", database) for p in (path, path, again, again, path)]
    assert got == [2, 0, 1, 0, 0] and spark.table(f"{database}.raw_transactions").count() == 3
    # A load on record whose rows never went in is made good.
    spark.createDataFrame([("raw_cards", "c.csv", 0, 1)], spark.table(f"{database}.raw_loads").schema).write.mode("append").saveAsTable(f"{database}.raw_loads")
    cards = tmp_path / "c.csv"
    cards.write_text("card_id,bin,issuer,card_type\nc,b,i,t\n")
    assert [raw_csv.append_raw_once(spark, str(cards), "raw_cards", database) for _ in range(2)] == [1, 0]


def test_catalog_checks_and_stage_run(spark, database):
    names = {r["table_name"] for r in tables.list_tables(spark, database).collect()}
    assert names == set(RAW_COLUMNS)
    checks = {r["column_name"]: r["column_exists"] for r in tables.check_table(spark, f"{database}.raw_cards", ["bin", "nope"]).collect()}
    assert checks == {"bin": True, "nope": False}
    assert tables.check_table(spark, f"{database}.nothing", ["x"]).first()["table_exists"] is False
    source = spark.createDataFrame([("a",), ("b",)], "txn_id string")
    for _ in range(2):
        report = tables.run_stage(spark, f"{database}.stage", lambda: source, lambda df: quality.row_parity(source, df))
    assert report.first()["rows_match"] and tables.read_source(spark, table=f"{database}.stage").count() == 2


def test_extract_round_trip(spark, tmp_path):
    row = ("t1", dt.datetime(2024, 1, 1, 5), dt.date(2024, 1, 1), Decimal("1.50"), "WEB", None, True, False, 3, 0.123456,
           0, "m", "HIGH", 9, 0.25, True, False)
    path = str(tmp_path / "extract")
    df = spark.createDataFrame([row, (*row[:1], None, None, None, *row[4:])], EXTRACT_SCHEMA)
    extract_csv.write_extract(df, path)
    back = extract_csv.read_extract(spark, path)
    assert back.schema == EXTRACT_SCHEMA and back.exceptAll(df).isEmpty() and back.count() == 2
    size = extract_csv.extract_size(spark, path).first()
    assert size["files"] >= 1 and size["bytes"] > 0
    assert extract_csv.read_extract(spark, str(tmp_path / "nothing")).schema == EXTRACT_SCHEMA


def test_extract_with_bad_values(spark, tmp_path):
    path = tmp_path / "bad.csv"
    names = ",".join(f.name for f in EXTRACT_SCHEMA.fields)
    path.write_text(names + "\nt1,soon,2024-99-01,x,WEB,IN,True,False,3,0.5,0,m,LOW,9,0.1,maybe,0\n")
    row = extract_csv.read_extract(spark, str(path)).first()
    assert (row["txn_ts"], row["txn_date"], row["amount"], row["is_high_risk_merchant"]) == (None, None, None, None)
    assert row["is_fraud"] is True and row["is_emulator_device"] is False


def test_shared_folder_follows_the_session_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder.startswith(named) if named else folder.startswith("file:")
    df = write_and_read(spark.range(5).toDF("x"), f"{folder}/five")
    assert df.count() == 5 and "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
