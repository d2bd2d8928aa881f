from pyspark.sql import functions as F

from tollgate.functions.cleaning import collate_keys
from tollgate.operators import enrichment
from tollgate.operators.staging import stage_transactions
from tollgate.plans import stages
from tollgate.schemas import enriched_columns, raw_schema


def transactions(spark, *rows):
    full = [(t, "2024-01-01 00:00:00", "1", card, merchant, device, "web", country, None, "0")
            for t, card, merchant, device, country in rows]
    return stage_transactions(spark.createDataFrame(full, raw_schema("raw_transactions")))


def dimensions(spark):
    merchants = spark.createDataFrame(
        [("m1", "a", " 12", "IN", " high "), ("m2", "b", "", "", "LOW"), ("m2", "c", "7", "US", "")],
        raw_schema("raw_merchants"))
    devices = spark.createDataFrame([("d1", " ios ", "x", " true "), ("d2", "", "x", "y")], raw_schema("raw_devices"))
    cards = spark.createDataFrame([("c1", "4", " VISA", "DEBIT ")], raw_schema("raw_cards"))
    return merchants, devices, cards


def test_left_joins_keep_unmatched_and_repeat_for_duplicate_keys(spark):
    staged = transactions(spark, ("t1", "c1", " m1 ", "d1", "IN"), ("t2", None, "m2", "d2", "US"),
                          ("t3", "cx", "mx", None, None))
    df = enrichment.enrich_transactions(staged, *dimensions(spark))
    assert df.columns == enriched_columns() and len(df.columns) == 43
    rows = {}
    for row in df.collect():
        rows.setdefault(row["txn_id_clean"], []).append(row)
    assert len(rows["t1"]) == 1 and len(rows["t2"]) == 2 and len(rows["t3"]) == 1
    first = rows["t1"][0]
    assert (first["merchant_category"], first["merchant_risk_tier"], first["is_high_risk_merchant"]) == ("12", "high", True)
    assert (first["device_type"], first["os"], first["is_emulator"], first["is_emulator_device"]) == ("ios", "ios", 1, True)
    assert (first["card_network"], first["card_type"], first["issuing_country"]) == ("VISA", "DEBIT", None)
    assert rows["t2"][0]["is_emulator"] is None and rows["t2"][0]["is_emulator_device"] is False
    assert rows["t3"][0]["is_high_risk_merchant"] is False and rows["t3"][0]["is_foreign_transaction"] is False


def test_foreign_flag_needs_both_countries(spark):
    staged = transactions(spark, ("t1", "c1", None, None, "US"), ("t2", "c1", None, None, "IN"), ("t3", "c1", None, None, None))
    merchants, devices, cards = dimensions(spark)
    df = enrichment.enrich_transactions(staged, merchants, devices, cards.withColumn("home", F.lit("IN")), "home")
    assert {r["txn_id_clean"]: r["is_foreign_transaction"] for r in df.collect()} == {"t1": True, "t2": False, "t3": False}


def test_collated_keys_ignore_case_accents_and_trailing_spaces(spark):
    staged = transactions(spark, ("t1", "c1", "M1", None, None), ("t2", "c1", "ḿ1", None, None))
    merchants = dimensions(spark)[0]
    joined = enrichment.add_merchant(
        collate_keys(staged, ["merchant_id_clean"]), collate_keys(merchants, ["merchant_id"])
    )
    assert [r["merchant_risk_tier"] for r in joined.collect()] == ["high", "high"]
    grouped = collate_keys(staged, ["merchant_id_clean"]).groupBy("merchant_id_clean").count()
    assert grouped.count() == 1


def test_large_dimension_is_not_forced_into_a_broadcast(spark, sf_dir):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = stages.enriched(spark, sf_dir)._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_collated_keys_join_by_hash_or_sort(spark, sf_dir):
    """Keys that ignore case and accents still join and group by key, not row by row."""
    from tollgate.plans import registry

    joined = registry.QUERIES["c01_collated_merchant"](spark, sf_dir)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    plainly = registry.QUERIES["c01_merchant"](spark, sf_dir)
    assert joined.count() == plainly.count()
    assert joined.where("merchant_country is not null").count() == plainly.where("merchant_country is not null").count() > 0
