import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tollgate.operators import analytics, concentration, display, filters, overview, profiling, quality, rule_texts, rules

LAYOUT = ("txn_id_clean string, card_id_clean string, merchant_id_clean string, merchant_risk_tier string, "
          "channel_std string, country_std string, txn_ts timestamp_ntz, txn_date date, amount decimal(12,2), "
          "is_fraud boolean, txns_last_24h long, declined_txns_last_24h long, amount_vs_card_avg double, "
          "merchant_fraud_rate_30d double, is_high_risk_merchant boolean, is_emulator_device boolean")


def row(i, **over):
    base = dict(
        txn_id_clean=f"t{i}", card_id_clean="c", merchant_id_clean="m", merchant_risk_tier="LOW", channel_std="WEB",
        country_std="IN", txn_ts=dt.datetime(2024, 1, 1, 5), txn_date=dt.date(2024, 1, 1), amount=Decimal("10.00"),
        is_fraud=False, txns_last_24h=1, declined_txns_last_24h=0, amount_vs_card_avg=1.0,
        merchant_fraud_rate_30d=0.0, is_high_risk_merchant=False, is_emulator_device=False,
    )
    base.update(over)
    return tuple(base.values())


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), LAYOUT)


def test_rate_rounds_half_to_even(spark):
    df = frame(spark, *[row(i, is_fraud=i == 0) for i in range(800)])
    assert analytics.channel_analysis(df).first()["fraud_rate"] == 0.12


def test_missing_keys_are_left_out_and_totals_count_labels(spark):
    df = frame(spark, row(1, is_fraud=True), row(2, is_fraud=None), row(3, country_std=None))
    got = analytics.geographic_analysis(df).collect()
    assert [tuple(r) for r in got] == [("IN", 1, 1, 100.0)]
    only_unknown = frame(spark, row(1, is_fraud=None))
    assert tuple(analytics.geographic_analysis(only_unknown).first()) == ("IN", 0, 0, None)


def test_top_cards_without_scores_or_cards(spark):
    df = frame(spark, row(1, card_id_clean="a", is_fraud=True), row(2, card_id_clean="b"))
    top = analytics.top_risky_cards(df, 1).first()
    assert (top["card_id"], top["total_amount"], top["avg_risk_score"]) == ("a", Decimal("10.00"), 0.5)
    scored = rules.score_by_rules(df).drop("card_id_clean")
    assert analytics.top_risky_cards(scored, 1).columns == ["transaction_id", "risk_score", "is_fraud", "amount"]


def test_filters_ignore_all_none_and_absent_columns(spark):
    df = frame(spark, row(1), row(2, txn_date=dt.date(2024, 1, 3), is_fraud=True), row(3, is_fraud=None, country_std="US"))
    assert filters.apply_filters(df, channel="All", country=None, fraud="All").count() == 3
    assert filters.apply_filters(df.drop("country_std"), country="US").count() == 3
    assert filters.apply_filters(df, date_start="2024-01-01", date_end=dt.date(2024, 1, 1)).count() == 2
    assert filters.apply_filters(df, fraud="Fraud Only").count() == 1
    assert filters.apply_filters(df, fraud="Non-Fraud Only", country="IN").count() == 1


def test_filter_reaches_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, row(1)).write.parquet(path)
    plan = filters.apply_filters(spark.read.parquet(path), country="IN").select("txn_id_clean")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(country_std,IN)" in text
    assert "ReadSchema: struct<txn_id_clean:string,country_std:string>" in text


def test_pages_are_consistent_with_the_overview_order(spark):
    df = frame(spark, *[row(i, txns_last_24h=i % 3) for i in range(25)])
    scored = rules.score_by_rules(df)
    every = [r["txn_id_clean"] for r in display.sort_overview(scored).collect()]
    pages = [[r["txn_id_clean"] for r in display.page(scored, n, 10).collect()] for n in (1, 2, 3, 4)]
    assert [x for page in pages for x in page] == every and len(pages[2]) == 5 and pages[3] == []
    assert display.page_count(scored, 10).first()["pages"] == 3
    by_date = [r["txn_id_clean"] for r in display.page(df, 1, 25).collect()]
    assert by_date == [r["txn_id_clean"] for r in display.sort_overview(df).collect()]


def test_overview_counts_only_filtered_categories(spark):
    df = frame(spark, row(1), row(2, channel_std="POS", country_std="US", is_fraud=True), row(3, channel_std=None))
    got = overview.dataset_overview(df, F.col("channel_std") == "WEB").first()
    assert (got["total_rows"], got["filtered_rows"], got["channels"], got["countries"], got["fraud_count"]) == (3, 1, 1, 1, 0)
    empty = overview.dataset_overview(df.limit(0), F.lit(True)).first()
    assert (empty["total_rows"], empty["fraud_pct"], empty["amount_avg"]) == (0, None, None)


def test_band_distribution_is_zero_filled(spark):
    df = frame(spark, row(1), row(2), row(3)).withColumn("risk_band", F.lit("LOW"))
    assert [tuple(r) for r in overview.band_distribution(df).collect()] == [
        ("LOW", 3, 100.0), ("MEDIUM", 0, 0.0), ("HIGH", 0, 0.0)]


@pytest.mark.parametrize("score,band", [(0.299999, "LOW"), (0.3, "MEDIUM"), (0.6, "HIGH")])
def test_bands(spark, score, band):
    assert spark.range(1).select(rules.risk_band(F.lit(score))).first()[0] == band


def test_rule_score_caps_and_neutral_values(spark):
    worst = row(1, txns_last_24h=90, declined_txns_last_24h=50, amount_vs_card_avg=-40.0, merchant_fraud_rate_30d=1.0,
                is_high_risk_merchant=True, is_emulator_device=True)
    unknown = row(2, txns_last_24h=None, declined_txns_last_24h=None, amount_vs_card_avg=None,
                  merchant_fraud_rate_30d=None, is_high_risk_merchant=None, is_emulator_device=None)
    low_ratio = row(3, txns_last_24h=0, amount_vs_card_avg=0.2)
    df = frame(spark, worst, unknown, low_ratio)
    scores = {r["txn_id_clean"]: r["s"] for r in df.select("txn_id_clean", rules.rule_score(df).alias("s")).collect()}
    assert scores == {"t1": 100.0, "t2": 0.0, "t3": 0.0}
    assert df.select(rules.rule_score(df.select("txn_id_clean"))).first()[0] == 0.0


def test_scenario_prior_is_capped(spark):
    df = frame(spark, row(1, amount=Decimal("60000.00"), merchant_risk_tier="HIGH", country_std="US"), row(2))
    got = rules.scenario_prior(df.withColumn("is_emulator", F.lit(1))).orderBy("txn_id_clean").collect()
    assert [r["fraud_prior"] for r in got] == pytest.approx([0.193, 0.033])


def test_rule_texts(spark):
    df = frame(spark, row(1, txns_last_24h=11, declined_txns_last_24h=3, amount_vs_card_avg=2.345, is_emulator_device=True,
                          merchant_fraud_rate_30d=0.125, is_high_risk_merchant=True), row(2))
    got = rule_texts.explain_by_rules(df).orderBy("txn_id_clean").collect()
    assert len(got[0]["explanations"]) == 6 and got[0]["explanations"][0].endswith("11 transactions in the last 24 hours")
    assert got[1]["explanations"] == ["No significant risk factors identified"]
    other = rule_texts.explain_by_rules(df, rule_texts.ORDER_WITHOUT_AMOUNT).orderBy("txn_id_clean").first()["explanations"]
    assert len(other) == 5 and other[1].startswith("Multiple declined")


def test_assessment_branches(spark):
    df = frame(spark, row(1, is_fraud=True), row(2, txns_last_24h=12, is_emulator_device=True), row(3), row(4, txns_last_24h=6),
               row(5), row(6, is_fraud=True), row(7, is_fraud=None))
    score = F.when(F.col("txn_id_clean").isin("t1", "t2", "t3"), 70.0).when(F.col("txn_id_clean").isin("t4", "t5"), 0.4).otherwise(0.1)
    scored = df.withColumn("risk_score", score).withColumn("risk_band", rules.risk_band(F.col("risk_score")))
    texts = [r["assessment"] for r in rule_texts.assess_risk(scored).orderBy("txn_id_clean").collect()]
    assert "FRAUDSTER" in texts[0] and texts[1].endswith("detected: high velocity, emulator device")
    assert "ensemble model" in texts[2] and texts[3].endswith("due to: moderate velocity")
    assert "manual review" in texts[4] and "False Negative" in texts[5] and "legitimate" in texts[6]


def test_type_families_and_profile(spark):
    families = {r[0]: r[1] for r in profiling.type_families(frame(spark, row(1))).collect()}
    assert families == {"numeric": 5, "string": 6, "boolean": 3, "datetime": 2}
    profile = {r[0]: r[1] for r in profiling.table_profile(frame(spark, row(1))).collect()}
    assert profile["rows"] == 1 and profile["columns"] == 16 and profile["has amount"] == 1 and profile["has amt_last_24h"] == 0


def test_pareto_of_tied_merchants(spark):
    rows = [row(i, merchant_id_clean=f"m{i}", is_fraud=i < 2) for i in range(10)] + [row(99, merchant_id_clean="m0", is_fraud=True)]
    got = concentration.pareto(frame(spark, *rows)).orderBy("merchant_rank").collect()
    assert [r["merchant_rank"] for r in got] == list(range(1, 11))
    assert [round(r["cumulative_fraud_pct"], 4) for r in got[:3]] == [66.6667, 100.0, 100.0]
    summary = concentration.concentration(frame(spark, *rows)).first()
    assert (summary["merchants"], summary["p80_merchants"], summary["p80_rank"]) == (10, 1, 1)


def test_quality_reports(spark):
    one, two = frame(spark, row(1)), frame(spark, row(1), row(2, amount=None))
    parity = quality.row_parity(one, two).first()
    assert tuple(parity) == (1, 2, 1, False)
    assert [tuple(r) for r in quality.required_columns(one, ["amount", "nope"]).collect()] == [("amount", True), ("nope", False)]
    rates = {r["column_name"]: r["status"] for r in quality.null_rates(two, ["amount", "is_fraud"]).collect()}
    assert rates == {"amount": "WARN", "is_fraud": "OK"}
