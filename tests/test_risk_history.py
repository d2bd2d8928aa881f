import datetime as dt

import pytest

from tollgate.operators import card_activity, risk_history
from tollgate.plans import stages
from tollgate.schemas import feature_columns, risk_columns

LAYOUT = ("txn_id_clean string, card_id_clean string, merchant_id_clean string, txn_ts timestamp_ntz, "
          "is_fraud boolean, is_declined boolean")


def row(i, day, card="c", merchant="m", fraud=False, declined=False, hour=12):
    time = None if day is None else dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=day)
    return (f"t{i}", card, merchant, time, fraud, declined)


def history(spark, rows, build=risk_history.add_risk_history):
    out = build(spark.createDataFrame(rows, LAYOUT))
    return {r["txn_id_clean"]: r for r in out.collect()}


def test_thirty_day_frame_covers_31_days(spark):
    got = history(spark, [row(1, 0), row(2, 30), row(3, 31)])
    assert [got[f"t{i}"]["card_txn_count_30d"] for i in (1, 2, 3)] == [1, 2, 2]


def test_rate_is_the_plain_mean_of_daily_rates(spark):
    got = history(spark, [row(1, 0, fraud=True), row(2, 1), row(3, 1), row(4, 1, declined=True)])
    assert got["t2"]["card_fraud_rate_30d"] == 0.5
    assert got["t2"]["merchant_decline_rate_30d"] == pytest.approx(1 / 6, abs=1e-9)


def test_unknown_label_counts_in_the_denominator(spark):
    got = history(spark, [row(1, 0, fraud=True), row(2, 0, fraud=None)])
    assert got["t1"]["card_fraud_rate_30d"] == 0.5


def test_missing_keys_and_times_get_zero(spark):
    got = history(spark, [row(1, 0, card=None, fraud=True), row(2, None, fraud=True)])
    assert got["t1"]["card_txn_count_30d"] == 0 and got["t1"]["merchant_txn_count_30d"] == 1
    assert got["t2"]["card_fraud_rate_30d"] == 0.0 and got["t2"]["merchant_txn_count_30d"] == 0


def test_recent_slice_loses_earlier_history(spark):
    rows = [row(1, 0), row(2, 20), row(3, 40), row(4, None)]
    got = history(spark, rows, risk_history.add_risk_history_to_recent)
    assert sorted(got) == ["t2", "t3"]
    assert got["t2"]["card_txn_count_30d"] == 1 and history(spark, rows)["t2"]["card_txn_count_30d"] == 2


def test_fused_build_equals_the_stage_chain(spark, sf_dir):
    enriched = stages.stage_table(spark, sf_dir, "enriched")
    features = card_activity.add_card_activity(enriched)
    chain = risk_history.add_risk_history(features)
    fused = stages.add_all_features(enriched)
    assert features.columns == feature_columns() and len(feature_columns()) == 49
    assert chain.columns == fused.columns == risk_columns() and len(risk_columns()) == 55
    assert chain.exceptAll(fused).isEmpty() and fused.exceptAll(chain).isEmpty()
    assert fused.count() == enriched.count()


def test_risk_stage_reads_the_wide_rows_once_per_key(spark, sf_dir):
    """The stored stage has the rows of the chain, and is built without the table of card features."""
    fresh = f"{sf_dir}/."  # a source folder of its own, so that no stage of it is written yet
    got = stages.stage_table(spark, fresh, "risk")
    application = spark.sparkContext.applicationId
    assert (application, fresh, "features") not in stages._written
    features = card_activity.add_card_activity(stages.stage_table(spark, fresh, "enriched"))
    want = risk_history.add_risk_history(features)
    assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
