import math

import pytest
from pyspark.sql import functions as F

from tollgate.operators import evaluation as ev

POINTS = [(0.9, True), (0.8, False), (0.7, True), (0.7, False), (0.4, True), (0.2, False), (0.1, False), (0.5, None), (None, True)]


@pytest.fixture()
def df(spark):
    return spark.createDataFrame(POINTS, "risk_score double, is_fraud boolean")


def known():
    return [(s, y) for s, y in POINTS if s is not None and y is not None]


def test_auc_counts_ties_half(df):
    pos = [s for s, y in known() if y]
    neg = [s for s, y in known() if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert ev.roc_auc(df).first()[0] == pytest.approx(want)
    assert ev.roc_auc(df.where("is_fraud")).first()[0] is None


def test_confusion_and_report(df):
    cells = {(r["actual"], r["predicted"]): r["row_count"] for r in ev.confusion_matrix(df).collect()}
    assert cells == {("Legitimate", "Legitimate"): 2, ("Legitimate", "Fraud"): 2, ("Fraud", "Legitimate"): 1, ("Fraud", "Fraud"): 2}
    report = {r["class_name"]: r for r in ev.classification_report(df).collect()}
    assert report["Fraud"]["precision"] == 0.5 and report["Fraud"]["recall"] == pytest.approx(2 / 3)
    assert report["accuracy"]["f1_score"] == pytest.approx(4 / 7) and report["accuracy"]["support"] == 7
    f_fraud, f_other = 2 * 0.5 * (2 / 3) / (0.5 + 2 / 3), 2 * (2 / 3) * 0.5 / (2 / 3 + 0.5)
    assert report["macro avg"]["f1_score"] == pytest.approx((f_fraud + f_other) / 2)
    empty = {r["class_name"]: r for r in ev.classification_report(df.limit(0)).collect()}
    assert empty["Fraud"]["precision"] == 0.0 and empty["Fraud"]["support"] == 0


def test_roc_curve_starts_at_the_origin_and_ends_at_one(df):
    points = [tuple(r) for r in ev.roc_curve(df, drop_intermediate=False).collect()]
    assert points[0] == (math.inf, 0.0, 0.0) and points[-1][1:] == (1.0, 1.0) and len(points) == 7
    kept = [tuple(r) for r in ev.roc_curve(df).collect()]
    # 0.2 lies between two steps that only add a non-fraud row each: a straight line.
    assert [p[0] for p in kept] == [math.inf, 0.9, 0.8, 0.7, 0.4, 0.1]


def test_precision_recall_and_best_f1(df):
    points = [tuple(r) for r in ev.precision_recall_curve(df).collect()]
    assert points[-1] == (None, 1.0, 0.0) and points[0] == (0.1, pytest.approx(3 / 7), 1.0)
    best = ev.best_f1(df).first()
    assert best["best_threshold"] == 0.4 and best["best_f1"] == pytest.approx(0.75)


def test_best_f1_prefers_the_lowest_threshold_among_equals(spark):
    df = spark.createDataFrame([(0.9, True), (0.8, False), (0.7, False), (0.6, True)], "risk_score double, is_fraud boolean")
    assert ev.best_f1(df).first()["best_threshold"] == 0.6


def test_band_performance(df):
    banded = df.withColumn("risk_band", F.when(F.col("risk_score") >= 0.6, "HIGH").otherwise("LOW"))
    got = {r["risk_band"]: tuple(r)[1:] for r in ev.band_performance(banded).collect()}
    assert got["HIGH"] == (4, 2, 0.5, 0.775)
