"""How well a score separates fraud: curves, tables, distributions.

Rows without a label or a score are left out. Curves work on distinct scores: rows of a
score are added up before the shuffle, and cumulative counts come piece by piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.functions.numbers import half_even
from tollgate.operators import ranking

THRESHOLD = 0.5
CLASS_NAMES = {True: "Fraud", False: "Legitimate"}


def labelled(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_fraud").isNotNull() & F.col("risk_score").isNotNull())


def class_name(label: Column) -> Column:
    return F.when(label, CLASS_NAMES[True]).otherwise(CLASS_NAMES[False])


def _confusion(df: DataFrame, threshold: float) -> DataFrame:
    fraud, flagged = F.col("is_fraud"), F.col("risk_score") >= threshold
    return labelled(df).agg(
        F.count_if(~fraud & ~flagged).alias("tn"), F.count_if(~fraud & flagged).alias("fp"),
        F.count_if(fraud & ~flagged).alias("fn"), F.count_if(fraud & flagged).alias("tp"),
    )


def confusion_matrix(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows per (actual, predicted) class, zeros included."""
    cells = [(False, False, "tn"), (False, True, "fp"), (True, False, "fn"), (True, True, "tp")]
    pairs = F.array(*[
        F.struct(F.lit(CLASS_NAMES[a]).alias("actual"), F.lit(CLASS_NAMES[p]).alias("predicted"),
                 F.col(c).alias("row_count"))
        for a, p, c in cells
    ])
    return _confusion(df, threshold).select(F.inline(pairs))


def _ratio(part: Column, whole: Column) -> Column:
    """0 for an empty whole."""
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(precision * recall * 2, precision + recall)


def classification_report(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted means."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    rates = _confusion(df, threshold).select(
        (tn + fp).alias("n0"), (tp + fn).alias("n1"),
        _ratio(tn, tn + fn).alias("p0"), _ratio(tn, tn + fp).alias("r0"),
        _ratio(tp, tp + fp).alias("p1"), _ratio(tp, tp + fn).alias("r1"),
        _ratio(tn + tp, tn + fp + fn + tp).alias("accuracy"),
    ).withColumns({"f0": _f1(F.col("p0"), F.col("r0")), "f1": _f1(F.col("p1"), F.col("r1"))})
    rows = F.col("n0") + F.col("n1")

    def line(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class_name"), precision.alias("precision"), recall.alias("recall"),
            f1.alias("f1_score"), support.alias("support"),
        )

    def macro(measure: str) -> Column:
        return (F.col(f"{measure}0") + F.col(f"{measure}1")) / 2

    def weighted(measure: str) -> Column:
        return _ratio(F.col(f"{measure}0") * F.col("n0") + F.col(f"{measure}1") * F.col("n1"), rows)

    nothing = F.lit(None).cast("double")
    lines = F.array(
        line(CLASS_NAMES[False], F.col("p0"), F.col("r0"), F.col("f0"), F.col("n0")),
        line(CLASS_NAMES[True], F.col("p1"), F.col("r1"), F.col("f1"), F.col("n1")),
        line("accuracy", nothing, nothing, F.col("accuracy"), rows),
        line("macro avg", macro("p"), macro("r"), macro("f"), rows),
        line("weighted avg", weighted("p"), weighted("r"), weighted("f"), rows),
    )
    return rates.select(F.inline(lines))


def score_steps(df: DataFrame) -> DataFrame:
    """Per distinct score, highest first: own, next and cumulative fraud and non-fraud rows."""
    per_score = labelled(df).groupBy("risk_score").agg(
        F.count_if(F.col("is_fraud")).alias("pos"), F.count_if(~F.col("is_fraud")).alias("neg")
    )
    steps = ranking.running_totals(
        per_score, "risk_score", ["pos", "neg"], descending=True, following=["pos", "neg"])
    return steps.select(
        F.col("risk_score").alias("threshold"), "pos", "neg", "next_pos", "next_neg", "before_pos",
        (F.col("before_pos") + F.col("before_neg") == 0).alias("highest"),
        (F.col("before_pos") + F.col("pos")).alias("tp"), (F.col("before_neg") + F.col("neg")).alias("fp"),
        "total_pos", "total_neg",
    )


def roc_auc(df: DataFrame) -> DataFrame:
    """Area under the ROC curve, ties counted half; NULL with a single class."""
    above = F.col("before_pos").cast("double") + F.col("pos") / 2
    pairs = F.nullif(F.max("total_pos").cast("double") * F.max("total_neg"), F.lit(0.0))
    return score_steps(df).agg((F.sum(above * F.col("neg")) / pairs).alias("roc_auc"))


def roc_curve(df: DataFrame, drop_intermediate: bool = True) -> DataFrame:
    """Points (threshold, fpr, tpr) from (0, 0) at an infinite threshold on.

    ``drop_intermediate`` leaves out points on a straight line between their neighbours.
    """
    steps = score_steps(df)
    if drop_intermediate:
        bends = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
        steps = steps.where(F.col("highest") | F.col("next_pos").isNull() | bends)
    origin = F.struct(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    point = F.struct(
        "threshold", _ratio(F.col("fp"), F.col("total_neg")).alias("fpr"),
        _ratio(F.col("tp"), F.col("total_pos")).alias("tpr"),
    )
    points = F.when(F.col("highest"), F.array(origin, point)).otherwise(F.array(point))
    return steps.select(F.inline(points)).orderBy(F.desc("threshold"))


def precision_recall_points(df: DataFrame) -> DataFrame:
    precision = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _ratio(F.col("tp"), F.col("total_pos"))
    return score_steps(df).select("threshold", precision.alias("precision"), recall.alias("recall"), "highest")


def precision_recall_curve(df: DataFrame) -> DataFrame:
    """Points by rising threshold, closed by (1, 0) without a threshold."""
    closing = F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                       F.lit(0.0).alias("recall"))
    point = F.struct("threshold", "precision", "recall")
    points = F.when(F.col("highest"), F.array(point, closing)).otherwise(F.array(point))
    return precision_recall_points(df).select(F.inline(points)).orderBy(F.asc_nulls_last("threshold"))


def best_f1(df: DataFrame) -> DataFrame:
    """The threshold of the best F1 (the lowest one among equals) with its precision and recall.

    Thresholds that flag no fraud have no F1 and are not candidates.
    """
    points = precision_recall_points(df).where(F.col("recall") > 0)
    scored = points.withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    best = F.max_by(F.struct("threshold", "f1", "precision", "recall"), F.struct("f1", -F.col("threshold")))
    return scored.agg(best.alias("best")).select(
        F.col("best.threshold").alias("best_threshold"), F.col("best.f1").alias("best_f1"),
        F.col("best.precision").alias("precision_at_best"), F.col("best.recall").alias("recall_at_best"),
    )


def band_performance(df: DataFrame) -> DataFrame:
    known, fraud = F.count("is_fraud"), F.count_if(F.col("is_fraud"))
    return df.where(F.col("risk_band").isNotNull()).groupBy("risk_band").agg(
        known.alias("total"), fraud.alias("fraud_count"),
        half_even(fraud / F.nullif(known, F.lit(0)), 4).alias("fraud_rate"),
        half_even(F.avg("risk_score"), 4).alias("avg_risk_score"),
    ).orderBy("risk_band")


def _by_class(df: DataFrame) -> DataFrame:
    return labelled(df).withColumn("class_name", class_name(F.col("is_fraud")))


def score_histogram(df: DataFrame, bins: int = 50) -> DataFrame:
    """Rows per score bin and class; each class is binned over its own range."""
    return ranking.histogram(_by_class(df), "risk_score", "class_name", bins)


def score_boxes(df: DataFrame) -> DataFrame:
    return ranking.box_summary(_by_class(df), "risk_score", "class_name")


def score_description(df: DataFrame) -> DataFrame:
    return ranking.describe(df, "risk_score")


def fraud_rate(df: DataFrame) -> DataFrame:
    fraud, known = F.count_if(F.col("is_fraud")), F.count("is_fraud")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), fraud.alias("fraud_count"), (known - fraud).alias("legitimate_count"),
        (fraud / F.nullif(known, F.lit(0)) * 100).alias("fraud_rate_pct"),
    )
