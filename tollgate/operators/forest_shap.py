"""Shapley values of the random forest, for whole tables.

Values are exact for the path-dependent expectation: where a feature is unknown, a
split passes a row on to both sides in proportion to the training weight there. They are
added up leaf by leaf, over the features on the leaf's path only. A
forest sees only between which of its thresholds a value lies, so values are replaced by
interval numbers: with at most 31 thresholds per number and one per flag there are at
most 32^3 x 2^2 combinations however large the table is. They are spread over the tasks,
and the results are joined back. Only the trees (trees x 2^depth nodes) are broadcast.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollgate.functions import wording as w
from tollgate.functions.formatting import fixed
from tollgate.operators.forest import as_arrays, interval_columns, interval_values, many_tasks, thresholds_of
from tollgate.operators.model import ScoringModel
from tollgate.operators.model_texts import FLAGS, direction, feature_value, in_order, texts_above

# Executors need not have this package installed: the functions below travel by value.
register_pickle_by_value(sys.modules[__name__])

SHAP_FLOOR = 0.01
ROWS_AT_ONCE = 4096


def leaf_paths(tree: dict[str, np.ndarray]) -> list[tuple[float, dict[int, list]]]:
    """Per leaf its value and, for every feature on the way to it, [share, lower bound, upper bound].

    ``share`` is the part of the training weight that goes the leaf's way at the splits of that feature; a
    row goes there where its value is above the lower and at most the upper bound.
    """
    leaves, waiting = [], [(0, {})]
    while waiting:
        node, path = waiting.pop()
        left, right = int(tree["left"][node]), int(tree["right"][node])
        if left < 0:
            leaves.append((float(tree["value"][node]), path))
            continue
        feature, threshold = int(tree["feature"][node]), float(tree["threshold"][node])
        share, low, high = path.get(feature, [1.0, -np.inf, np.inf])
        for child, bounds in ((left, [low, min(high, threshold)]), (right, [max(low, threshold), high])):
            waiting.append((child, path | {feature: [share * float(tree["weight"][child]) / float(tree["weight"][node]), *bounds]}))
    return leaves


def path_shapley(trees: list[dict[str, np.ndarray]], rows: np.ndarray) -> np.ndarray:
    """Base value followed by one value per feature, per row.

    A leaf takes part with the product, over the features on its path, of 1 or 0 (feature known: does the row go
    there?) or of its share (unknown). Shapley weights of subsets are integrals of t^k (1-t)^(m-1-k), so a feature's value
    is the integral over t of the others' factors ``known * t + share * (1 - t)``: a polynomial, which a few
    Gauss points integrate exactly. The work is leaves x features on a path, whatever the number of features.
    """
    features = rows.shape[1]
    result = np.zeros((len(rows), features + 1))
    for tree in trees:
        for value, path in leaf_paths(tree):
            names = list(path)
            result[:, 0] += value * np.prod([path[f][0] for f in names]) if names else value
            if not names:
                continue
            points, weights = np.polynomial.legendre.leggauss((len(names) + 1) // 2)
            t, weights = (points + 1) / 2, weights / 2
            known = [((rows[:, f] > path[f][1]) & (rows[:, f] <= path[f][2])).astype(float)[:, None] for f in names]
            factors = [k * t + path[f][0] * (1 - t) for f, k in zip(names, known)]
            after = [np.broadcast_to(weights, (len(rows), len(t)))]
            for factor in reversed(factors[1:]):
                after.append(after[-1] * factor)
            before = 1.0
            for f, k, factor in zip(names, known, factors):
                result[:, f + 1] += value * (k[:, 0] - path[f][0]) * (before * after.pop()).sum(axis=1)
                before = before * factor
    return result / len(trees)


def add_forest_contributions(df: DataFrame, model: ScoringModel) -> DataFrame:
    """Add ``forest_base`` and ``forest_<feature>``; they add up to the forest's probability."""
    features = model.features
    spark = df.sparkSession
    limits = thresholds_of(model.trees, len(features))
    shared = spark.sparkContext.broadcast((model.trees, limits))
    outputs = ["forest_base", *[f"forest_{f}" for f in features]]
    intervals = interval_columns([feature_value(df, f) for f in features], limits)
    keyed = df.withColumns(intervals)

    def explain(batches):
        trees, edges = shared.value
        arrays = as_arrays(trees)
        for batch in batches:
            for start in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.iloc[start:start + ROWS_AT_ONCE].reset_index(drop=True)
                shap = path_shapley(arrays, interval_values(part, edges))
                yield pd.concat([part, pd.DataFrame(shap, columns=outputs)], axis=1)

    layout = ", ".join([*[f"{name} int" for name in intervals], *[f"{name} double" for name in outputs]])
    explained = keyed.select(*intervals).distinct().repartition(many_tasks(spark)).mapInPandas(explain, layout)
    return keyed.join(explained, list(intervals), "left").select(*df.columns, *outputs)


def explain_by_forest(df: DataFrame, model: ScoringModel) -> DataFrame:
    """Add ``explanations``: one text per contributing feature, strongest first."""
    explained = add_forest_contributions(df, model)
    entries = []
    for feature in model.features:
        shap, value = F.col(f"forest_{feature}"), feature_value(df, feature)
        parts = [F.lit(f"{w.FOREST_TITLES[feature]} "), direction(shap), F.lit(" risk by "),
                 fixed(F.abs(shap) * 100, 1), F.lit("%")]
        if feature not in FLAGS:
            rate = feature == "merchant_fraud_rate_30d"
            before, after = w.VALUE_TEXTS[feature].split("{}")
            parts += [F.lit(f" ({before}"), fixed(value * 100, 1) if rate else fixed(value, 0), F.lit(f"{after})")]
        entries.append((F.abs(shap), F.concat(*parts)))
    texts = texts_above(in_order(entries), SHAP_FLOOR, w.SHAP_NONE)
    return explained.withColumn("explanations", texts).select(*df.columns, "explanations")
