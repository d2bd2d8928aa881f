"""A random forest as plain arrays: reading what Spark ML has fitted, and scoring whole tables.

A fitted Spark ML forest keeps its training summary, and with it the session; prediction
functions that carry it cannot be sent to tasks once the session holds an observation.
Arrays of trees have no such ties. Their size is fixed by trees x 2^depth.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.sources.shared import remove_folder, shared_folder

# Executors need not have this package installed: the functions below travel by value.
register_pickle_by_value(sys.modules[__name__])

#: One tree: per node the children (-1 for a leaf), feature, threshold, training weight and fraud share.
Tree = dict[str, list]


def trees_of(spark: SparkSession, forest: RandomForestClassificationModel) -> list[Tree]:
    """The trees of a fitted forest, from the data a saved forest holds."""
    path = f"{shared_folder(spark)}/forest-{uuid4().hex}"
    forest.write().overwrite().save(path)
    stored = spark.read.parquet(f"{path}/data").select(
        "treeID", "nodeData.id", "nodeData.leftChild", "nodeData.rightChild",
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.try_element_at("nodeData.split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"),
        F.aggregate("nodeData.impurityStats", F.lit(0.0), lambda a, x: a + x).alias("weight"),
        F.element_at("nodeData.impurityStats", 2).alias("fraud_weight"),
    ).toPandas()
    remove_folder(spark, path)
    trees = []
    for _, tree in stored.sort_values(["treeID", "id"]).groupby("treeID"):
        trees.append({
            "left": tree["leftChild"].tolist(), "right": tree["rightChild"].tolist(),
            "feature": tree["feature"].tolist(), "threshold": tree["threshold"].fillna(0.0).tolist(),
            "weight": tree["weight"].tolist(), "value": (tree["fraud_weight"] / tree["weight"]).tolist(),
        })
    return trees


#: Bins of a number; a forest has at most one threshold less.
BINS = 32
#: Relative error in rank of the bin edges.
EDGE_ERROR = 1e-4


def bin_edges(df: DataFrame, inputs: list[str]) -> list[list[float]]:
    """Upper edges of at most BINS bins per input, from all rows; fraud and other rows give half of them each."""
    points = [i / (BINS // 2) for i in range(1, BINS // 2)]
    of_class = [F.percentile_approx(F.when(F.col("label") == label, F.col(c)), points, round(1 / EDGE_ERROR)).alias(f"e{label}_{c}")
                for c in inputs for label in (0, 1)]
    found = df.agg(*of_class, *[F.max(c).alias(f"top_{c}") for c in inputs]).first()
    # The largest value of all closes the last bin, so every value has an edge at or above it.
    return [sorted({*(found[f"e0_{c}"] or []), *(found[f"e1_{c}"] or []), found[f"top_{c}"]}) for c in inputs]


def equal_rows(df: DataFrame, inputs: list[str], edges: list[list[float]], size: int) -> DataFrame:
    """Rows of one class that lie in the same bins, added up in blocks of at most ``size`` rows of equal weight.

    A value becomes the upper edge of its bin. What comes out: the inputs, label, weight and ``block``, a number that parts equal blocks.
    """
    binned = {c: F.coalesce(*[F.when(F.col(c) <= e, F.lit(e)) for e in edge]) for c, edge in zip(inputs, edges)}
    cells = df.select(*[value.alias(c) for c, value in binned.items()], "label", "weight").groupBy(*inputs, "label").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("weight").alias("_weight"))
    blocks = F.ceil(F.col("_rows") / size)
    return cells.select(*inputs, "label", (F.col("_weight") / blocks).alias("weight"),
                        F.explode(F.sequence(F.lit(1).cast("bigint"), blocks)).alias("block"))


def with_edges(trees: list[Tree], edges: list[list[float]]) -> list[Tree]:
    """Trees grown on the edges of bins, with the lower of the two edges that a threshold lies between as threshold."""
    def threshold(left: int, feature: int, value: float) -> float:
        return edges[feature][max(bisect_right(edges[feature], value) - 1, 0)] if left >= 0 else value

    return [tree | {"threshold": [*map(threshold, tree["left"], tree["feature"], tree["threshold"])]} for tree in trees]


def forest_output(trees: list[dict[str, np.ndarray]], rows: np.ndarray) -> np.ndarray:
    """Mean leaf value over the trees, per row. All rows step down a tree together."""
    total = np.zeros(len(rows))
    everyone = np.arange(len(rows))
    for tree in trees:
        at = np.zeros(len(rows), np.int64)
        while True:
            inner = tree["left"][at] >= 0
            if not inner.any():
                break
            goes_left = rows[everyone, np.maximum(tree["feature"][at], 0)] <= tree["threshold"][at]
            at = np.where(inner, np.where(goes_left, tree["left"][at], tree["right"][at]), at)
        total += tree["value"][at]
    return total / len(trees)


def as_arrays(trees: list[Tree]) -> list[dict[str, np.ndarray]]:
    return [{name: np.asarray(values) for name, values in tree.items()} for tree in trees]


def forest_score(spark: SparkSession, trees: list[Tree], inputs: list[str]) -> Column:
    """The forest's fraud probability from the columns ``inputs``, in Arrow batches."""
    shared = spark.sparkContext.broadcast(trees)

    @F.pandas_udf("double")
    def output(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        arrays = as_arrays(shared.value)
        for columns in batches:
            yield pd.Series(forest_output(arrays, np.column_stack([c.to_numpy(float) for c in columns])))

    return output(*inputs)


def thresholds_of(trees: list[Tree], features: int) -> list[list[float]]:
    """The forest's distinct thresholds per feature; a fitted forest has at most its number of bins less one."""
    found: list[set[float]] = [set() for _ in range(features)]
    for tree in trees:
        for left, feature, threshold in zip(tree["left"], tree["feature"], tree["threshold"]):
            if left >= 0:
                found[feature].add(threshold)
    return [sorted(values) for values in found]


def interval_columns(values: list[Column], limits: list[list[float]]) -> dict[str, Column]:
    """Per value the number of thresholds below it, which is all that the forest sees of it."""
    return {
        f"_v{i}": sum((F.when(value > limit, 1).otherwise(0) for limit in limits[i]), F.lit(0))
        for i, value in enumerate(values)
    }


def interval_values(part: pd.DataFrame, limits: list[list[float]]) -> np.ndarray:
    """A value for every interval number: its upper end, or one beyond the last threshold."""
    return np.column_stack([
        np.append(edge, (edge[-1] if edge else 0.0) + 1.0)[part[f"_v{i}"].to_numpy()] for i, edge in enumerate(limits)])


def many_tasks(spark: SparkSession) -> int:
    """Combinations of intervals are few but costly: they are spread by count, not by bytes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def add_forest_score(df: DataFrame, trees: list[Tree], inputs: list[str], name: str) -> DataFrame:
    """Add the forest's fraud probability; the trees are walked once per combination of intervals.

    Rows share their combination with many others: with at most 31 thresholds per number and one per flag there are at
    most 32^3 x 2^2 combinations however large the table is, so what is joined back is small and its
    measured size decides how.
    """
    spark = df.sparkSession
    limits = thresholds_of(trees, len(inputs))
    shared = spark.sparkContext.broadcast((trees, limits))
    intervals = interval_columns([F.col(c) for c in inputs], limits)
    keyed = df.withColumns(intervals)

    def output(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees, edges = shared.value
        arrays = as_arrays(trees)
        for part in batches:
            yield part.assign(**{name: forest_output(arrays, interval_values(part, edges))})

    layout = ", ".join([*[f"{v} int" for v in intervals], f"{name} double"])
    outputs = keyed.select(*intervals).distinct().repartition(many_tasks(spark)).mapInPandas(output, layout)
    return keyed.join(outputs, list(intervals), "left").drop(*intervals)


def rows_per_node(df: DataFrame, trees: list[Tree], inputs: list[str]) -> list[list[int]]:
    """Rows of ``df`` that pass each node of each tree, from one reading.

    Equal combinations of intervals are added up first; what is collected has the size of the forest.
    """
    spark = df.sparkSession
    limits = thresholds_of(trees, len(inputs))
    shared = spark.sparkContext.broadcast((trees, limits))
    intervals = interval_columns([F.col(c) for c in inputs], limits)
    counted = df.select(*[value.alias(v) for v, value in intervals.items()]).groupBy(*intervals).agg(F.count(F.lit(1)).alias("rows"))

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees, edges = shared.value
        arrays = as_arrays(trees)
        totals = [np.zeros(len(tree["left"]), np.int64) for tree in arrays]
        for part in batches:
            values, weight = interval_values(part, edges), part["rows"].to_numpy()
            everyone = np.arange(len(part))
            for tree, total in zip(arrays, totals):
                at, here = np.zeros(len(part), np.int64), everyone
                np.add.at(total, at, weight)
                while len(here := here[tree["left"][at[here]] >= 0]):
                    node = at[here]
                    goes_left = values[here, tree["feature"][node]] <= tree["threshold"][node]
                    at[here] = np.where(goes_left, tree["left"][node], tree["right"][node])
                    np.add.at(total, at[here], weight[here])
        yield pd.concat([
            pd.DataFrame({"tree": k, "node": np.flatnonzero(total), "rows": total[total > 0]}) for k, total in enumerate(totals)])

    counts = [[0] * len(tree["left"]) for tree in trees]
    walked = counted.repartition(many_tasks(spark)).mapInPandas(walk, "tree int, node int, rows bigint")
    for r in walked.groupBy("tree", "node").agg(F.sum("rows").alias("rows")).collect():
        counts[r["tree"]][r["node"]] = r["rows"]
    return counts


def fold_small_nodes(trees: list[Tree], counts: list[list[int]], least: int) -> list[Tree]:
    """The trees without splits of nodes that fewer than ``least`` rows reach; such a node answers itself."""
    folded = []
    for tree, rows in zip(trees, counts):
        kept: Tree = {name: [] for name in tree}
        waiting = [(0, None, None)]  # node, the place of its parent, the side
        while waiting:
            node, parent, side = waiting.pop()
            place = len(kept["left"])
            if parent is not None:
                kept[side][parent] = place
            for name in tree:
                kept[name].append(tree[name][node])
            if tree["left"][node] >= 0 and rows[node] >= least:
                waiting += [(tree["right"][node], place, "right"), (tree["left"][node], place, "left")]
            else:
                kept["left"][place] = kept["right"][place] = -1
        folded.append(kept)
    return folded


def importances_of(trees: list[Tree], features: int) -> list[float]:
    """Share of each feature in the impurity that splits take away, each tree counted alike."""
    total = np.zeros(features)
    for tree in as_arrays(trees):
        inner = np.flatnonzero(tree["left"] >= 0)
        impurity = tree["weight"] * 2 * tree["value"] * (1 - tree["value"])
        gain = np.zeros(features)
        np.add.at(gain, tree["feature"][inner], impurity[inner] - impurity[tree["left"][inner]] - impurity[tree["right"][inner]])
        if gain.sum() > 0:
            total += gain / gain.sum()
    return (total / total.sum() if total.sum() > 0 else total).tolist()
