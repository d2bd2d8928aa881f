import itertools
import math
import time
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tollgate.operators import forest_shap, model, model_texts
from tollgate.schemas import MODEL_FEATURES


@pytest.fixture(scope="module")
def table(spark):
    """Fraud follows the merchant rate and velocity; some numbers are missing."""
    i = F.col("id")
    rate = (i % 17) / 20.0
    velocity = i % 23
    noise = (F.abs(F.xxhash64(i)) % 1000) / 1000.0
    return spark.range(3000).select(
        F.concat(F.lit("t"), i).alias("txn_id_clean"),
        F.when(i % 31 != 0, velocity).alias("txns_last_24h"), (i % 4).alias("declined_txns_last_24h"),
        rate.alias("merchant_fraud_rate_30d"), (i % 3 == 0).alias("is_high_risk_merchant"),
        F.when(i % 29 != 0, i % 5 == 0).alias("is_emulator_device"),
        F.when(i % 37 != 0, (rate + velocity / 60.0 + noise) > 1.3).alias("is_fraud"),
    ).cache()


@pytest.fixture(scope="module")
def fitted(table):
    return model.fit(table)


def test_impute_uses_batch_medians(table):
    filled = model.impute(table, MODEL_FEATURES)
    known = sorted(r[0] for r in table.select("txns_last_24h").where("txns_last_24h is not null").collect())
    assert filled.where("txn_id_clean = 't0'").first()["txns_last_24h"] == np.median(known)
    assert filled.where("txn_id_clean = 't29'").first()["is_emulator_device"] == 0.0
    nothing = table.limit(3).withColumn("txns_last_24h", F.lit(None).cast("long"))
    assert {r["txns_last_24h"] for r in model.impute(nothing, MODEL_FEATURES).collect()} == {0.0}


def test_scores_are_probabilities_that_rank_fraud(table, fitted):
    scored = model.score(table, fitted)
    assert scored.columns == [*table.columns, "risk_score", "risk_band"] and scored.count() == 3000
    low, high = scored.agg(F.min("risk_score"), F.max("risk_score")).first()
    assert 0 <= low < high <= 1
    by_label = {r["is_fraud"]: r["s"] for r in scored.groupBy("is_fraud").agg(F.avg("risk_score").alias("s")).collect()}
    assert by_label[True] > by_label[False] + 0.2
    bands = {r["risk_band"]: r for r in scored.groupBy("risk_band").agg(F.min("risk_score"), F.max("risk_score")).collect()}
    assert bands["HIGH"][1] >= 0.6 and bands["LOW"][2] < 0.3


def test_ensemble_is_the_mean_of_both(table, fitted):
    both = model.model_scores(table, fitted).join(model.score(table, fitted).select("txn_id_clean", "risk_score"), "txn_id_clean")
    gap = both.select(F.max(F.abs(F.col("risk_score") - (F.col("lr_score") + F.col("rf_score")) / 2))).first()[0]
    assert gap < 1e-12


def test_save_load_and_feature_check(spark, table, fitted, tmp_path):
    path = str(tmp_path / "model")
    assert model.load_model(spark, path, MODEL_FEATURES) is None
    model.save_model(fitted, path)
    loaded = model.load_model(spark, path, list(reversed(MODEL_FEATURES)))
    assert loaded.coefficients == fitted.coefficients and loaded.trees == fitted.trees
    before, after = model.score(table, fitted), model.score(table, loaded)
    assert before.exceptAll(after).isEmpty()
    assert model.load_model(spark, path, MODEL_FEATURES[:3]) is None


def test_dispatch(spark, table, tmp_path):
    path = str(tmp_path / "model")
    no_features = table.select("txn_id_clean", "is_fraud")
    assert model.score_transactions(no_features).agg(F.max("risk_score")).first()[0] == 0.0
    rules_only = model.score_transactions(table.drop("is_fraud"), path)
    assert model.load_model(spark, path, MODEL_FEATURES) is None and rules_only.count() == 3000
    small = table.limit(600)
    model.score_transactions(small, path)
    assert model.load_model(spark, path, MODEL_FEATURES) is not None
    # The saved model now scores rows without labels.
    assert model.score_transactions(table.drop("is_fraud"), path).exceptAll(
        model.score(table.drop("is_fraud"), model.load_model(spark, path, MODEL_FEATURES))).isEmpty()
    empty = model.score_transactions(table.limit(0))
    assert empty.count() == 0 and {"risk_score", "risk_band"} <= set(empty.columns)
    assert model.retrain(small, path) is False
    assert model.retrain(table, path, force=True) is True
    assert model.load_model(spark, path, MODEL_FEATURES).coefficients != model.fit(small, with_forest=False).coefficients


def test_regression_only_and_placeholder(table, fitted):
    assert {r["risk_score"] for r in model.score_with_regression(table, None).collect()} == {0.5}
    assert model.score_with_regression(table.select("txn_id_clean"), fitted).first()["risk_band"] == "MEDIUM"
    alone = model.score_with_regression(table, fitted).select("txn_id_clean", "risk_score")
    lr = model.model_scores(table, fitted).select("txn_id_clean", F.col("lr_score").alias("risk_score"))
    assert alone.exceptAll(lr).isEmpty()


def test_forest_scores_after_an_observation(spark, table):
    """A session that has observed rows still scores with a freshly fitted forest."""
    seen = Observation()
    table.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == 3000
    fresh = model.fit(table, trees=3)
    assert len(fresh.trees) == 3
    model.score(table, fresh).write.format("noop").mode("overwrite").save()


def test_forest_score_equals_spark_ml(table, tmp_path):
    """The arrays give what the ML library's own forest gives."""
    from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from tollgate.operators.forest import forest_score, trees_of

    filled = model.impute(table.where("is_fraud is not null"), MODEL_FEATURES).withColumn("label", F.col("is_fraud").cast("double"))
    inputs = VectorAssembler(inputCols=MODEL_FEATURES, outputCol="inputs").transform(filled)
    forest = RandomForestClassifier(featuresCol="inputs", labelCol="label", numTrees=5, seed=1).fit(inputs)
    trees = trees_of(table.sparkSession, forest)
    own = forest_score(table.sparkSession, trees, MODEL_FEATURES)
    forest.write().save(str(tmp_path / "forest"))
    loaded = RandomForestClassificationModel.load(str(tmp_path / "forest"))
    rows = loaded.transform(inputs).select(own.alias("own"), vector_to_array(F.col("probability"))[1].alias("theirs")).collect()
    assert max(abs(r["own"] - r["theirs"]) for r in rows) < 1e-9


def test_training_needs_both_classes(table):
    with pytest.raises(ValueError, match="both classes"):
        model.fit(table.where("not is_fraud"))
    assert model.score_transactions(table.where("not is_fraud")).count() > 0


def test_vectors_explained_are_bounded_by_the_forest(spark, table, fitted):
    """Ten times more distinct rates give the same intervals."""
    from tollgate.operators.forest import thresholds_of

    limits = thresholds_of(fitted.trees, len(fitted.features))
    rates = limits[MODEL_FEATURES.index("merchant_fraud_rate_30d")]
    assert 0 < len(rates) <= 31
    many = table.withColumn("merchant_fraud_rate_30d", F.rand(1))
    explained = forest_shap.add_forest_contributions(many, fitted)
    combinations = explained.select("forest_base", *[f"forest_{f}" for f in MODEL_FEATURES]).distinct().count()
    assert combinations <= np.prod([len(edges) + 1 for edges in limits])
    assert many.select("merchant_fraud_rate_30d").distinct().count() == 3000


def test_model_tables(spark, fitted):
    coefficients = model.coefficient_table(spark, fitted).collect()
    sizes = [r["abs_coefficient"] for r in coefficients]
    assert sizes == sorted(sizes, reverse=True) and coefficients[0]["feature"] == "merchant_fraud_rate_30d"
    info = model.model_info(spark, fitted).first()
    assert info["status"] == "Model trained" and info["coefficients"]["txns_last_24h"] == fitted.coefficients[0]
    assert model.model_info(spark, None).first()["status"] == "No model trained"
    importances = [r["importance"] for r in model.forest_importances(spark, fitted).collect()]
    assert sum(importances) == pytest.approx(1) and importances == sorted(importances, reverse=True)


def test_regression_contributions_add_up_to_the_log_odds(table, fitted):
    full = table.where("txns_last_24h is not null and is_emulator_device is not null")
    df = model_texts.add_contributions(model.model_scores(full, fitted), fitted)
    total = F.col("base_value") + sum(F.col(f"shap_{f}") for f in MODEL_FEATURES)
    odds = F.log(F.col("lr_score") / (1 - F.col("lr_score")))
    assert df.select(F.max(F.abs(total - odds))).first()[0] < 1e-9


def test_forest_contributions_add_up_to_the_probability(table, fitted):
    full = table.where("txns_last_24h is not null and is_emulator_device is not null")
    df = forest_shap.add_forest_contributions(model.model_scores(full, fitted), fitted)
    total = F.col("forest_base") + sum(F.col(f"forest_{f}") for f in MODEL_FEATURES)
    assert df.count() == full.count()
    assert df.select(F.max(F.abs(total - F.col("rf_score")))).first()[0] < 1e-9


def test_shapley_values_against_all_orders():
    """One tree: feature 0 at the root, feature 1 below; values from every order of revealing."""
    tree = {
        "left": np.array([1, -1, 3, -1, -1]), "right": np.array([2, -1, 4, -1, -1]),
        "feature": np.array([0, -1, 1, -1, -1]), "threshold": np.array([0.5, np.nan, 2.0, np.nan, np.nan]),
        "weight": np.array([10.0, 4.0, 6.0, 2.0, 4.0]), "value": np.array([0.0, 0.1, 0.0, 0.4, 0.9]),
    }

    def expected(x, known, node=0):
        if tree["left"][node] < 0:
            return tree["value"][node]
        left, right, feature = tree["left"][node], tree["right"][node], tree["feature"][node]
        if feature in known:
            return expected(x, known, left if x[feature] <= tree["threshold"][node] else right)
        share = tree["weight"][left] / tree["weight"][node]
        return share * expected(x, known, left) + (1 - share) * expected(x, known, right)

    rows = np.array([[0.2, 1.0], [0.8, 1.0], [0.8, 3.0]])
    got = forest_shap.path_shapley([tree], rows)
    for x, values in zip(rows, got):
        want = np.zeros(2)
        for order in itertools.permutations(range(2)):
            for place, feature in enumerate(order):
                known = set(order[:place])
                want[feature] += (expected(x, known | {feature}) - expected(x, known)) / 2
        assert values[0] == pytest.approx(expected(x, set())) and list(values[1:]) == pytest.approx(list(want))


def subset_shapley(trees, rows):
    """Base and Shapley values from the expectations of all subsets of known features."""
    features = rows.shape[1]

    def expected(tree, known, node=0):
        if tree["left"][node] < 0:
            return np.full(len(rows), tree["value"][node])
        left, right, feature = tree["left"][node], tree["right"][node], tree["feature"][node]
        a, b = expected(tree, known, left), expected(tree, known, right)
        if known >> feature & 1:
            return np.where(rows[:, feature] <= tree["threshold"][node], a, b)
        share = tree["weight"][left] / tree["weight"][node]
        return share * a + (1 - share) * b

    means = [sum(expected(tree, known) for tree in trees) / len(trees) for known in range(2 ** features)]
    result = np.zeros((len(rows), features + 1))
    result[:, 0] = means[0]
    for i in range(features):
        for known in range(2 ** features):
            if not known >> i & 1:
                size = bin(known).count("1")
                share = math.factorial(size) * math.factorial(features - size - 1) / math.factorial(features)
                result[:, i + 1] += share * (means[known | 1 << i] - means[known])
    return result


def random_tree(rnd, features, depth):
    """Splits on any feature, also twice on one path."""
    tree = {name: [] for name in ("left", "right", "feature", "threshold", "weight", "value")}

    def grow(level, weight):
        place = len(tree["left"])
        for name, value in (("left", -1), ("right", -1), ("feature", -1), ("threshold", 0.0), ("weight", weight), ("value", rnd.random())):
            tree[name].append(value)
        if level and (level == depth or rnd.random() < 0.9):
            share = rnd.uniform(0.1, 0.9)
            tree["feature"][place], tree["threshold"][place] = int(rnd.integers(features)), rnd.random()
            tree["left"][place] = grow(level - 1, weight * share)
            tree["right"][place] = grow(level - 1, weight * (1 - share))
        return place

    grow(depth, 1000.0)
    return {name: np.asarray(values) for name, values in tree.items()}


def test_shapley_values_by_paths_equal_those_by_subsets(fitted):
    from tollgate.operators.forest import as_arrays

    rnd = np.random.default_rng(1)
    rows = np.column_stack([rnd.integers(0, 23, 40), rnd.integers(0, 4, 40), rnd.random(40), rnd.integers(0, 2, 40), rnd.integers(0, 2, 40)]).astype(float)
    trees = as_arrays(fitted.trees[:10])
    assert np.abs(forest_shap.path_shapley(trees, rows) - subset_shapley(trees, rows)).max() < 1e-9
    for features in (1, 3, 7):
        trees = [random_tree(rnd, features, 6) for _ in range(4)]
        rows = rnd.random((30, features))
        assert np.abs(forest_shap.path_shapley(trees, rows) - subset_shapley(trees, rows)).max() < 1e-9


def test_shapley_values_of_fifteen_features():
    from tollgate.operators.forest import forest_output

    rnd = np.random.default_rng(2)
    trees, rows = [random_tree(rnd, 15, 9) for _ in range(20)], rnd.random((500, 15))
    start = time.perf_counter()
    got = forest_shap.path_shapley(trees, rows)
    assert time.perf_counter() - start < 10
    assert np.abs(got.sum(axis=1) - forest_output(trees, rows)).max() < 1e-9


def test_scores_by_interval_equal_scores_by_row(spark, table, fitted):
    from tollgate.operators.forest import add_forest_score, forest_score

    filled = model.impute(table, MODEL_FEATURES).withColumn("_keep", F.lit(1))
    both = add_forest_score(filled, fitted.trees, MODEL_FEATURES, "mine").withColumn("theirs", forest_score(spark, fitted.trees, MODEL_FEATURES))
    assert both.columns == [*filled.columns, "mine", "theirs"] and both.count() == 3000
    assert both.select(F.max(F.abs(F.col("mine") - F.col("theirs")))).first()[0] < 1e-12


def test_no_small_node_is_split(table, fitted):
    """The library's own forest splits small nodes; ours does not, and answers like it elsewhere."""
    from tollgate.operators.forest import fold_small_nodes, rows_per_node

    known = model.training_rows(table, MODEL_FEATURES)
    assert all(r["small_splits"] == 0 and r["adds_up"] and r["root_rows"] == known.count() for r in model.node_report(table, fitted).collect())
    counts = rows_per_node(known, fitted.trees, MODEL_FEATURES)
    values = known.toPandas()
    tree = fitted.trees[0]
    reach = {0: np.ones(len(values), bool)}
    for node, left in enumerate(tree["left"]):
        assert reach[node].sum() == counts[0][node]
        if left >= 0:
            goes_left = values[MODEL_FEATURES[tree["feature"][node]]].to_numpy(float) <= tree["threshold"][node]
            reach[left], reach[tree["right"][node]] = reach[node] & goes_left, reach[node] & ~goes_left
    folded = fold_small_nodes(fitted.trees, counts, 10**9)
    assert all(t["left"] == [-1] and t["value"] == tree["value"][:1] for t, tree in zip(folded, fitted.trees))
    assert fold_small_nodes(fitted.trees, counts, 0) == fitted.trees


def test_importances_equal_the_library(table, tmp_path):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    from tollgate.operators.forest import importances_of, trees_of

    inputs = VectorAssembler(inputCols=MODEL_FEATURES, outputCol="inputs").transform(model.training_rows(table, MODEL_FEATURES))
    forest = RandomForestClassifier(featuresCol="inputs", labelCol="label", numTrees=7, seed=3).fit(inputs)
    got = importances_of(trees_of(table.sparkSession, forest), len(MODEL_FEATURES))
    assert got == pytest.approx(list(forest.featureImportances.toArray()), abs=1e-9)


def test_regression_is_at_its_minimum(table, fitted):
    slopes = {r["feature"]: r["slope"] for r in model.regression_gradient(table, fitted).collect()}
    assert set(slopes) == {"(intercept)", *MODEL_FEATURES} and max(map(abs, slopes.values())) < 1e-6
    moved = replace(fitted, intercept=fitted.intercept + 0.01)
    assert max(abs(r["slope"]) for r in model.regression_gradient(table, moved).collect()) > 1e-4


def test_texts(table, fitted):
    row = table.where("txn_id_clean = 't0'")
    shap = model_texts.explain_by_contributions(row, fitted).first()["explanations"]
    assert 1 <= len(shap) <= 5 and all("(SHAP: " in text for text in shap)
    coefficients = model_texts.explain_by_coefficients(row, fitted).first()["explanations"]
    assert coefficients[0].startswith("**Merchant Fraud Rate** (high impact): increases fraud risk - 0.0% historical")
    forest = forest_shap.explain_by_forest(row, fitted).first()["explanations"]
    assert any(text.startswith("Merchant fraud rate decreases risk by ") for text in forest)
    bars = model_texts.contribution_bars(row, fitted).orderBy("bar").collect()
    sizes = [abs(b["shap_value"]) for b in bars]
    assert sizes == sorted(sizes, reverse=True) and len(bars) == 5


def test_forest_over_many_rows_grows_on_blocks_of_equal_rows(spark, table, monkeypatch):
    """Beyond the bound the library sees few rows, yet all rows are in them, and the trees hold for the rows themselves."""
    from pyspark.ml.classification import RandomForestClassifier

    seen = []

    def counted(self, df, plain=RandomForestClassifier.fit):
        seen.append((df.count(), df.agg(F.sum("weight")).first()[0]))
        return plain(self, df)

    monkeypatch.setattr(RandomForestClassifier, "fit", counted)
    monkeypatch.setattr(model, "FOREST_ROWS", 300)
    many = table.unionAll(table).unionAll(table)
    fresh = model.fit(many, trees=20)
    labelled = many.where("is_fraud is not null").count()
    assert seen[0][0] < labelled / 2 and seen[0][1] == pytest.approx(labelled)
    report = model.node_report(many, fresh).collect()
    assert len(report) == 20 and all(r["root_rows"] == labelled and r["small_splits"] == 0 and r["adds_up"] for r in report)
    scored = model.model_scores(many, fresh).groupBy("is_fraud").agg(F.avg("rf_score").alias("s")).collect()
    by_label = {r["is_fraud"]: r["s"] for r in scored}
    assert by_label[True] > by_label[False] + 0.2


def test_blocks_of_equal_rows_hold_all_rows_and_split_like_them(spark):
    from tollgate.operators.forest import bin_edges, equal_rows, with_edges

    rows = spark.range(5000).select(
        (F.col("id") % 1009).cast("double").alias("a"), (F.col("id") % 2).cast("double").alias("b"),
        (F.col("id") % 3 == 0).cast("double").alias("label"), F.when(F.col("id") % 3 == 0, 1.5).otherwise(0.75).alias("weight"))
    edges = bin_edges(rows, ["a", "b"])
    assert all(e == sorted(set(e)) and len(e) <= 32 for e in edges) and edges[0][-1] == 1008.0 and edges[1] == [0.0, 1.0]
    blocks = equal_rows(rows, ["a", "b"], edges, 10).toPandas()
    assert blocks["weight"].sum() == pytest.approx(rows.agg(F.sum("weight")).first()[0])
    assert blocks["weight"].max() <= 15 and not blocks.duplicated(["a", "b", "label", "block"]).any()
    values = rows.toPandas()
    low, high = edges[0][4], edges[0][5]
    tree = {"left": [1, -1, -1], "right": [2, -1, -1], "feature": [0, -1, -1], "threshold": [(low + high) / 2, 0.0, 0.0],
            "weight": [1.0, 1.0, 1.0], "value": [0.5, 0.5, 0.5]}
    found = with_edges([tree], edges)[0]["threshold"][0]
    assert blocks[blocks["a"] <= (low + high) / 2]["weight"].sum() == pytest.approx(values[values["a"] <= found]["weight"].sum())
