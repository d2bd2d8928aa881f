"""Model operators as queries on the fixed model, and properties of fitted ones."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from tollgate.operators import evaluation, forest_shap, model, model_texts, sampling
from tollgate.plans.fixed_model import MODEL
from tollgate.plans.registry import ID, fitted, plain, query, risk
from tollgate.schemas import MODEL_FEATURES
from tollgate.sources.shared import shared_folder


@query
def j05_fixed_regression_score(spark, sf):
    return plain(model.model_scores(risk(spark, sf), MODEL).select(ID, "lr_score"))


@query
def j06_fixed_forest_score(spark, sf):
    return plain(model.model_scores(risk(spark, sf), MODEL).select(ID, "rf_score"))


@query
def j07_fixed_ensemble_score(spark, sf):
    return plain(model.score(risk(spark, sf), MODEL).select(ID, "risk_score", "risk_band"))


@query
def j08_saved_model(spark, sf):
    """A saved model answers, also for rows without labels."""
    path = f"{shared_folder(spark)}/model-{uuid4().hex}"
    model.save_model(MODEL, path)
    return plain(model.score_transactions(risk(spark, sf).drop("is_fraud"), path).select(ID, "risk_score", "risk_band"))


@query
def j08_train_and_save(spark, sf):
    """Labels and no saved model: one is trained, saved, and scores every row."""
    path = f"{shared_folder(spark)}/model-{uuid4().hex}"
    df = model.score_transactions(risk(spark, sf), path)
    saved = model.load_model(spark, path, MODEL_FEATURES)
    inside = F.col("risk_score").between(0, 1) & F.col("risk_band").isin("LOW", "MEDIUM", "HIGH")
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.count_if(inside).alias("scored_rows")).withColumn(
        "model_saved", F.lit(saved is not None and len(saved.trees) == model.RF_TREES))


@query
def j09_fixed_score_all_rows(spark, sf):
    return plain(evaluation.band_performance(model.score(risk(spark, sf), MODEL)))


@query
def j10_save_and_load(spark, sf):
    """A loaded model scores like the saved one; another feature set is refused."""
    path = f"{shared_folder(spark)}/model-{uuid4().hex}"
    model.save_model(MODEL, path)
    loaded = model.load_model(spark, path, list(reversed(MODEL_FEATURES)))
    refused = model.load_model(spark, path, MODEL_FEATURES[:3]) is None
    df = model.score(risk(spark, sf), loaded).withColumn("other_features_refused", F.lit(refused))
    return plain(df.select(ID, "risk_score", "other_features_refused"))


@query
def j11_retrain(spark, sf):
    """A usable saved model stays; a forced retraining replaces it."""
    path = f"{shared_folder(spark)}/model-{uuid4().hex}"
    df = risk(spark, sf)
    model.save_model(MODEL, path)
    kept = model.retrain(df, path)
    forced = model.retrain(df, path, force=True)
    replaced = model.load_model(spark, path, MODEL_FEATURES).coefficients != MODEL.coefficients
    return df.agg(F.count("is_fraud").alias("labelled_rows")).select(
        "labelled_rows", F.lit(kept).alias("trained_when_saved"), F.lit(forced).alias("trained_when_forced"), F.lit(replaced).alias("replaced"))


@query
def j12_fixed_regression_only(spark, sf):
    return plain(model.score_with_regression(risk(spark, sf), MODEL).select(ID, "risk_score", "risk_band"))


@query
def j05_fitted_minimum(spark, sf):
    """The fitted regression is where its penalised loss over all training rows has its minimum."""
    df = model.regression_gradient(risk(spark, sf), fitted(spark, sf))
    return plain(df.withColumn("at_minimum", F.abs("slope") < 1e-6).drop("slope"))


@query
def j06_fitted_nodes(spark, sf):
    """Every tree of the fitted forest, walked by all training rows: no split of a small node, sums that agree."""
    return plain(model.node_report(risk(spark, sf), fitted(spark, sf)))


def _with_rows(spark, sf, table):
    """Model facts beside the number of rows that the model scores."""
    return table.crossJoin(F.broadcast(risk(spark, sf).agg(F.count(F.lit(1)).alias("rows_to_score"))))


@query
def j15_fixed_coefficients(spark, sf):
    return plain(_with_rows(spark, sf, model.coefficient_table(spark, MODEL)))


@query
def j16_fixed_model_info(spark, sf):
    return plain(_with_rows(spark, sf, model.model_info(spark, MODEL)))


@query
def j17_fixed_forest_importances(spark, sf):
    return plain(_with_rows(spark, sf, model.forest_importances(spark, MODEL)))


@query
def k04_fixed_contributions(spark, sf):
    df = model_texts.add_contributions(risk(spark, sf), MODEL)
    return plain(df.select(ID, "base_value", *[f"shap_{f}" for f in MODEL_FEATURES]))


@query
def k05_fixed_contribution_texts(spark, sf):
    return plain(model_texts.explain_by_contributions(risk(spark, sf), MODEL).select(ID, "explanations"))


@query
def k06_fixed_coefficient_texts(spark, sf):
    return plain(model_texts.explain_by_coefficients(risk(spark, sf), MODEL).select(ID, "explanations"))


@query
def k07_fixed_forest_contributions(spark, sf):
    df = forest_shap.add_forest_contributions(risk(spark, sf), MODEL)
    return plain(df.select(ID, "forest_base", *[f"forest_{f}" for f in MODEL_FEATURES]))


@query
def k07_fixed_forest_texts(spark, sf):
    return plain(forest_shap.explain_by_forest(risk(spark, sf), MODEL).select(ID, "explanations"))


@query
def k08_fixed_contribution_bars(spark, sf):
    return plain(model_texts.contribution_bars(risk(spark, sf), MODEL))


@query
def k09_fitted_additivity(spark, sf):
    """Contributions of the fitted models add up to their scores, over all rows without gaps."""
    fit = fitted(spark, sf)
    full = risk(spark, sf).where(" and ".join(f"{f} is not null" for f in MODEL_FEATURES))
    df = model_texts.add_contributions(model.model_scores(full, fit), fit)
    df = forest_shap.add_forest_contributions(df, fit)
    odds = F.log(F.col("lr_score") / (1 - F.col("lr_score")))
    linear = F.abs(F.col("base_value") + sum(F.col(f"shap_{f}") for f in MODEL_FEATURES) - odds)
    forest = F.abs(F.col("forest_base") + sum(F.col(f"forest_{f}") for f in MODEL_FEATURES) - F.col("rf_score"))
    return df.agg(F.count(F.lit(1)).alias("row_count"), (F.max(linear) < 1e-8).alias("regression_adds_up"),
                  (F.max(forest) < 1e-9).alias("forest_adds_up"))


def _test_part(spark, sf):
    return sampling.train_test_split(risk(spark, sf)).where("split = 'test'").drop("split")


@query
def l12_test_report(spark, sf):
    """Split, score the test part, report: the evaluation chain on the fixed model."""
    return plain(evaluation.classification_report(model.score(_test_part(spark, sf), MODEL)))


@query
def l12_test_roc_auc(spark, sf):
    return plain(evaluation.roc_auc(model.score(_test_part(spark, sf), MODEL)))


@query
def l13_trained_evaluation(spark, sf):
    """The whole chain: fit on the training part, score and evaluate the test part."""
    split = sampling.train_test_split(risk(spark, sf))
    fit = model.fit(split.where("split = 'train'").drop("split"))
    test = model.score(split.where("split = 'test'").drop("split"), fit)
    auc = evaluation.roc_auc(test).select((F.col("roc_auc") >= 0).alias("auc_is_a_share"), (F.col("roc_auc") <= 1).alias("auc_at_most_one"))
    rows = test.agg(F.count(F.lit(1)).alias("test_rows"), F.count_if(F.col("risk_score").between(0, 1)).alias("scored_rows"))
    return rows.crossJoin(F.broadcast(auc))
