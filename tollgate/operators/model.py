"""Ensemble fraud score: logistic regression and random forest from Spark ML.

Only numbers whose count is fixed by the feature list reach the driver: means,
deviations, class counts, coefficients and trees. Training rows and scored rows stay on
the executors; scoring is one partitioned pass over all rows.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, replace
from uuid import uuid4

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.operators.forest import (
    Tree, add_forest_score, bin_edges, equal_rows, fold_small_nodes, importances_of, rows_per_node, trees_of, with_edges,
)
from tollgate.operators.ranking import exact_quantiles
from tollgate.operators.rules import score_by_rules, with_band
from tollgate.schemas import MODEL_FEATURES
from tollgate.sources.shared import path_exists, remove_folder, shared_folder, write_and_read

# Model settings.
MODEL_VERSION = "1.0"
ENSEMBLE_WEIGHTS = {"lr": 0.5, "rf": 0.5}
LR_ITERATIONS = 1000
LR_TOLERANCE = 1e-12
RF_TREES = 100
RF_DEPTH = 10
RF_MIN_SPLIT = 50
SEED = 42
# The forest depends on how its rows are dealt; a fixed number of parts makes it the same on every cluster.
FIT_PARTS = 64
# The library draws for every row and tree. Beyond so many rows, equal ones are drawn together, in blocks of equal size.
FOREST_ROWS = 1_000_000
PLACEHOLDER_SCORE = 0.5


@dataclass
class ScoringModel:
    """A fitted ensemble in plain numbers; ``trees`` is None for a regression-only model.

    Features are standardised over all training rows, so their background mean is 0.
    """

    features: list[str]
    means: list[float]
    deviations: list[float]
    coefficients: list[float]
    intercept: float
    trees: list[Tree] | None = None
    importances: list[float] | None = None


def available_features(df: DataFrame) -> list[str]:
    return [name for name in MODEL_FEATURES if name in df.columns]


def batch_medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the exact median of each column (0 where all are missing)."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("number")) for c in columns
    ])
    medians = exact_quantiles(df.select(F.inline(pairs)), "number", {"median": 0.5}, ["feature"])
    return medians.agg(*[
        F.coalesce(F.max(F.when(F.col("feature") == c, F.col("median"))), F.lit(0.0)).alias(c) for c in columns
    ])


def impute(df: DataFrame, features: list[str]) -> DataFrame:
    """Features as numbers without gaps: medians of this batch for numbers, 0 for flags."""
    kinds = {field.name: field.dataType for field in df.schema.fields}
    numeric = [c for c in features if isinstance(kinds[c], T.NumericType)]
    filled: dict[str, Column] = {}
    if numeric:
        medians = batch_medians(df, numeric).select(F.struct(*numeric)).scalar()
        filled |= {c: F.coalesce(F.col(c).cast("double"), medians.getField(c)) for c in numeric}
    for c in features:
        if isinstance(kinds[c], T.BooleanType):
            filled[c] = F.coalesce(F.col(c), F.lit(False)).cast("double")
        elif c not in numeric:
            filled[c] = F.coalesce(F.col(c).try_cast("double"), F.lit(0.0))
    return df.withColumns(filled)


def moments(df: DataFrame, features: list[str]) -> DataFrame:
    """Mean and population deviation per feature, as one row."""
    return df.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in features],
        *[F.stddev_pop(c).alias(f"{c}_std") for c in features],
    )


def standardise(df: DataFrame, features: list[str], means: list[float], deviations: list[float]) -> DataFrame:
    """Add ``z_<feature>``; a constant feature is only centred."""
    return df.withColumns({
        f"z_{c}": (F.col(c) - F.lit(mean)) / F.lit(deviation if deviation else 1.0)
        for c, mean, deviation in zip(features, means, deviations)
    })


def training_rows(df: DataFrame, features: list[str]) -> DataFrame:
    """Labelled rows with imputed features and the label as a number."""
    return impute(df, features).where(F.col("is_fraud").isNotNull()).select(
        "txn_id_clean", *features, F.col("is_fraud").cast("double").alias("label"))


def class_weight(rows: int, fraud: float) -> Column:
    """Both classes get half of the total weight, which is the number of rows."""
    return F.when(F.col("label") == 1, rows / (2 * fraud)).otherwise(rows / (2 * (rows - fraud)))


def fit(df: DataFrame, with_forest: bool = True, seed: int = SEED, trees: int = RF_TREES) -> ScoringModel:
    """Train on the labelled rows of ``df``; both classes get equal total weight."""
    spark = df.sparkSession
    features = available_features(df)
    numbers = training_rows(df, features)
    # Training passes over these rows many times: a written table survives a lost executor.
    folder = f"{shared_folder(spark)}/training-{uuid4().hex}"
    numbers = write_and_read(numbers.repartition(FIT_PARTS, *numbers.columns), folder)
    facts = numbers.agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").alias("fraud"),
        *[F.avg(c).alias(f"{c}_mean") for c in features], *[F.stddev_pop(c).alias(f"{c}_std") for c in features],
    ).first()
    rows, fraud = facts["rows"], facts["fraud"] or 0
    if not 0 < fraud < rows:
        raise ValueError(f"training needs labelled rows of both classes; found {fraud:.0f} fraud rows of {rows}")
    means = [facts[f"{c}_mean"] for c in features]
    deviations = [facts[f"{c}_std"] for c in features]
    z_names = [f"z_{c}" for c in features]
    training = standardise(numbers, features, means, deviations).withColumn("weight", class_weight(rows, fraud))

    regression = LogisticRegression(
        featuresCol="scaled", labelCol="label", weightCol="weight", maxIter=LR_ITERATIONS,
        regParam=1.0 / rows, standardization=False, tol=LR_TOLERANCE,
    ).fit(VectorAssembler(inputCols=z_names, outputCol="scaled").transform(training))
    found = ScoringModel(features, means, deviations, [float(c) for c in regression.coefficients], float(regression.intercept))
    if with_forest:
        forest = RandomForestClassifier(
            featuresCol="inputs", labelCol="label", weightCol="weight", seed=seed, maxDepth=RF_DEPTH,
            numTrees=trees, featureSubsetStrategy="sqrt",
        )
        grown = grow(training, features, forest, folder, rows)
        # The library splits nodes of any size; splits of small ones are undone.
        found.trees = fold_small_nodes(grown, rows_per_node(training, grown, features), RF_MIN_SPLIT)
        found.importances = importances_of(found.trees, len(features))
    remove_folder(spark, folder)
    return found


def grow(training: DataFrame, features: list[str], forest: RandomForestClassifier, folder: str, rows: int) -> list[Tree]:
    """The trees that ``forest`` grows on all rows of ``training``.

    A tree sees a row's bins and class alone. Where there are more than FOREST_ROWS rows, those that agree in all of them are added
    up in blocks, so the forest's work has a bound; every row counts with its weight, and a bootstrap sample draws blocks.
    """
    spark = training.sparkSession
    assembler = VectorAssembler(inputCols=features, outputCol="inputs")
    if rows <= FOREST_ROWS:
        return trees_of(spark, forest.fit(assembler.transform(training)))
    edges = bin_edges(training, features)
    blocks = equal_rows(training, features, edges, -(-rows // FOREST_ROWS))
    keys = [*features, "label", "block"]
    dealt = write_and_read(blocks.repartition(FIT_PARTS, *keys).sortWithinPartitions(*keys), f"{folder}-blocks")
    grown = trees_of(spark, forest.fit(assembler.transform(dealt)))
    remove_folder(spark, f"{folder}-blocks")
    return with_edges(grown, edges)


def _with_numbers(df: DataFrame, features: list[str]) -> DataFrame:
    """The frame plus ``n_<feature>``: imputed copies that leave the originals alone."""
    copies = df.withColumns({f"n_{c}": F.col(c) for c in features})
    return impute(copies, [f"n_{c}" for c in features])


def model_scores(df: DataFrame, model: ScoringModel) -> DataFrame:
    """Add ``lr_score`` and, with a forest, ``rf_score``.

    The regression is plain column arithmetic, which stays in generated code; the forest
    answers once per combination of threshold intervals.
    """
    inputs = [f"n_{c}" for c in model.features]
    scored = standardise(_with_numbers(df, model.features), inputs, model.means, model.deviations)
    margin = F.lit(model.intercept)
    for name, coefficient in zip(inputs, model.coefficients):
        margin = margin + F.col(f"z_{name}") * F.lit(coefficient)
    scored = scored.withColumn("lr_score", 1 / (1 + F.exp(-margin)))
    if model.trees is None:
        return scored.select(*df.columns, "lr_score")
    return add_forest_score(scored, model.trees, inputs, "rf_score").select(*df.columns, "lr_score", "rf_score")


def regression_gradient(df: DataFrame, model: ScoringModel) -> DataFrame:
    """Is the regression at the minimum of its penalised loss over the labelled rows of ``df``?

    One row per feature and one for the intercept: training rows, mean, deviation, and the slope of the loss there. The loss
    is strictly convex, so slopes of zero single out one model.
    """
    numbers = training_rows(df, model.features)
    facts = numbers.agg(F.count(F.lit(1)).alias("rows"), F.sum("label").alias("fraud")).first()
    rows = facts["rows"]
    z = standardise(numbers, model.features, model.means, model.deviations)
    margin = sum((F.col(f"z_{f}") * F.lit(c) for f, c in zip(model.features, model.coefficients)), F.lit(model.intercept))
    error = class_weight(rows, facts["fraud"]) * (1 / (1 + F.exp(-margin)) - F.col("label"))
    slopes = z.withColumn("_error", error).agg(
        F.sum("_error").alias("g"), *[F.sum(F.col("_error") * F.col(f"z_{f}")).alias(f"g_{f}") for f in model.features],
        *[F.avg(f).alias(f"m_{f}") for f in model.features], *[F.stddev_pop(f).alias(f"s_{f}") for f in model.features])
    none = F.lit(None).cast("double")
    lines = [F.struct(F.lit("(intercept)").alias("feature"), none.alias("mean"), none.alias("deviation"), (F.col("g") / rows).alias("slope"))]
    for f, c in zip(model.features, model.coefficients):
        lines.append(F.struct(F.lit(f).alias("feature"), F.col(f"m_{f}").alias("mean"), F.col(f"s_{f}").alias("deviation"),
                              ((F.col(f"g_{f}") + F.lit(c)) / rows).alias("slope")))
    return slopes.select(F.lit(rows).alias("training_rows"), F.inline(F.array(*lines)))


def node_report(df: DataFrame, model: ScoringModel) -> DataFrame:
    """Per tree, over the labelled rows of ``df``: rows at the root, inner nodes with too few rows, and whether
    every inner node's rows and weight are those of its two children.
    """
    counts = rows_per_node(training_rows(df, model.features), model.trees, model.features)
    lines = []
    for number, (tree, rows) in enumerate(zip(model.trees, counts)):
        inner = [i for i, left in enumerate(tree["left"]) if left >= 0]

        def adds_up(values: list) -> bool:
            return all(abs(values[i] - values[tree["left"][i]] - values[tree["right"][i]]) <= 1e-6 * (1 + abs(values[i])) for i in inner)

        shares = [w * v for w, v in zip(tree["weight"], tree["value"])]
        lines.append((number, rows[0], sum(rows[i] < RF_MIN_SPLIT for i in inner), adds_up(rows) and adds_up(tree["weight"]) and adds_up(shares)))
    return df.sparkSession.createDataFrame(lines, "tree int, root_rows bigint, small_splits bigint, adds_up boolean")


def score(df: DataFrame, model: ScoringModel) -> DataFrame:
    """Add ``risk_score`` (mean of both models, or the regression alone) and ``risk_band``."""
    scored = model_scores(df, model)
    combined = F.col("lr_score")
    if model.trees is not None:
        combined = F.col("lr_score") * ENSEMBLE_WEIGHTS["lr"] + F.col("rf_score") * ENSEMBLE_WEIGHTS["rf"]
    return with_band(scored.withColumn("risk_score", combined)).select(*df.columns, "risk_score", "risk_band")


def placeholder_score(df: DataFrame) -> DataFrame:
    return with_band(df.withColumn("risk_score", F.lit(PLACEHOLDER_SCORE)))


def score_with_regression(df: DataFrame, model: ScoringModel | None) -> DataFrame:
    """Logistic-regression score; 0.5 without a model or without features."""
    if model is None or not available_features(df):
        return placeholder_score(df)
    return score(df, replace(model, trees=None, importances=None))


def has_fraud_label(df: DataFrame) -> bool:
    if "is_fraud" not in df.columns:
        return False
    return not df.where(F.col("is_fraud")).isEmpty() and not df.where(~F.col("is_fraud")).isEmpty()


def score_transactions(df: DataFrame, model_path: str | None = None) -> DataFrame:
    """Score with the saved model, else train (and save) one, else fall back to the rules.

    Training needs labelled rows of both classes.
    """
    features = available_features(df)
    if not features:
        return score_by_rules(df)
    model = load_model(df.sparkSession, model_path, features) if model_path else None
    if model is None and has_fraud_label(df):
        model = fit(df)
        if model_path:
            save_model(model, model_path)
    return score(df, model) if model else score_by_rules(df)


def save_model(model: ScoringModel, path: str) -> None:
    """One text row: the numbers of a model are few."""
    facts = asdict(model) | {"version": MODEL_VERSION, "weights": ENSEMBLE_WEIGHTS}
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/facts")


def load_model(spark: SparkSession, path: str, expected: list[str]) -> ScoringModel | None:
    """The saved model, or None when there is none or its feature set differs."""
    if not path_exists(spark, f"{path}/facts"):
        return None
    facts = json.loads(spark.read.text(f"{path}/facts").first()["value"])
    if set(facts["features"]) != set(expected):
        return None
    return ScoringModel(**{k: v for k, v in facts.items() if k not in ("version", "weights")})


def retrain(df: DataFrame, path: str, force: bool = False) -> bool:
    """Train and save; without ``force`` only if no usable model is saved. True if trained."""
    if not force and load_model(df.sparkSession, path, available_features(df)) is not None:
        return False
    if not has_fraud_label(df):
        return False
    save_model(fit(df), path)
    return True


def coefficient_table(spark: SparkSession, model: ScoringModel) -> DataFrame:
    rows = [(f, c, abs(c)) for f, c in zip(model.features, model.coefficients)]
    table = spark.createDataFrame(rows, "feature string, coefficient double, abs_coefficient double")
    return table.orderBy(F.desc("abs_coefficient"), "feature")


def model_info(spark: SparkSession, model: ScoringModel | None) -> DataFrame:
    """Status, features, coefficients by feature, intercept."""
    layout = "status string, features array<string>, coefficients map<string,double>, intercept double"
    if model is None:
        return spark.createDataFrame([("No model trained", None, None, None)], layout)
    by_feature = dict(zip(model.features, model.coefficients))
    return spark.createDataFrame([("Model trained", model.features, by_feature, model.intercept)], layout)


def forest_importances(spark: SparkSession, model: ScoringModel) -> DataFrame:
    ranked = sorted(
        zip(model.features, model.importances), key=lambda pair: (-pair[1], pair[0])
    )
    rows = [(position + 1, f, float(v)) for position, (f, v) in enumerate(ranked)]
    return spark.createDataFrame(rows, "importance_rank int, feature string, importance double")
