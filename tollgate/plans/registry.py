"""Every operator as a named query over the test tables.

Operators up to the enrichment read the raw projection; later ones read the stored
stage table they would read in production. Results use plain types (text for dates,
DOUBLE rounded to six places for fractions) so that another engine can be compared.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollgate.functions import formatting
from tollgate.functions.cleaning import collate_keys
from tollgate.operators import (
    analytics,
    card_activity,
    concentration,
    display,
    enrichment,
    evaluation,
    extract,
    filters,
    forest_shap,
    model,
    model_texts,
    overview,
    profiling,
    quality,
    risk_history,
    rule_texts,
    rules,
    sampling,
    staging,
)
from tollgate.plans import fixtures, stages
from tollgate.plans.stages import stage_table
from tollgate.schemas import CARD_ACTIVITY, EXTRACT_COLUMNS, MODEL_FEATURES, RISK_HISTORY
from tollgate.sources import extract_csv, raw_csv, tables
from tollgate.sources.shared import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

ID = "txn_id_clean"
EXTRACT_TARGET = 8_000
SIGNAL_SAMPLE = 1_500
CARD_SHARE = 0.25
VIEW = {"channel": "WEB", "date_start": "2024-01-05", "date_end": "2024-01-25"}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def plain(df: DataFrame) -> DataFrame:
    """Plain types for comparison: text, BIGINT, BOOLEAN, DOUBLE at six decimals.

    The decimals are cut by arithmetic both engines do alike; their round functions
    settle decimal ties differently.
    """

    def convert(field: T.StructField):
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DecimalType, T.DoubleType)):
            column = F.floor(column.cast("double") * 1e6 + 0.5) / 1e6
        elif isinstance(kind, T.IntegerType):
            column = column.cast("bigint")
        elif isinstance(kind, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            column = column.cast("string")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column, " | ")
        elif isinstance(kind, T.MapType):
            column = F.to_json(column)
        return column.alias(field.name)

    return df.select([convert(field) for field in df.schema.fields])


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    return stage_table(spark, sf, "enriched")


def features(spark: SparkSession, sf: str) -> DataFrame:
    return stage_table(spark, sf, "features")


def risk(spark: SparkSession, sf: str) -> DataFrame:
    return stage_table(spark, sf, "risk")


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    return stage_table(spark, sf, "ledger")


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return rules.score_by_rules(risk(spark, sf))


_models: dict[tuple[str, str], model.ScoringModel] = {}


def fitted(spark: SparkSession, sf: str) -> model.ScoringModel:
    """The ensemble for a source folder, trained once per application."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _models:
        _models[key] = model.fit(risk(spark, sf))
    return _models[key]


# --- sources and sinks ---------------------------------------------------------------

def _as_csv(spark: SparkSession, table: str, df: DataFrame) -> str:
    path = f"{shared_folder(spark)}/csv-{uuid4().hex}/{table}"
    raw_csv.write_raw(df, path)
    return path


@query
def a01_csv_scan(spark, sf):
    path = _as_csv(spark, "raw_transactions", fixtures.raw_transactions(spark, sf))
    return raw_csv.read_raw(spark, path, "raw_transactions")


@query
def a06_load_reconciliation(spark, sf):
    stored, loaded = {}, {}
    for name, df in fixtures.raw_tables(spark, sf).items():
        path = _as_csv(spark, name, df)
        rows = raw_csv.read_raw(spark, path, name)
        loaded[name] = tables.store_counted(rows, lambda out: out.write.parquet(f"{path}-stored"))
        stored[name] = spark.read.parquet(f"{path}-stored")
    return plain(raw_csv.load_report(stored, loaded))


@query
def a10_extract_csv_round_trip(spark, sf):
    path = f"{shared_folder(spark)}/extract-{uuid4().hex}"
    extract_csv.write_extract(extract.build_extract(risk(spark, sf), EXTRACT_TARGET), path)
    return plain(extract_csv.read_extract(spark, path))


# --- staging -------------------------------------------------------------------------

def _staged(spark, sf, *columns):
    return plain(stages.staged(spark, sf).select(*columns))


@query
def b01_raw_preserved(spark, sf):
    return staging.keep_raw(fixtures.raw_transactions(spark, sf))


@query
def b02_clean_text(spark, sf):
    df = staging.add_clean(staging.keep_raw(fixtures.raw_transactions(spark, sf)))
    return df.select([c for c in df.columns if c.endswith("_clean")])


@query
def b03_timestamp(spark, sf):
    return _staged(spark, sf, ID, "txn_ts_raw", "txn_ts")


@query
def b04_amount(spark, sf):
    return _staged(spark, sf, ID, "amount_raw", "amount")


@query
def b05_fraud_flag(spark, sf):
    return _staged(spark, sf, ID, "is_fraud_raw", "is_fraud")


@query
def b06_auth_result(spark, sf):
    return _staged(spark, sf, ID, "auth_result_raw", "auth_result_std")


@query
def b07_channel(spark, sf):
    return _staged(spark, sf, ID, "channel_raw", "channel_std")


@query
def b08_country(spark, sf):
    return _staged(spark, sf, ID, "country_raw", "country_std")


@query
def b09_date_hour(spark, sf):
    return _staged(spark, sf, ID, "txn_date", "txn_hour")


@query
def b10_flags(spark, sf):
    return _staged(spark, sf, ID, "is_declined", "is_zero_amount", "is_negative_amt", "is_high_amount")


@query
def b11_staged_table(spark, sf):
    return plain(stages.staged(spark, sf))


# --- enrichment ----------------------------------------------------------------------

@query
def c01_merchant(spark, sf):
    df = enrichment.add_merchant(stages.staged(spark, sf), fixtures.merchants(spark, sf))
    return df.select(ID, "merchant_category", "merchant_country", "merchant_risk_tier")


def mixed_keys(df: DataFrame) -> DataFrame:
    """Merchant keys written in several ways: upper case, with an accent, plain."""
    last = F.right(ID, F.lit(1))
    key = F.col("merchant_id_clean")
    return df.withColumn("merchant_id_clean", F.when(last.isin(*"0123"), F.upper(key)).when(
        last.isin(*"456"), F.concat(F.lit("ḿ"), F.substring(key, 2, 100))).otherwise(key))


@query
def c01_collated_merchant(spark, sf):
    """Keys that differ in case and accents find their merchant."""
    df = collate_keys(mixed_keys(stages.staged(spark, sf)), ["merchant_id_clean"])
    merchants = collate_keys(fixtures.merchants(spark, sf), ["merchant_id"])
    return enrichment.add_merchant(df, merchants).select(ID, "merchant_category", "merchant_country", "merchant_risk_tier")


@query
def c02_device(spark, sf):
    df = enrichment.add_device(stages.staged(spark, sf), fixtures.devices(spark, sf))
    return df.select(ID, "device_type", "os")


@query
def c03_card(spark, sf):
    df = enrichment.add_card(stages.staged(spark, sf), fixtures.cards(spark, sf))
    return df.select(ID, "card_network", "card_type")


def _enriched(spark, sf, *columns):
    return plain(stages.enriched(spark, sf).select(*columns))


@query
def c04_emulator(spark, sf):
    return _enriched(spark, sf, ID, "is_emulator")


@query
def c05_high_risk_merchant(spark, sf):
    return _enriched(spark, sf, ID, "is_high_risk_merchant")


@query
def c06_foreign_transaction(spark, sf):
    return _enriched(spark, sf, ID, "is_foreign_transaction")


@query
def c06_foreign_by_issuer(spark, sf):
    """With an issuing country on the card: debit cards from IN, credit cards from US."""
    kind = F.trim("card_type")
    issued = F.when(kind == "DEBIT", "IN").when(kind == "CREDIT", "US")
    cards = fixtures.cards(spark, sf).withColumn("issued_in", issued)
    df = enrichment.add_card(stages.staged(spark, sf), cards, "issued_in")
    df = df.withColumns({"merchant_risk_tier": F.lit(None).cast("string"), "is_emulator": F.lit(None).cast("int")})
    return enrichment.add_flags(df).select(ID, "issuing_country", "is_foreign_transaction")


@query
def c07_emulator_device(spark, sf):
    return _enriched(spark, sf, ID, "is_emulator_device")


@query
def c08_enriched_table(spark, sf):
    return plain(stages.enriched(spark, sf))


# --- card activity -------------------------------------------------------------------

def _activity(spark, sf, *columns):
    return plain(card_activity.add_card_activity(enriched(spark, sf)).select(ID, *columns))


@query
def d01_txns_last_1h(spark, sf):
    return _activity(spark, sf, "txns_last_1h")


@query
def d02_txns_last_24h(spark, sf):
    return _activity(spark, sf, "txns_last_24h")


@query
def d03_amt_last_24h(spark, sf):
    return _activity(spark, sf, "amt_last_24h")


@query
def d04_declined_last_24h(spark, sf):
    return _activity(spark, sf, "declined_txns_last_24h")


@query
def d05_amount_vs_card_avg(spark, sf):
    return _activity(spark, sf, "amount_vs_card_avg")


@query
def d06_first_sightings(spark, sf):
    return plain(card_activity.first_sightings(enriched(spark, sf)))


@query
def d07_new_merchants_24h(spark, sf):
    timeline = card_activity.card_timeline(enriched(spark, sf))
    seen = card_activity.first_sightings(enriched(spark, sf)).withColumnsRenamed({"first_seen_ts": "txn_ts"})
    return plain(seen.join(timeline, ["card_id_clean", "txn_ts"]).select(
        "card_id_clean", "merchant_id_clean", "txn_ts", "distinct_merchants_last_24h"
    ))


@query
def d08_distinct_merchants_last_24h(spark, sf):
    return _activity(spark, sf, "distinct_merchants_last_24h")


@query
def d09_missing_time_mask(spark, sf):
    df = card_activity.add_card_activity(enriched(spark, sf))
    return plain(df.where(F.col("txn_ts").isNull()).select(ID, *CARD_ACTIVITY))


@query
def d10_activity_on_sample(spark, sf):
    df = card_activity.add_card_activity_to_sample(enriched(spark, sf), CARD_SHARE)
    return plain(df.select(ID, *CARD_ACTIVITY))


@query
def d_card_features_table(spark, sf):
    return plain(card_activity.add_card_activity(enriched(spark, sf)).select(ID, "txn_ts", "amount", *CARD_ACTIVITY))


# --- risk history --------------------------------------------------------------------

@query
def e01_card_daily(spark, sf):
    return plain(risk_history.daily_rates(features(spark, sf), "card_id_clean"))


@query
def e02_card_rolling(spark, sf):
    return plain(risk_history.card_history(features(spark, sf)))


@query
def e02_card_rolling_ledger(spark, sf):
    return plain(risk_history.card_history(ledger(spark, sf)))


@query
def e03_merchant_daily(spark, sf):
    return plain(risk_history.daily_rates(features(spark, sf), "merchant_id_clean"))


@query
def e04_merchant_rolling(spark, sf):
    return plain(risk_history.merchant_history(features(spark, sf)))


@query
def e04_merchant_rolling_ledger(spark, sf):
    return plain(risk_history.merchant_history(ledger(spark, sf)))


@query
def e05_card_history_joined(spark, sf):
    df = features(spark, sf)
    out = risk_history.join_history(df, risk_history.card_history(df), "card_id_clean")
    return plain(out.select(ID, *RISK_HISTORY[:3]))


@query
def e06_merchant_history_joined(spark, sf):
    df = features(spark, sf)
    out = risk_history.join_history(df, risk_history.merchant_history(df), "merchant_id_clean")
    return plain(out.select(ID, *RISK_HISTORY[3:]))


@query
def e06_history_joined_ledger(spark, sf):
    df = risk_history.add_risk_history(ledger(spark, sf))
    return plain(df.select(ID, *RISK_HISTORY))


@query
def e07_recent_slice(spark, sf):
    return plain(risk_history.recent_slice(features(spark, sf)).select(ID, "txn_ts"))


@query
def e07_recent_slice_ledger(spark, sf):
    return plain(risk_history.recent_slice(ledger(spark, sf)).select(ID, "txn_ts"))


@query
def e08_history_on_recent_slice(spark, sf):
    return plain(risk_history.add_risk_history_to_recent(features(spark, sf)).select(ID, *RISK_HISTORY))


@query
def e08_history_on_recent_slice_ledger(spark, sf):
    return plain(risk_history.add_risk_history_to_recent(ledger(spark, sf)).select(ID, *RISK_HISTORY))


@query
def e_all_features_fused(spark, sf):
    df = stages.add_all_features(enriched(spark, sf))
    return plain(df.select(ID, *CARD_ACTIVITY, *RISK_HISTORY))


# --- BI extract ----------------------------------------------------------------------

@query
def f01_extract_projection(spark, sf):
    return plain(extract.extract_projection(risk(spark, sf)))


@query
def f02_class_counts(spark, sf):
    return sampling.class_counts(risk(spark, sf))


@query
def f03_sample_budget(spark, sf):
    return extract.extract_plan(risk(spark, sf), EXTRACT_TARGET)


@query
def f04_sampled_negatives(spark, sf):
    df = extract.build_extract(risk(spark, sf), EXTRACT_TARGET)
    return df.where(~F.col("is_fraud")).select(ID)


@query
def f05_extract(spark, sf):
    return plain(extract.build_extract(risk(spark, sf), EXTRACT_TARGET))


@query
def f06_shuffled_extract(spark, sf):
    return plain(extract.shuffle_rows(extract.build_extract(risk(spark, sf), EXTRACT_TARGET)))


@query
def f07_extract_summary(spark, sf):
    return plain(extract.extract_summary(extract.build_extract(risk(spark, sf), EXTRACT_TARGET)))


@query
def f07_extract_preview(spark, sf):
    return plain(extract.preview(extract.build_extract(risk(spark, sf), EXTRACT_TARGET)))


# --- filters and display -------------------------------------------------------------

@query
def g01_filters(spark, sf):
    df = filters.apply_filters(
        risk(spark, sf), merchant_risk_tier="HIGH", country="IN", fraud="Non-Fraud Only", **VIEW
    )
    return plain(df.select(EXTRACT_COLUMNS))


@query
def g02_filter_options(spark, sf):
    return filters.filter_options(risk(spark, sf))


@query
def g03_date_bounds(spark, sf):
    return plain(filters.date_bounds(risk(spark, sf)))


@query
def g04_overview_order(spark, sf):
    return plain(display.sort_overview(scored(spark, sf)).select(ID, "risk_score", "risk_band"))


@query
def g05_display_table(spark, sf):
    return plain(display.display_table(scored(spark, sf)))


@query
def g06_currency(spark, sf):
    return risk(spark, sf).select(ID, formatting.currency(F.col("amount")).alias("amount_text"))


@query
def g07_score_text(spark, sf):
    return scored(spark, sf).select(ID, formatting.score_text(F.col("risk_score") * 100).alias("score_text"))


@query
def g08_page(spark, sf):
    return plain(display.page(scored(spark, sf), 3, 250).select(ID, "risk_score"))


@query
def g08_page_count(spark, sf):
    return display.page_count(risk(spark, sf))


@query
def g09_find_transaction(spark, sf):
    return plain(display.find_transaction(scored(spark, sf), "tx_123").select(ID, "amount", "risk_score"))


@query
def g09_transaction_ids(spark, sf):
    return display.transaction_ids(risk(spark, sf))


@query
def g10_option_label(spark, sf):
    return display.option_label(scored(spark, sf)).select(ID, "option_label")


# --- grouped analytics and key figures ------------------------------------------------

@query
def h01_fraud_trends(spark, sf):
    return plain(analytics.fraud_trends(risk(spark, sf)))


@query
def h02_by_country(spark, sf):
    return plain(analytics.geographic_analysis(risk(spark, sf)))


@query
def h03_top_merchants(spark, sf):
    return plain(analytics.top_risky_merchants(risk(spark, sf)))


@query
def h03_collated_merchants(spark, sf):
    """Spellings of one merchant are one group; shown in lower case without accents."""
    found = analytics.top_risky_merchants(collate_keys(mixed_keys(risk(spark, sf)), ["merchant_id_clean"]))
    shown = F.translate(F.lower(F.collate("merchant_id", "UTF8_BINARY")), "ḿ", "m")
    return plain(found.withColumn("merchant_id", shown))


@query
def h04_top_cards(spark, sf):
    return plain(analytics.top_risky_cards(scored(spark, sf)))


@query
def h05_top_transactions(spark, sf):
    return plain(analytics.top_risky_cards(scored(spark, sf).drop("card_id_clean")))


@query
def h06_by_channel(spark, sf):
    return plain(analytics.channel_analysis(risk(spark, sf)))


@query
def h07_by_hour(spark, sf):
    return plain(analytics.hourly_patterns(risk(spark, sf)))


def _view(df):
    return filters.filter_condition(df, **VIEW)


@query
def i01_dataset_overview(spark, sf):
    df = risk(spark, sf)
    return plain(overview.dataset_overview(df, _view(df)))


@query
def i02_filtered_statistics(spark, sf):
    df = scored(spark, sf)
    return plain(overview.filtered_statistics(df, _view(df)))


@query
def i03_value_breakdown(spark, sf):
    return plain(overview.value_breakdown(risk(spark, sf)))


@query
def i04_band_distribution(spark, sf):
    return plain(overview.band_distribution(scored(spark, sf)))


@query
def i05_unscored_rows(spark, sf):
    df = scored(spark, sf)
    view = F.when(_view(df), F.col("risk_score")).otherwise(overview.PLACEHOLDER_SCORE)
    return overview.unscored_rows(df.withColumn("risk_score", view))


@query
def i06_risk_parameters(spark, sf):
    return display.risk_parameters(risk(spark, sf))


# --- scoring -------------------------------------------------------------------------

@query
def j01_rule_score(spark, sf):
    df = risk(spark, sf)
    return plain(df.select(ID, rules.rule_score(df).alias("rule_score")))


@query
def j02_risk_band(spark, sf):
    return plain(scored(spark, sf).select(ID, "risk_score", "risk_band"))


@query
def j03_imputation(spark, sf):
    return plain(model.impute(risk(spark, sf), MODEL_FEATURES).select(ID, *MODEL_FEATURES))


@query
def j04_feature_moments(spark, sf):
    return plain(model.moments(model.impute(risk(spark, sf), MODEL_FEATURES), MODEL_FEATURES))


@query
def j05_regression_score(spark, sf):
    return plain(model.model_scores(risk(spark, sf), fitted(spark, sf)).select(ID, "lr_score"))


@query
def j06_forest_score(spark, sf):
    return plain(model.model_scores(risk(spark, sf), fitted(spark, sf)).select(ID, "rf_score"))


@query
def j07_ensemble_score(spark, sf):
    return plain(model.score(risk(spark, sf), fitted(spark, sf)).select(ID, "risk_score", "risk_band"))


@query
def j08_score_dispatch(spark, sf):
    """No label to train on and no saved model: the rules answer."""
    df = model.score_transactions(risk(spark, sf).drop("is_fraud"))
    return plain(df.select(ID, "risk_score", "risk_band"))


@query
def j09_score_all_rows(spark, sf):
    return plain(evaluation.band_performance(model.score(risk(spark, sf), fitted(spark, sf))))


@query
def j12_regression_only(spark, sf):
    df = model.score_with_regression(risk(spark, sf), fitted(spark, sf))
    return plain(df.select(ID, "risk_score", "risk_band"))


@query
def j12_without_model(spark, sf):
    return plain(model.score_with_regression(risk(spark, sf), None).select(ID, "risk_score", "risk_band"))


@query
def j13_training_sample(spark, sf):
    df = sampling.training_sample(risk(spark, sf), max_rows=4_000, min_fraud=300)
    return plain(df.select(ID, "is_fraud"))


@query
def j15_coefficients(spark, sf):
    return plain(model.coefficient_table(spark, fitted(spark, sf)))


@query
def j16_model_info(spark, sf):
    return plain(model.model_info(spark, fitted(spark, sf)))


@query
def j17_forest_importances(spark, sf):
    return plain(model.forest_importances(spark, fitted(spark, sf)))


@query
def j18_scenario_prior(spark, sf):
    return plain(rules.scenario_prior(enriched(spark, sf)).select(ID, "fraud_prior"))


# --- explanations --------------------------------------------------------------------

@query
def k01_rule_explanation(spark, sf):
    return plain(rule_texts.explain_by_rules(risk(spark, sf)).select(ID, "explanations"))


@query
def k02_rule_explanation_variant(spark, sf):
    df = rule_texts.explain_by_rules(risk(spark, sf), rule_texts.ORDER_WITHOUT_AMOUNT)
    return plain(df.select(ID, "explanations"))


@query
def k03_risk_assessment(spark, sf):
    return rule_texts.assess_risk(scored(spark, sf)).select(ID, "assessment")


@query
def k04_regression_contributions(spark, sf):
    df = model_texts.add_contributions(risk(spark, sf), fitted(spark, sf))
    return plain(df.select(ID, "base_value", *[f"shap_{f}" for f in MODEL_FEATURES]))


@query
def k05_contribution_texts(spark, sf):
    df = model_texts.explain_by_contributions(risk(spark, sf), fitted(spark, sf))
    return plain(df.select(ID, "explanations"))


@query
def k06_coefficient_texts(spark, sf):
    df = model_texts.explain_by_coefficients(risk(spark, sf), fitted(spark, sf))
    return plain(df.select(ID, "explanations"))


@query
def k07_forest_texts(spark, sf):
    return plain(forest_shap.explain_by_forest(risk(spark, sf), fitted(spark, sf)).select(ID, "explanations"))


@query
def k08_contribution_bars(spark, sf):
    return plain(model_texts.contribution_bars(risk(spark, sf), fitted(spark, sf)))


# --- evaluation ----------------------------------------------------------------------

@query
def l01_train_test_split(spark, sf):
    return sampling.train_test_split(risk(spark, sf)).select(ID, "split")


@query
def l02_classification_report(spark, sf):
    return plain(evaluation.classification_report(scored(spark, sf)))


@query
def l03_roc_auc(spark, sf):
    return plain(evaluation.roc_auc(scored(spark, sf)))


@query
def l04_confusion_matrix(spark, sf):
    return evaluation.confusion_matrix(scored(spark, sf))


@query
def l05_roc_curve(spark, sf):
    points = evaluation.roc_curve(scored(spark, sf))
    finite = F.when(F.col("threshold") < float("inf"), F.col("threshold"))
    return plain(points.withColumn("threshold", finite))


@query
def l06_precision_recall_curve(spark, sf):
    return plain(evaluation.precision_recall_curve(scored(spark, sf)))


@query
def l06_best_f1(spark, sf):
    return plain(evaluation.best_f1(scored(spark, sf)))


@query
def l07_band_performance(spark, sf):
    return plain(evaluation.band_performance(scored(spark, sf)))


@query
def l08_score_histogram(spark, sf):
    return plain(evaluation.score_histogram(scored(spark, sf)))


@query
def l09_score_boxes(spark, sf):
    return plain(evaluation.score_boxes(scored(spark, sf)))


@query
def l10_score_description(spark, sf):
    return plain(evaluation.score_description(scored(spark, sf)))


@query
def l11_fraud_rate(spark, sf):
    return plain(evaluation.fraud_rate(risk(spark, sf)))


# --- profiling and concentration -------------------------------------------------------

@query
def m01_table_profile(spark, sf):
    return profiling.table_profile(risk(spark, sf))


@query
def m02_label_distribution(spark, sf):
    return plain(profiling.label_distribution(risk(spark, sf)))


@query
def m04_most_missing(spark, sf):
    return plain(profiling.most_missing(risk(spark, sf)))


@query
def m05_sample_velocity(spark, sf):
    df = profiling.signal_sample(risk(spark, sf), "txns_last_24h", SIGNAL_SAMPLE)
    return plain(df.select(ID, "transaction_type", "txns_last_24h"))


@query
def m05_sample_amount_ratio(spark, sf):
    df = profiling.signal_sample(risk(spark, sf), "amount_vs_card_avg", SIGNAL_SAMPLE)
    return plain(df.select(ID, "transaction_type", "amount_vs_card_avg"))


@query
def m05_sample_merchant_rate(spark, sf):
    df = profiling.signal_sample(risk(spark, sf), "merchant_fraud_rate_30d", SIGNAL_SAMPLE)
    return plain(df.select(ID, "transaction_type", "merchant_fraud_rate_30d"))


@query
def m06_velocity_boxes(spark, sf):
    return plain(profiling.signal_boxes(risk(spark, sf), "txns_last_24h"))


@query
def m06_merchant_rate_boxes(spark, sf):
    return plain(profiling.signal_boxes(risk(spark, sf), "merchant_fraud_rate_30d"))


@query
def m07_amount_ratio_histogram(spark, sf):
    return plain(profiling.signal_histogram(risk(spark, sf), "amount_vs_card_avg"))


@query
def m08_merchant_totals(spark, sf):
    return plain(concentration.merchant_totals(risk(spark, sf)))


@query
def m09_pareto(spark, sf):
    return plain(concentration.pareto(risk(spark, sf)))


@query
def m10_top_merchants(spark, sf):
    return plain(concentration.top_merchants(risk(spark, sf)))


@query
def m10_top_share(spark, sf):
    return plain(concentration.top_share(risk(spark, sf)))


@query
def m11_concentration(spark, sf):
    return plain(concentration.concentration(risk(spark, sf)))


# --- quality checks --------------------------------------------------------------------

@query
def n01_row_parity(spark, sf):
    return quality.row_parity(enriched(spark, sf), features(spark, sf))


@query
def n03_null_rates(spark, sf):
    return plain(quality.null_rates(features(spark, sf), CARD_ACTIVITY))


@query
def n04_card_activity_statistics(spark, sf):
    return plain(quality.card_activity_statistics(features(spark, sf)))


@query
def n05_risk_history_statistics(spark, sf):
    return plain(quality.risk_history_statistics(risk(spark, sf)))


@query
def n06_recent_slice_parity(spark, sf):
    df = features(spark, sf)
    return quality.recent_slice_parity(df, risk_history.add_risk_history_to_recent(df))


@query
def n07_first_rows(spark, sf):
    return plain(quality.first_rows(features(spark, sf), [ID, "amount", *CARD_ACTIVITY, "is_fraud"]))


@query
def n07_newest_rows(spark, sf):
    return plain(quality.newest_rows(risk(spark, sf), [ID, "txn_date", *RISK_HISTORY, "is_fraud"]))
