"""SQL for the queries on the fixed model, for sources and for the catalog."""

from __future__ import annotations

from math import factorial

from tollgate.functions import wording as w
from tollgate.operators.model_texts import CONTEXTS, FLAGS, SHAP_FLOOR
from tollgate.operators.model import RF_TREES
from tollgate.operators.forest_shap import SHAP_FLOOR as FOREST_FLOOR
from tollgate.plans import fixtures, oracle
from tollgate.plans.fixed_model import MODEL
from tollgate.plans.oracle import filled, fixed, on, quoted
from tollgate.schemas import EXTRACT_COLUMNS, MODEL_FEATURES, RAW_COLUMNS, risk_columns

N = len(MODEL_FEATURES)


def cut(value: str) -> str:
    return f"floor(({value}) * 1e6 + 0.5) / 1e6"


def _z(value: str, i: int) -> str:
    return f"(({value}) - {MODEL.means[i]}::DOUBLE) / {MODEL.deviations[i] or 1.0}::DOUBLE"


def _leaf_values(tree: dict, value, node: int = 0) -> str:
    """The tree as nested CASE over ``value(feature)``."""
    if tree["left"][node] < 0:
        return f"{tree['value'][node]}::DOUBLE"
    left, right = (_leaf_values(tree, value, tree[side][node]) for side in ("left", "right"))
    return f"CASE WHEN {value(tree['feature'][node])} <= {tree['threshold'][node]} THEN {left} ELSE {right} END"


def _expected(tree: dict, known: int, value, node: int = 0) -> str:
    """Expected leaf value when the features in the bits of ``known`` are given."""
    if tree["left"][node] < 0:
        return f"{tree['value'][node]}::DOUBLE"
    left, right = tree["left"][node], tree["right"][node]
    feature = tree["feature"][node]
    a, b = _expected(tree, known, value, left), _expected(tree, known, value, right)
    if known >> feature & 1:
        return f"CASE WHEN {value(feature)} <= {tree['threshold'][node]} THEN {a} ELSE {b} END"
    share = tree["weight"][left] / tree["weight"][node]
    return f"({share}::DOUBLE * ({a}) + {1 - share}::DOUBLE * ({b}))"


def _scores(source: str) -> str:
    """CTE ``modelled``: both scores of the rows of ``source``, gaps filled with the medians of ``source``."""
    filled_in = ", ".join(
        f"CASE WHEN {c} THEN 1.0::DOUBLE ELSE 0.0 END AS n_{c}" if c.startswith("is_")
        else f"CAST(coalesce({c}, (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM {source})) AS DOUBLE) AS n_{c}"
        for c in MODEL_FEATURES)
    names = [f"n_{c}" for c in MODEL_FEATURES]
    margin = " + ".join([f"{MODEL.intercept}::DOUBLE", *[f"({MODEL.coefficients[i]}::DOUBLE) * {_z(n, i)}" for i, n in enumerate(names)]])
    forest = " + ".join(f"({_leaf_values(tree, lambda f: names[f])})" for tree in MODEL.trees)
    return f"""
numbers AS (SELECT *, {filled_in} FROM {source}),
modelled AS (SELECT *, 1 / (1 + exp(-({margin}))) AS lr_score, ({forest}) / {len(MODEL.trees)} AS rf_score FROM numbers)"""


def _banded(score: str, name: str = "banded") -> str:
    return f"""
{name} AS (SELECT * EXCLUDE (score), score AS risk_score,
  CASE WHEN score >= 0.6 THEN 'HIGH' WHEN score >= 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_band
  FROM (SELECT *, {score} AS score FROM modelled))"""


ENSEMBLE = "lr_score * 0.5 + rf_score * 0.5"
GIVEN = {c: f"coalesce(CAST({c} AS DOUBLE), 0.0)" for c in MODEL_FEATURES}


def _contributions() -> str:
    """CTE ``shap``: v<i>, the value an explanation uses, and s<i>, its contribution to the log-odds."""
    values = ", ".join(f"{GIVEN[c]} AS v{i}" for i, c in enumerate(MODEL_FEATURES))
    parts = ", ".join(f"({_z(f'v{i}', i)}) * ({MODEL.coefficients[i]}::DOUBLE) AS s{i}" for i in range(N))
    return f"shap AS (SELECT *, {parts} FROM (SELECT *, {values} FROM risk))"


def _forest_contributions() -> str:
    """CTE ``forest``: e<subset>, the expected output by known features, and f<i>, the Shapley values."""
    values = ", ".join(f"{GIVEN[c]} AS v{i}" for i, c in enumerate(MODEL_FEATURES))
    subsets = ", ".join(
        f"({' + '.join('(' + _expected(tree, known, lambda f: f'v{f}') + ')' for tree in MODEL.trees)}) / {len(MODEL.trees)} AS e{known}"
        for known in range(2 ** N))
    parts = []
    for i in range(N):
        terms = []
        for known in range(2 ** N):
            if not known >> i & 1:
                size = bin(known).count("1")
                share = factorial(size) * factorial(N - size - 1) / factorial(N)
                terms.append(f"{share}::DOUBLE * (e{known | 1 << i} - e{known})")
        parts.append(f"{' + '.join(terms)} AS f{i}")
    return f"forest AS (SELECT *, {', '.join(parts)} FROM (SELECT *, {subsets} FROM (SELECT *, {values} FROM risk)))"


def _value_text(feature: str, value: str, with_context: bool) -> str:
    if feature in FLAGS:
        shown = f"CASE WHEN {value} <> 0 THEN 'Yes' ELSE 'No' END"
    elif feature == "merchant_fraud_rate_30d":
        shown = fixed(f"{value} * 100", 1)
    else:
        shown = fixed(value, 0)
    text = filled(w.VALUE_TEXTS[feature], f"({shown})")
    if with_context and feature in CONTEXTS:
        limit, (above, below) = CONTEXTS[feature]
        text += f" || CASE WHEN {value} > {limit} THEN {quoted(above)} ELSE {quoted(below)} END"
    return text


def _listed(entries: list[tuple[str, str]], floor: float) -> str:
    """The texts whose size is above the floor, largest first, ties in the order given."""
    structs = ", ".join(f"{{'size': -abs({size}), 'place': {i}, 'text': {text}}}" for i, (size, text) in enumerate(entries))
    kept = f"list_transform(list_filter(list_sort([{structs}]), lambda e: e['size'] < -{floor}), lambda e: e['text'])"
    return f"CASE WHEN len({kept}) > 0 THEN array_to_string({kept}, ' | ') ELSE {quoted(w.SHAP_NONE)} END"


def _sign(value: str) -> str:
    return f"CASE WHEN {value} > 0 THEN 'increases' ELSE 'decreases' END"


def _shap_texts() -> str:
    entries = []
    for i, feature in enumerate(MODEL_FEATURES):
        sign = f"CASE WHEN s{i} < 0 THEN '-' ELSE '+' END || {fixed(f'abs(s{i})', 3)}"
        entries.append((f"s{i}", " || ".join([
            quoted(f"**{w.FEATURE_TITLES[feature]}** (SHAP: "), sign, quoted("): "), f"({_sign(f's{i}')})", quoted(" fraud probability by "),
            fixed(f"abs(s{i}) * 100", 1), quoted("% - "), _value_text(feature, f"v{i}", True)])))
    return _listed(entries, SHAP_FLOOR)


def _forest_texts() -> str:
    entries = []
    for i, feature in enumerate(MODEL_FEATURES):
        parts = [quoted(f"{w.FOREST_TITLES[feature]} "), f"({_sign(f'f{i}')})", quoted(" risk by "), fixed(f"abs(f{i}) * 100", 1), quoted("%")]
        if feature not in FLAGS:
            before, after = w.VALUE_TEXTS[feature].split("{}")
            shown = fixed(f"v{i} * 100", 1) if feature == "merchant_fraud_rate_30d" else fixed(f"v{i}", 0)
            parts += [quoted(f" ({before}"), shown, quoted(f"{after})")]
        entries.append((f"f{i}", " || ".join(parts)))
    return _listed(entries, FOREST_FLOOR)


def _coefficient_texts() -> str:
    """Features by falling coefficient; tiny ones only among the first three."""
    texts = []
    ranked = sorted(range(N), key=lambda i: -abs(MODEL.coefficients[i]))
    for shown, i in enumerate(ranked):
        feature, c = MODEL_FEATURES[i], MODEL.coefficients[i]
        if abs(c) <= 0.0001 and shown >= 3:
            continue
        level = "high" if abs(c) > 0.5 else "medium" if abs(c) > 0.2 else "low"
        effect = "increases" if c > 0 else "decreases"
        texts.append(f"{quoted(f'**{w.FEATURE_TITLES[feature]}** ({level} impact): {effect} fraud risk - ')} || "
                     f"{_value_text(feature, GIVEN[feature], feature == 'txns_last_24h')} || {quoted(f' [Coefficient: {c:.3f}]')}")
    return "concat_ws(' | ', " + ", ".join(texts) + ")"


def _fixed_model() -> dict[str, str]:
    scores, both = _scores("risk"), _banded(ENSEMBLE)
    alone = _banded("lr_score")
    shown = f"SELECT txn_id_clean, {cut('risk_score')} AS risk_score, risk_band FROM banded"
    sql = {
        "j05_fixed_regression_score": on("risk", f"SELECT txn_id_clean, {cut('lr_score')} AS lr_score FROM modelled", scores),
        "j06_fixed_forest_score": on("risk", f"SELECT txn_id_clean, {cut('rf_score')} AS rf_score FROM modelled", scores),
        "j07_fixed_ensemble_score": on("risk", shown, scores, both),
        "j08_saved_model": on("risk", shown, scores, both),
        "j08_train_and_save": on("risk", "SELECT count(*) AS row_count, count(*) AS scored_rows, true AS model_saved FROM risk"),
        "j09_fixed_score_all_rows": on("risk", """SELECT risk_band, count(is_fraud) AS total, count(*) FILTER (is_fraud) AS fraud_count,
  round_even(count(*) FILTER (is_fraud) / nullif(count(is_fraud), 0), 4) AS fraud_rate,
  round_even(avg(risk_score), 4) AS avg_risk_score FROM banded GROUP BY risk_band""", scores, both),
        "j10_save_and_load": on("risk", f"SELECT txn_id_clean, {cut('risk_score')} AS risk_score, true AS other_features_refused FROM banded", scores, both),
        "j11_retrain": on("risk", "SELECT count(is_fraud) AS labelled_rows, false AS trained_when_saved, true AS trained_when_forced, true AS replaced FROM risk"),
        "j12_fixed_regression_only": on("risk", shown, scores, alone),
        "k04_fixed_contributions": on("risk", f"SELECT txn_id_clean, {cut(f'{MODEL.intercept}::DOUBLE')} AS base_value, " + ", ".join(
            f"{cut(f's{i}')} AS shap_{c}" for i, c in enumerate(MODEL_FEATURES)) + " FROM shap", _contributions()),
        "k05_fixed_contribution_texts": on("risk", f"SELECT txn_id_clean, {_shap_texts()} AS explanations FROM shap", _contributions()),
        "k06_fixed_coefficient_texts": on("risk", f"SELECT txn_id_clean, {_coefficient_texts()} AS explanations FROM risk"),
        "k07_fixed_forest_contributions": on("risk", f"SELECT txn_id_clean, {cut('e0')} AS forest_base, " + ", ".join(
            f"{cut(f'f{i}')} AS forest_{c}" for i, c in enumerate(MODEL_FEATURES)) + " FROM forest", _forest_contributions()),
        "k07_fixed_forest_texts": on("risk", f"""SELECT txn_id_clean, {_forest_texts()} AS explanations
FROM (SELECT f.* FROM forest f)""", _forest_contributions()),
        "k08_fixed_contribution_bars": on("risk", f"""SELECT txn_id_clean, CAST(bar AS BIGINT) AS bar, entry['feature'] AS feature,
  {cut("entry['s']")} AS shap_value, CASE WHEN entry['s'] > 0 THEN 'red' ELSE 'green' END AS bar_color
FROM (SELECT txn_id_clean, unnest(bars) AS entry, unnest(range(1, {N + 1})) AS bar FROM (SELECT txn_id_clean, list_sort([{', '.join(
    f"{{'size': -abs(s{i}), 'place': {i}, 'feature': '{c}', 's': s{i}}}" for i, c in enumerate(MODEL_FEATURES))}]) AS bars FROM shap))""", _contributions()),
        "k09_fitted_additivity": on("risk", "SELECT count(*) AS row_count, true AS regression_adds_up, true AS forest_adds_up FROM risk WHERE "
                                    + " AND ".join(f"{f} IS NOT NULL" for f in MODEL_FEATURES)),
    }
    labelled = "labelled AS (SELECT * FROM numbers WHERE is_fraud IS NOT NULL)"
    sql["j05_fitted_minimum"] = on("risk", " UNION ALL ".join(
        ["SELECT count(*) AS training_rows, '(intercept)' AS feature, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS deviation, true AS at_minimum FROM labelled"]
        + [f"SELECT count(*), '{c}', {cut(f'avg(n_{c})')}, {cut(f'stddev_pop(n_{c})')}, true FROM labelled" for c in MODEL_FEATURES]), scores, labelled)
    sql["j06_fitted_nodes"] = on("risk", f"""SELECT CAST(tree AS BIGINT) AS tree, count(*) AS root_rows, CAST(0 AS BIGINT) AS small_splits, true AS adds_up
FROM labelled, range({RF_TREES}) t(tree) GROUP BY tree""", scores, labelled)
    facts = "(SELECT count(*) FROM risk) AS rows_to_score"
    pairs = ", ".join(f"('{f}', {c}::DOUBLE)" for f, c in zip(MODEL_FEATURES, MODEL.coefficients))
    sql["j15_fixed_coefficients"] = on("risk", f"""SELECT feature, {cut('c')} AS coefficient, {cut('abs(c)')} AS abs_coefficient, {facts}
FROM (VALUES {pairs}) t(feature, c)""")
    by_feature = "{" + ",".join(f'"{f}":{c}' if c >= 0.001 or c <= 0 else f'"{f}":5.0E-5' for f, c in zip(MODEL_FEATURES, MODEL.coefficients)) + "}"
    sql["j16_fixed_model_info"] = on("risk", f"""SELECT 'Model trained' AS status, {quoted(' | '.join(MODEL_FEATURES))} AS features,
  {quoted(by_feature)} AS coefficients, {cut(f'{MODEL.intercept}::DOUBLE')} AS intercept, {facts}""")
    weights = ", ".join(f"('{f}', {v}::DOUBLE)" for f, v in zip(MODEL_FEATURES, MODEL.importances))
    sql["j17_fixed_forest_importances"] = on("risk", f"""SELECT row_number() OVER (ORDER BY v DESC, feature) AS importance_rank, feature,
  {cut('v')} AS importance, {facts} FROM (VALUES {weights}) t(feature, v)""")

    test = f"""known AS (SELECT * FROM risk WHERE is_fraud IS NOT NULL),
totals AS (SELECT count(*) AS n, count(*) FILTER (is_fraud) AS f, count(*) - CAST(ceil(count(*) * 0.2) AS BIGINT) AS train FROM known),
sizes AS (SELECT train, train * f // n + CASE WHEN train * f % n > train * (n - f) % n THEN 1 ELSE 0 END AS fraud_train FROM totals),
ordered AS (SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY {oracle.HASH}) AS place FROM known),
test_part AS (SELECT ordered.* EXCLUDE (place) FROM ordered, sizes WHERE place > CASE WHEN is_fraud THEN fraud_train ELSE train - fraud_train END)"""
    chain = [test, _scores("test_part"), _banded(ENSEMBLE, "scored")]
    plain = oracle.oracle_sql()

    def over_test(name: str) -> str:
        """The query ``name``, which reads ``scored``, over the scored test part."""
        text = plain[name]
        tail = text[text.index("FROM pointed)") + len("FROM pointed)"):].lstrip(",")
        tail = tail.replace("known AS (SELECT * FROM scored", "tested AS (SELECT * FROM scored").replace("FROM known GROUP BY risk_score", "FROM tested GROUP BY risk_score")
        joiner = ",\n" if " AS (" in tail.split("SELECT")[0] else "\n"
        return on("risk", "", *chain).rstrip("\n") + joiner + tail.lstrip("\n,")

    sql["l12_test_report"] = over_test("l02_classification_report")
    sql["l12_test_roc_auc"] = over_test("l03_roc_auc")
    sql["l13_trained_evaluation"] = on("risk", """SELECT count(*) AS test_rows, count(*) AS scored_rows, true AS auc_is_a_share,
  true AS auc_at_most_one FROM test_part""", test)
    return sql


def _families() -> dict[str, list[str]]:
    """Columns of the feature table by type family."""
    numeric = ["amount", "amt_last_24h", "txn_hour", "is_emulator", "amount_vs_card_avg"]
    numeric += [c for c in risk_columns() if c.endswith(("_1h", "_24h", "_30d")) and c not in numeric]
    datetime = ["txn_ts", "txn_date"]
    boolean = [c for c in risk_columns() if c.startswith("is_") and not c.endswith(("_raw", "_clean")) and c not in numeric]
    known = {*numeric, *datetime, *boolean}
    return {"numeric": numeric, "string": [c for c in risk_columns() if c not in known], "boolean": boolean, "datetime": datetime}


def _sources() -> dict[str, str]:
    raw = RAW_COLUMNS["raw_transactions"]
    texts = {"raw_transactions": fixtures.RAW_TRANSACTIONS, "raw_merchants": fixtures.MERCHANTS, "raw_devices": fixtures.DEVICES,
             "raw_cards": fixtures.CARDS, "raw_rule_hits": fixtures.RULE_HITS, "raw_investigator_notes": fixtures.NOTES}
    report = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS stored_rows, count(*) AS loaded_rows, true AS matches FROM ({text})" for name, text in texts.items())
    cards, merchants = f"({fixtures.CARDS})", f"({fixtures.MERCHANTS})"
    return {
        "a02_multi_file_scan": on("raw", "SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in raw) + " FROM raw"),
        "a03_missing_input": f"SELECT 'present' AS input, count(*) AS row_count FROM {cards} UNION ALL SELECT 'missing', 0",
        "a04_truncate_and_reload": report,
        "a06_load_reconciliation": report,
        "a05_append": f"SELECT 2 * count(*) AS stored_rows, count(*) AS first_read, count(*) AS second_read FROM {merchants}",
        "a04_failed_reload": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count, true AS reload_failed FROM ({text})" for name, text in texts.items()),
        "a05_append_once": f"SELECT 2 * count(*) AS stored_rows, count(*) AS load_0, CAST(0 AS BIGINT) AS load_1, count(*) AS load_2 FROM {merchants}",
        "a07_table_scan": f"SELECT * FROM {cards}",
        "a08_recreate_table": f"SELECT device_id, os FROM ({fixtures.DEVICES})",
        "a09_database_and_raw_tables": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, " + (f"count(*) AS row_count FROM {cards}" if t == "raw_cards" else "CAST(0 AS BIGINT) AS row_count") for t in RAW_COLUMNS),
        "a11_bad_values": on("risk", f"""SELECT txn_id_clean, CASE WHEN NOT bad THEN strftime(txn_ts, '%Y-%m-%d %H:%M:%S') END AS txn_ts,
  CASE WHEN NOT bad THEN strftime(txn_date, '%Y-%m-%d') END AS txn_date,
  CASE WHEN NOT bad THEN is_high_risk_merchant END AS is_high_risk_merchant, is_fraud
FROM (SELECT *, coalesce(txn_id_clean LIKE '%7', false) AS bad FROM (SELECT {', '.join(EXTRACT_COLUMNS)} FROM risk))"""),
        "a12_run_and_verify_stage": on("raw", "SELECT count(*) AS rows_before, count(*) AS rows_after, CAST(0 AS BIGINT) AS difference, true AS rows_match FROM raw"),
        "a13_catalog_checks": f"""SELECT t.*, CAST(6 AS BIGINT) AS tables_listed, (SELECT count(*) FROM {cards}) AS row_count
FROM (VALUES ('raw_cards', true, 'card_id', true), ('raw_cards', true, 'bin', true), ('raw_cards', true, 'no_such_column', false),
  ('no_such_table', false, 'card_id', false)) t(table_name, table_exists, column_name, column_exists)""",
        "m03_type_families": on("risk", " UNION ALL ".join(
            f"SELECT '{family}' AS type_family, CAST({len(columns)} AS BIGINT) AS column_count, {' + '.join(f'count({c})' for c in columns)} AS value_count FROM risk"
            for family, columns in _families().items())),
        "n02_required_columns": on("risk", """SELECT 'txns_last_24h' AS column_name, true AS present, count(txns_last_24h) AS value_count FROM risk
UNION ALL SELECT 'merchant_fraud_rate_30d', true, count(merchant_fraud_rate_30d) FROM risk UNION ALL SELECT 'no_such_column', false, 0"""),
    }


def oracle_sql() -> dict[str, str]:
    return {**_fixed_model(), **_sources()}
