"""The same queries as plain SQL for DuckDB, over the whole test tables.

Each text states what an operator means (range frames, correlated look-ups, sorts of
everything) rather than how the Spark jobs get there.
"""

from __future__ import annotations

from tollgate.functions import wording as w
from tollgate.plans import fixtures
from tollgate.plans.registry import CARD_SHARE, EXTRACT_TARGET, SIGNAL_SAMPLE
from tollgate.schemas import (
    CARD_ACTIVITY,
    EXTRACT_COLUMNS,
    MODEL_FEATURES,
    RAW_COLUMNS,
    RISK_HISTORY,
    enriched_columns,
    risk_columns,
    staged_columns,
)

RAW = RAW_COLUMNS["raw_transactions"]

DATES = {"txn_date", "day", "date", "date_min", "date_max"}
TIMES = {"txn_ts", "first_seen_ts"}
FRACTIONS = {
    "amount", "amt_last_24h", "amount_vs_card_avg", "fraud_rate", "decline_rate", "risk_score", "rule_score",
    "card_fraud_rate_30d", "card_decline_rate_30d", "merchant_fraud_rate_30d", "merchant_decline_rate_30d",
}


# Merchant keys in several spellings, as the queries over collated keys write them.
MIXED_KEY = """CASE WHEN right(txn_id_clean, 1) IN ('0', '1', '2', '3') THEN upper(merchant_id_clean)
  WHEN right(txn_id_clean, 1) IN ('4', '5', '6') THEN 'ḿ' || merchant_id_clean[2:] ELSE merchant_id_clean END"""


def show(names) -> str:
    """Select items in the plain types the Spark side returns."""
    items = []
    for name in names:
        if name in DATES:
            items.append(f"strftime({name}, '%Y-%m-%d') AS {name}")
        elif name in TIMES:
            items.append(f"strftime({name}, '%Y-%m-%d %H:%M:%S') AS {name}")
        elif name in FRACTIONS:
            items.append(f"floor((CAST({name} AS DOUBLE)) * 1e6 + 0.5) / 1e6 AS {name}")
        elif name in ("txn_hour", "is_emulator"):
            items.append(f"CAST({name} AS BIGINT) AS {name}")
        else:
            items.append(name)
    return ", ".join(items)


STAGED = f"""
cleaned AS (
  SELECT {', '.join(f'{c} AS {c}_raw' for c in RAW)},
         {', '.join(f"nullif(trim({c}), '') AS {c}_clean" for c in RAW)}
  FROM raw),
typed AS (
  SELECT *,
    try_strptime(txn_ts_clean, '%Y-%m-%d %H:%M:%S') AS txn_ts,
    CASE WHEN regexp_full_match(amount_clean, '-?[0-9]+([.][0-9]+)?')
         THEN try_cast(amount_clean AS DECIMAL(12,2)) END AS amount,
    CASE WHEN lower(is_fraud_clean) IN ('1', 'true', 'yes', 'y') THEN true
         WHEN lower(is_fraud_clean) IN ('0', 'false', 'no', 'n') THEN false END AS is_fraud,
    CASE WHEN auth_result_clean IS NULL THEN NULL
         WHEN upper(auth_result_clean) IN ('APPROVED', 'DECLINED') THEN upper(auth_result_clean)
         ELSE 'OTHER' END AS auth_result_std,
    CASE WHEN channel_clean IS NULL THEN NULL
         WHEN upper(channel_clean) IN ('WEB', 'ONLINE') THEN 'WEB'
         WHEN upper(channel_clean) IN ('MOBILE', 'APP') THEN 'MOBILE'
         WHEN upper(channel_clean) IN ('POS', 'POINT_OF_SALE') THEN 'POS'
         WHEN upper(channel_clean) = 'API' THEN 'API' ELSE 'OTHER' END AS channel_std,
    CASE WHEN country_clean IS NULL THEN NULL WHEN strlen(country_clean) = 2 THEN upper(country_clean)
         ELSE 'OTHER' END AS country_std
  FROM cleaned),
stg AS (
  SELECT * EXCLUDE (is_fraud_clean),
    CAST(txn_ts AS DATE) AS txn_date, hour(txn_ts) AS txn_hour,
    coalesce(auth_result_std = 'DECLINED', false) AS is_declined,
    coalesce(amount = 0, false) AS is_zero_amount,
    coalesce(amount < 0, false) AS is_negative_amt,
    coalesce(amount > 10000, false) AS is_high_amount
  FROM typed)"""

ENRICHED = """
joined AS (
  SELECT s.*,
    nullif(trim(m.mcc), '') AS merchant_category, nullif(trim(m.country), '') AS merchant_country,
    nullif(trim(m.risk_tier), '') AS merchant_risk_tier,
    nullif(trim(d.os), '') AS device_type, nullif(trim(d.os), '') AS os,
    CASE WHEN trim(d.is_emulator) IN ('1', 'true', 'TRUE', 'True', 'yes', 'YES', 'Yes') THEN 1
         WHEN trim(d.is_emulator) IN ('0', 'false', 'FALSE', 'False', 'no', 'NO', 'No') THEN 0 END AS is_emulator,
    nullif(trim(k.issuer), '') AS card_network, nullif(trim(k.card_type), '') AS card_type,
    CAST(NULL AS VARCHAR) AS issuing_country
  FROM stg s
  LEFT JOIN merchants m ON s.merchant_id_clean = m.merchant_id
  LEFT JOIN devices d ON s.device_id_clean = d.device_id
  LEFT JOIN cards k ON s.card_id_clean = k.card_id),
enr AS (
  SELECT *, coalesce(upper(merchant_risk_tier) = 'HIGH', false) AS is_high_risk_merchant,
    coalesce(country_std <> issuing_country, false) AS is_foreign_transaction,
    coalesce(is_emulator = 1, false) AS is_emulator_device
  FROM joined)"""

SIGHTINGS = """
sightings AS (
  SELECT card_id_clean, merchant_id_clean, min(txn_ts) AS first_seen_ts FROM enr
  WHERE card_id_clean IS NOT NULL AND merchant_id_clean IS NOT NULL AND txn_ts IS NOT NULL
  GROUP BY card_id_clean, merchant_id_clean),
met AS (
  SELECT *, count(*) OVER (PARTITION BY card_id_clean ORDER BY first_seen_ts
    RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) AS merchants FROM sightings)"""


def _activity(source: str) -> str:
    def frame(hours: int) -> str:
        return (
            "(PARTITION BY b.card_id_clean ORDER BY b.txn_ts "
            f"RANGE BETWEEN INTERVAL {hours} HOUR PRECEDING AND CURRENT ROW)"
        )

    return f"""SELECT b.*,
    CASE WHEN b.txn_ts IS NOT NULL THEN count(*) OVER {frame(1)} END AS txns_last_1h,
    CASE WHEN b.txn_ts IS NOT NULL THEN count(*) OVER {frame(24)} END AS txns_last_24h,
    CASE WHEN b.txn_ts IS NOT NULL THEN coalesce(sum(b.amount) OVER {frame(24)}, 0) END AS amt_last_24h,
    CASE WHEN b.txn_ts IS NOT NULL THEN count(*) FILTER (b.is_declined) OVER {frame(24)} END
      AS declined_txns_last_24h,
    (round(CAST(b.amount AS DOUBLE) / nullif(
      CAST(sum(b.amount) OVER (PARTITION BY b.card_id_clean) AS DOUBLE)
      / count(b.amount) OVER (PARTITION BY b.card_id_clean), 0), 6) + 0.0) AS amount_vs_card_avg,
    (SELECT t.merchants FROM met t WHERE t.card_id_clean = b.card_id_clean
       AND t.first_seen_ts <= b.txn_ts AND t.first_seen_ts >= b.txn_ts - INTERVAL 24 HOUR
     ORDER BY t.first_seen_ts DESC LIMIT 1) AS distinct_merchants_last_24h
  FROM {source} b"""


FEATURES = f"feat AS ({_activity('enr')})"


def _history(prefix: str, key: str, source: str) -> str:
    frame = f"(PARTITION BY {key} ORDER BY day RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW)"
    return f"""
{prefix}_daily AS (
  SELECT {key}, CAST(txn_ts AS DATE) AS day, count(*) AS txn_count,
    avg(CASE WHEN is_fraud THEN 1.0 ELSE 0.0 END) AS fraud_rate,
    avg(CASE WHEN is_declined THEN 1.0 ELSE 0.0 END) AS decline_rate
  FROM {source} WHERE {key} IS NOT NULL AND txn_ts IS NOT NULL GROUP BY ALL),
{prefix}_rolling AS (
  SELECT {key}, day, CAST(sum(txn_count) OVER {frame} AS BIGINT) AS {prefix}_txn_count_30d,
    round(avg(fraud_rate) OVER {frame}, 9) AS {prefix}_fraud_rate_30d,
    round(avg(decline_rate) OVER {frame}, 9) AS {prefix}_decline_rate_30d
  FROM {prefix}_daily)"""


def _with_history(source: str, name: str) -> str:
    items = ", ".join(f"coalesce({c}, 0) AS {c}" for c in RISK_HISTORY)
    return f"""{_history('card', 'card_id_clean', source)},{_history('merchant', 'merchant_id_clean', source)},
{name} AS (
  SELECT b.*, {items} FROM {source} b
  LEFT JOIN card_rolling c ON b.card_id_clean = c.card_id_clean AND CAST(b.txn_ts AS DATE) = c.day
  LEFT JOIN merchant_rolling m ON b.merchant_id_clean = m.merchant_id_clean AND CAST(b.txn_ts AS DATE) = m.day)"""


def _recent(source: str) -> str:
    return (
        f"recent AS (SELECT * FROM {source} WHERE txn_ts >= "
        f"(SELECT max(txn_ts) FROM {source}) - INTERVAL 30 DAY)"
    )


SCORED = """
pointed AS (
  SELECT *, least(greatest(0.0
    + least(greatest(coalesce(CAST(txns_last_24h AS DOUBLE), 0.0) / 30.0 * 25, 0.0), 25.0)
    + least(greatest((abs(coalesce(CAST(amount_vs_card_avg AS DOUBLE), 1.0)) - 1.0) * 10, 0.0), 20.0)
    + CASE WHEN is_high_risk_merchant THEN 15 ELSE 0 END
    + CASE WHEN is_emulator_device THEN 15 ELSE 0 END
    + least(greatest(coalesce(CAST(merchant_fraud_rate_30d AS DOUBLE), 0.0) / 0.5 * 15, 0.0), 15.0)
    + least(greatest(coalesce(CAST(declined_txns_last_24h AS DOUBLE), 0.0) / 5.0 * 10, 0.0), 10.0),
    0.0), 100.0) AS rule_score FROM risk),
scored AS (
  SELECT *, rule_score / 100.0 AS risk_score,
    CASE WHEN rule_score / 100.0 >= 0.6 THEN 'HIGH' WHEN rule_score / 100.0 >= 0.3 THEN 'MEDIUM'
         ELSE 'LOW' END AS risk_band FROM pointed)"""

HASH = "md5(coalesce(txn_id_clean, '') || '|42')"

EXTRACT = f"""
bi AS (SELECT {', '.join(EXTRACT_COLUMNS)} FROM risk),
extract AS (
  SELECT * FROM bi WHERE is_fraud
  UNION ALL
  SELECT * FROM (SELECT * FROM bi WHERE NOT is_fraud ORDER BY {HASH}
    LIMIT (SELECT greatest({EXTRACT_TARGET} - count(*) FILTER (is_fraud), 0) FROM bi)))"""

CHAIN = {
    "raw": [], "merchants": [], "devices": [], "cards": [],
    "stg": ["raw"],
    "enr": ["stg", "merchants", "devices", "cards"],
    "met": ["enr"],
    "feat": ["met"],
    "risk": ["feat"],
    "scored": ["risk"],
    "extract": ["risk"],
    "ledger": [],
}
PARTS = {
    "raw": f"raw AS ({fixtures.RAW_TRANSACTIONS})",
    "merchants": f"merchants AS ({fixtures.MERCHANTS})",
    "devices": f"devices AS ({fixtures.DEVICES})",
    "cards": f"cards AS ({fixtures.CARDS})",
    "stg": STAGED, "enr": ENRICHED, "met": SIGHTINGS, "feat": FEATURES,
    "risk": _with_history("feat", "risk"), "scored": SCORED, "extract": EXTRACT,
    "ledger": f"ledger AS ({fixtures.LEDGER})",
}


def _needs(name: str, seen: list[str]) -> list[str]:
    for needed in CHAIN[name]:
        _needs(needed, seen)
    if name not in seen:
        seen.append(name)
    return seen


def on(names: str, body: str, *extra: str) -> str:
    """A query body over the named stages, preceded by everything they are built from.

    With an empty body the last of ``extra`` ends in the query itself.
    """
    order: list[str] = []
    for name in names.split():
        _needs(name, order)
    return "WITH " + ",\n".join([*(PARTS[n] for n in order), *extra]) + f"\n{body}"


def _rates(key: str, name: str, source: str = "risk", where: str = "true") -> str:
    return f"""SELECT {key} AS {name}, count(*) FILTER (is_fraud) AS fraud_count, count(is_fraud) AS total_count,
  round_even(count(*) FILTER (is_fraud) / nullif(count(is_fraud), 0) * 100, 2) AS fraud_rate
FROM {source} WHERE {key} IS NOT NULL AND {where} GROUP BY ALL"""


VIEW = "coalesce(channel_std = 'WEB' AND txn_date >= DATE '2024-01-05' AND txn_date <= DATE '2024-01-25', false)"


def money(column: str) -> str:
    return f"coalesce('$' || format('{{:,.2f}}', CAST({column} AS DOUBLE)), 'N/A')"


def fixed(value: str, digits: int) -> str:
    return f"printf('%.{digits}f', round_even({value}, {digits}))"


def mark(band: str) -> str:
    m = w.BAND_MARKS
    return f"CASE {band} WHEN 'HIGH' THEN '{m['HIGH']}' WHEN 'MEDIUM' THEN '{m['MEDIUM']}' ELSE '{m['LOW']}' END"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def filled(template: str, value: str) -> str:
    before, after = template.split("{}")
    return f"{quoted(before)} || {value} || {quoted(after)}"


RULE_TEXTS = {
    "velocity": f"CASE WHEN txns_last_24h > 10 THEN {filled(w.RULE_VELOCITY, 'CAST(txns_last_24h AS VARCHAR)')} END",
    "amount": "CASE WHEN abs(amount_vs_card_avg - 1.0) > 0.5 THEN "
              f"{filled(w.RULE_AMOUNT, fixed('amount_vs_card_avg', 2))} END",
    "merchant": f"CASE WHEN is_high_risk_merchant THEN {quoted(w.RULE_MERCHANT)} END",
    "emulator": f"CASE WHEN is_emulator_device THEN {quoted(w.RULE_EMULATOR)} END",
    "rate": "CASE WHEN merchant_fraud_rate_30d > 0.1 THEN "
            f"{filled(w.RULE_MERCHANT_RATE, fixed('merchant_fraud_rate_30d * 100', 1))} END",
    "declines": "CASE WHEN declined_txns_last_24h > 2 THEN "
                f"{filled(w.RULE_DECLINES, 'CAST(declined_txns_last_24h AS VARCHAR)')} END",
}


def rules(order: str) -> str:
    texts = ", ".join(RULE_TEXTS[name] for name in order.split())
    return (
        f"SELECT txn_id_clean, coalesce(nullif(concat_ws(' | ', {texts}), ''), {quoted(w.RULE_NONE)}) "
        "AS explanations FROM risk"
    )


def factors(*pairs: tuple[str, str]) -> str:
    return "concat_ws(', ', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for c, n in pairs) + ")"


STRONG = factors(
    ("txns_last_24h > 10", w.FACTOR_VELOCITY), ("declined_txns_last_24h > 2", w.FACTOR_DECLINES),
    ("is_high_risk_merchant", w.FACTOR_MERCHANT), ("is_emulator_device", w.FACTOR_EMULATOR),
    ("merchant_fraud_rate_30d > 0.1", w.FACTOR_MERCHANT_RATE),
)
MODERATE = factors(("txns_last_24h > 5", w.FACTOR_SOME_VELOCITY), ("is_high_risk_merchant", w.FACTOR_MERCHANT))

STEPS = """
known AS (SELECT * FROM scored WHERE is_fraud IS NOT NULL),
per_score AS (
  SELECT risk_score AS threshold, count(*) FILTER (is_fraud) AS pos, count(*) FILTER (NOT is_fraud) AS neg
  FROM known GROUP BY risk_score),
steps AS (
  SELECT *, sum(pos) OVER o AS tp, sum(neg) OVER o AS fp, row_number() OVER (ORDER BY threshold DESC) AS n,
    sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg,
    lead(pos) OVER (ORDER BY threshold DESC) AS next_pos, lead(neg) OVER (ORDER BY threshold DESC) AS next_neg
  FROM per_score WINDOW o AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING))"""

PARETO = """
merchant_totals AS (
  SELECT merchant_id_clean, count(*) AS total_txns, count(*) FILTER (is_fraud) AS total_fraud_txns,
    count(*) FILTER (is_fraud) / count(*) * 100 AS fraud_rate
  FROM risk WHERE merchant_id_clean IS NOT NULL AND is_fraud IS NOT NULL GROUP BY 1),
pareto AS (
  SELECT *, sum(total_fraud_txns) OVER o / nullif(sum(total_fraud_txns) OVER (), 0) * 100 AS cumulative_fraud_pct,
    row_number() OVER o AS merchant_rank
  FROM merchant_totals
  WINDOW o AS (ORDER BY total_fraud_txns DESC, md5(merchant_id_clean), merchant_id_clean ROWS UNBOUNDED PRECEDING))"""

PARETO_COLUMNS = (
    "merchant_id_clean, total_txns, total_fraud_txns, floor((fraud_rate) * 1e6 + 0.5) / 1e6 AS fraud_rate, "
    "floor((cumulative_fraud_pct) * 1e6 + 0.5) / 1e6 AS cumulative_fraud_pct, merchant_rank"
)


def boxes(value: str, group: str, source: str, where: str) -> str:
    return f"""
shown AS (SELECT CASE WHEN is_fraud THEN 'Fraud' ELSE 'Legitimate' END AS {group},
    CAST({value} AS DOUBLE) AS v FROM {source} WHERE is_fraud IS NOT NULL AND {value} IS NOT NULL AND {where}),
quarters AS (SELECT {group}, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
    quantile_cont(v, 0.75) AS q3 FROM shown GROUP BY ALL)
SELECT {group}, count(*) AS rows, floor((min(v)) * 1e6 + 0.5) / 1e6 AS min,
  floor((min(v) FILTER (v >= q1 - 1.5 * (q3 - q1))) * 1e6 + 0.5) / 1e6 AS whisker_low, floor((any_value(q1)) * 1e6 + 0.5) / 1e6 AS q1,
  floor((any_value(median)) * 1e6 + 0.5) / 1e6 AS median, floor((any_value(q3)) * 1e6 + 0.5) / 1e6 AS q3,
  floor((max(v) FILTER (v <= q3 + 1.5 * (q3 - q1))) * 1e6 + 0.5) / 1e6 AS whisker_high, floor((max(v)) * 1e6 + 0.5) / 1e6 AS max,
  count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers
FROM shown JOIN quarters USING ({group}) GROUP BY {group}"""


def bins(value: str, group: str, source: str, where: str, shared: bool) -> str:
    edges = (
        f"SELECT {group}, min(min(v)) OVER () AS low, max(max(v)) OVER () AS high FROM shown GROUP BY {group}"
        if shared else f"SELECT {group}, min(v) AS low, max(v) AS high FROM shown GROUP BY {group}"
    )
    return f"""
shown AS (SELECT CASE WHEN is_fraud THEN 'Fraud' ELSE 'Legitimate' END AS {group},
    CAST({value} AS DOUBLE) AS v FROM {source} WHERE is_fraud IS NOT NULL AND {value} IS NOT NULL AND {where}),
edges AS ({edges}),
wide AS (SELECT {group}, CASE WHEN low = high THEN low - 0.5 ELSE low END AS low,
    ((CASE WHEN low = high THEN high + 0.5 ELSE high END) - (CASE WHEN low = high THEN low - 0.5 ELSE low END)) / 50
      AS width FROM edges),
placed AS (SELECT {group}, CAST(least(floor((v - low) / width), 49) AS BIGINT) AS bin, count(*) AS rows
    FROM shown JOIN wide USING ({group}) GROUP BY ALL)
SELECT {group}, bin, floor((low + bin * width) * 1e6 + 0.5) / 1e6 AS bin_start, floor((low + (bin + 1) * width) * 1e6 + 0.5) / 1e6 AS bin_end,
  coalesce(rows, 0) AS rows
FROM wide CROSS JOIN (SELECT unnest(range(50)) AS bin) g LEFT JOIN placed USING ({group}, bin)"""


def signal_sample(value: str, where: str) -> str:
    return f"""
known AS (SELECT * FROM risk WHERE is_fraud IS NOT NULL AND {where}),
sizes AS (SELECT CAST(floor({SIGNAL_SAMPLE} * (count(*) FILTER (is_fraud) / count(*))) AS BIGINT) AS fraud_rows FROM known),
ordered AS (SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY {HASH}) AS place FROM known)
SELECT txn_id_clean, CASE WHEN is_fraud THEN 'Fraud' ELSE 'Legitimate' END AS transaction_type,
  {show([value])}
FROM ordered, sizes
WHERE place <= CASE WHEN is_fraud THEN fraud_rows ELSE {SIGNAL_SAMPLE} - fraud_rows END"""


def missing(columns, source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count, count(*) AS row_count FROM {source}"
        for c in columns
    )


CONFUSION = """
cells AS (
  SELECT count(*) FILTER (NOT is_fraud AND risk_score < 0.5) AS tn, count(*) FILTER (NOT is_fraud AND risk_score >= 0.5) AS fp,
    count(*) FILTER (is_fraud AND risk_score < 0.5) AS fn, count(*) FILTER (is_fraud AND risk_score >= 0.5) AS tp
  FROM scored WHERE is_fraud IS NOT NULL)"""

IMPUTED = "imputed AS (SELECT txn_id_clean, " + ", ".join(
    f"CASE WHEN {c} THEN 1.0::DOUBLE ELSE 0.0 END AS {c}" if c.startswith("is_")
    else f"CAST(coalesce({c}, (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM risk)) AS DOUBLE) AS {c}"
    for c in MODEL_FEATURES
) + " FROM risk)"


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    raw_text = ", ".join(RAW)

    # sources and sinks
    sql["a01_csv_scan"] = on("raw", "SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in RAW) + " FROM raw")
    sql["a06_load_reconciliation"] = on("raw merchants devices cards", " UNION ALL ".join(
        f"SELECT 'raw_{n}' AS table_name, count(*) AS stored_rows, count(*) AS loaded_rows, true AS matches FROM {t}"
        for n, t in [("transactions", "raw"), ("merchants", "merchants"), ("devices", "devices"), ("cards", "cards")]
    ))
    sql["a10_extract_csv_round_trip"] = on("extract", f"SELECT {show(EXTRACT_COLUMNS)} FROM extract")

    # staging
    sql["b01_raw_preserved"] = on("raw", "SELECT " + ", ".join(f"{c} AS {c}_raw" for c in raw_text.split(", ")) + " FROM raw")
    sql["b02_clean_text"] = on("raw", "SELECT " + ", ".join(f"nullif(trim({c}), '') AS {c}_clean" for c in RAW) + " FROM raw")
    staged = {
        "b03_timestamp": ["txn_ts_raw", "txn_ts"], "b04_amount": ["amount_raw", "amount"],
        "b05_fraud_flag": ["is_fraud_raw", "is_fraud"], "b06_auth_result": ["auth_result_raw", "auth_result_std"],
        "b07_channel": ["channel_raw", "channel_std"], "b08_country": ["country_raw", "country_std"],
        "b09_date_hour": ["txn_date", "txn_hour"],
        "b10_flags": ["is_declined", "is_zero_amount", "is_negative_amt", "is_high_amount"],
    }
    for name, columns in staged.items():
        sql[name] = on("stg", f"SELECT txn_id_clean, {show(columns)} FROM stg")
    sql["b11_staged_table"] = on("stg", f"SELECT {show(staged_columns())} FROM stg")

    # enrichment
    joined = {
        "c01_merchant": ["merchant_category", "merchant_country", "merchant_risk_tier"],
        "c02_device": ["device_type", "os"], "c03_card": ["card_network", "card_type"],
        "c04_emulator": ["is_emulator"], "c05_high_risk_merchant": ["is_high_risk_merchant"],
        "c06_foreign_transaction": ["is_foreign_transaction"], "c07_emulator_device": ["is_emulator_device"],
    }
    for name, columns in joined.items():
        sql[name] = on("enr", f"SELECT txn_id_clean, {show(columns)} FROM enr")
    sql["c06_foreign_by_issuer"] = on("stg cards", """SELECT s.txn_id_clean,
  CASE trim(k.card_type) WHEN 'DEBIT' THEN 'IN' WHEN 'CREDIT' THEN 'US' END AS issuing_country,
  coalesce(s.country_std <> CASE trim(k.card_type) WHEN 'DEBIT' THEN 'IN' WHEN 'CREDIT' THEN 'US' END, false)
    AS is_foreign_transaction
FROM stg s LEFT JOIN cards k ON s.card_id_clean = k.card_id""")
    sql["c01_collated_merchant"] = on("stg merchants", f"""SELECT s.txn_id_clean, nullif(trim(m.mcc), '') AS merchant_category,
  nullif(trim(m.country), '') AS merchant_country, nullif(trim(m.risk_tier), '') AS merchant_risk_tier
FROM (SELECT txn_id_clean, {MIXED_KEY} AS k FROM stg) s LEFT JOIN merchants m ON s.k COLLATE NOCASE.NOACCENT = m.merchant_id""")
    sql["c08_enriched_table"] = on("enr", f"SELECT {show(enriched_columns())} FROM enr")

    # card activity
    activity = {
        "d01_txns_last_1h": "txns_last_1h", "d02_txns_last_24h": "txns_last_24h", "d03_amt_last_24h": "amt_last_24h",
        "d04_declined_last_24h": "declined_txns_last_24h", "d05_amount_vs_card_avg": "amount_vs_card_avg",
        "d08_distinct_merchants_last_24h": "distinct_merchants_last_24h",
    }
    for name, column in activity.items():
        sql[name] = on("feat", f"SELECT txn_id_clean, {show([column])} FROM feat")
    sql["d06_first_sightings"] = on(
        "met", f"SELECT card_id_clean, merchant_id_clean, {show(['first_seen_ts'])} FROM sightings")
    sql["d07_new_merchants_24h"] = on(
        "met", "SELECT card_id_clean, merchant_id_clean, strftime(first_seen_ts, '%Y-%m-%d %H:%M:%S') AS txn_ts, "
        "merchants AS distinct_merchants_last_24h FROM met")
    sql["d09_missing_time_mask"] = on(
        "feat", f"SELECT txn_id_clean, {show(CARD_ACTIVITY)} FROM feat WHERE txn_ts IS NULL")
    # Features of the full build, of the chosen cards only: cards are complete.
    sql["d10_activity_on_sample"] = on("feat", f"""SELECT txn_id_clean, {show(CARD_ACTIVITY)} FROM feat
WHERE CAST('0x' || substring(md5(coalesce(card_id_clean, '') || '|42'), 1, 7) AS BIGINT) < {round(CARD_SHARE * 16**7)}""")
    sql["d_card_features_table"] = on("feat", f"SELECT txn_id_clean, {show(['txn_ts', 'amount', *CARD_ACTIVITY])} FROM feat")

    # risk history
    daily = ["txn_count", "fraud_rate", "decline_rate"]
    for prefix, key, number in [("card", "card_id_clean", 1), ("merchant", "merchant_id_clean", 3)]:
        rolling = [c for c in RISK_HISTORY if c.startswith(prefix)]
        sql[f"e0{number}_{prefix}_daily"] = on("risk", f"SELECT {key}, {show(['day', *daily])} FROM {prefix}_daily")
        sql[f"e0{number + 1}_{prefix}_rolling"] = on("risk", f"SELECT {key}, {show(['day', *rolling])} FROM {prefix}_rolling")
        sql[f"e0{number + 1}_{prefix}_rolling_ledger"] = on(
            "ledger", f"SELECT {key}, {show(['day', *rolling])} FROM {prefix}_rolling", _history(prefix, key, "ledger"))
    sql["e05_card_history_joined"] = on("risk", f"SELECT txn_id_clean, {show(RISK_HISTORY[:3])} FROM risk")
    sql["e06_merchant_history_joined"] = on("risk", f"SELECT txn_id_clean, {show(RISK_HISTORY[3:])} FROM risk")
    sql["e06_history_joined_ledger"] = on(
        "ledger", f"SELECT txn_id_clean, {show(RISK_HISTORY)} FROM out", _with_history("ledger", "out"))
    for suffix, source in [("", "feat"), ("_ledger", "ledger")]:
        sql[f"e07_recent_slice{suffix}"] = on(
            source, f"SELECT txn_id_clean, {show(['txn_ts'])} FROM recent", _recent(source))
        sql[f"e08_history_on_recent_slice{suffix}"] = on(
            source, f"SELECT txn_id_clean, {show(RISK_HISTORY)} FROM out", _recent(source), _with_history("recent", "out"))
    sql["e_all_features_fused"] = on("risk", f"SELECT txn_id_clean, {show([*CARD_ACTIVITY, *RISK_HISTORY])} FROM risk")

    # BI extract
    counts = (
        "count(*) FILTER (is_fraud) AS fraud_count, count(*) FILTER (NOT is_fraud) AS non_fraud_count, "
        "count(*) AS total_count"
    )
    sql["f01_extract_projection"] = on("risk", f"SELECT {show(EXTRACT_COLUMNS)} FROM risk")
    sql["f02_class_counts"] = on("risk", f"SELECT {counts} FROM risk")
    sql["f03_sample_budget"] = on("risk", f"""SELECT *,
  least(greatest({EXTRACT_TARGET} - fraud_count, 0), non_fraud_count) AS non_fraud_taken,
  fraud_count + least(greatest({EXTRACT_TARGET} - fraud_count, 0), non_fraud_count) AS expected_rows
FROM (SELECT {counts} FROM risk)""")
    sql["f04_sampled_negatives"] = on("extract", "SELECT txn_id_clean FROM extract WHERE NOT is_fraud")
    sql["f05_extract"] = on("extract", f"SELECT {show(EXTRACT_COLUMNS)} FROM extract")
    sql["f06_shuffled_extract"] = sql["f05_extract"]
    sql["f07_extract_summary"] = on("extract", """SELECT count(*) AS total_rows, count(*) FILTER (is_fraud) AS fraud_count,
  round_even(count(*) FILTER (is_fraud) / count(*) * 100, 2) AS fraud_pct,
  count(*) FILTER (NOT is_fraud) AS non_fraud_count,
  round_even(count(*) FILTER (NOT is_fraud) / count(*) * 100, 2) AS non_fraud_pct,
  CAST(17 AS BIGINT) AS columns_exported FROM extract""")
    sql["f07_extract_preview"] = on("extract", f"""SELECT {show(EXTRACT_COLUMNS)} FROM (
  SELECT * FROM extract ORDER BY md5(coalesce(txn_id_clean, '') || '|43'), txn_id_clean LIMIT 2)""")

    # filters and display
    sql["g01_filters"] = on("risk", f"""SELECT {show(EXTRACT_COLUMNS)} FROM risk
WHERE {VIEW} AND merchant_risk_tier = 'HIGH' AND country_std = 'IN' AND NOT is_fraud""")
    sql["g02_filter_options"] = on("risk", " UNION ".join(
        f"SELECT '{n}' AS filter_name, {c} AS option_value FROM risk WHERE {c} IS NOT NULL"
        for n, c in [("merchant_risk_tiers", "merchant_risk_tier"), ("channels", "channel_std"), ("countries", "country_std")]
    ))
    sql["g03_date_bounds"] = on("risk", """SELECT strftime(min(txn_date), '%Y-%m-%d') AS date_min,
  strftime(max(txn_date), '%Y-%m-%d') AS date_max FROM risk""")
    sql["g04_overview_order"] = on("scored", f"SELECT txn_id_clean, {show(['risk_score'])}, risk_band FROM scored")
    percent_text = (
        "CASE WHEN risk_score <= 1.0 THEN " + fixed("risk_score * 100", 1) + " ELSE " + fixed("risk_score", 1) + " END || '%'"
    )
    sql["g05_display_table"] = on("scored", f"""SELECT txn_id_clean AS "Transaction ID",
  strftime(txn_date, '%Y-%m-%d') AS "Date", {money('amount')} AS "Amount", txns_last_24h AS "Txns (24h)",
  merchant_risk_tier AS "Merchant Risk",
  CASE WHEN is_fraud THEN '{w.LABEL_MARKS[True]}' WHEN NOT is_fraud THEN '{w.LABEL_MARKS[False]}' END AS "Fraud",
  {percent_text} AS "Risk Score", {mark('risk_band')} || ' ' || risk_band AS "Risk Band" FROM scored""")
    sql["g06_currency"] = on("risk", f"SELECT txn_id_clean, {money('amount')} AS amount_text FROM risk")
    points = "(risk_score * 100)"
    sql["g07_score_text"] = on("scored", f"""SELECT txn_id_clean, {fixed(points, 1)} || ' (' ||
  CASE WHEN {points} >= 70 THEN '{w.BAND_MARKS['HIGH']} High' WHEN {points} >= 40 THEN '{w.BAND_MARKS['MEDIUM']} Medium'
       ELSE '{w.BAND_MARKS['LOW']} Low' END || ')' AS score_text FROM scored""")
    ordered = "ORDER BY risk_score DESC NULLS LAST, md5(txn_id_clean), txn_id_clean"
    sql["g08_page"] = on("scored", f"""SELECT txn_id_clean, {show(['risk_score'])} FROM (
  SELECT * FROM scored {ordered} LIMIT 250 OFFSET 500)""")
    sql["g08_page_count"] = on("risk", "SELECT count(*) AS total_rows, CAST(ceil(count(*) / 1000) AS BIGINT) AS pages FROM risk")
    sql["g09_find_transaction"] = on("scored", f"""SELECT txn_id_clean, {show(['amount', 'risk_score'])} FROM (
  SELECT * FROM scored WHERE txn_id_clean = 'tx_123' {ordered} LIMIT 1)""")
    sql["g09_transaction_ids"] = on("risk", "SELECT DISTINCT txn_id_clean FROM risk")
    sql["g10_option_label"] = on("scored", f"""SELECT txn_id_clean, concat_ws(' | ', txn_id_clean,
  {mark('risk_band')} || ' ' || risk_band || ' (' || {fixed('risk_score * 100', 1)} || '%)', {money('amount')},
  CASE WHEN is_fraud THEN '{w.OPTION_FRAUD}' ELSE '{w.OPTION_LEGITIMATE}' END) AS option_label FROM scored""")

    # grouped analytics
    sql["h01_fraud_trends"] = on("risk", f"""SELECT strftime(date, '%Y-%m-%d') AS date, fraud_count, total_count, fraud_rate,
  total_count - fraud_count AS non_fraud_count FROM ({_rates('txn_date', 'date')})""")
    sql["h02_by_country"] = on("risk", _rates("country_std", "country"))
    sql["h03_top_merchants"] = on("risk", """SELECT merchant_id_clean AS merchant_id, merchant_risk_tier AS risk_tier,
  count(*) FILTER (is_fraud) AS fraud_count, count(is_fraud) AS total_count,
  round_even(count(*) FILTER (is_fraud) / nullif(count(is_fraud), 0) * 100, 2) AS fraud_rate
FROM risk WHERE merchant_id_clean IS NOT NULL AND merchant_risk_tier IS NOT NULL GROUP BY ALL
ORDER BY fraud_count DESC, merchant_id, risk_tier LIMIT 20""")
    sql["h03_collated_merchants"] = on("risk", f"""SELECT strip_accents(lower({MIXED_KEY})) AS merchant_id, merchant_risk_tier AS risk_tier,
  count(*) FILTER (is_fraud) AS fraud_count, count(is_fraud) AS total_count,
  round_even(count(*) FILTER (is_fraud) / nullif(count(is_fraud), 0) * 100, 2) AS fraud_rate
FROM risk WHERE merchant_id_clean IS NOT NULL AND merchant_risk_tier IS NOT NULL GROUP BY ALL
ORDER BY fraud_count DESC, merchant_id, risk_tier LIMIT 20""")
    sql["h04_top_cards"] = on("scored", """SELECT card_id_clean AS card_id,
  count(*) FILTER (is_fraud) AS fraud_count, count(is_fraud) AS total_count,
  floor((CAST(coalesce(sum(amount), 0) AS DOUBLE)) * 1e6 + 0.5) / 1e6 AS total_amount, floor((avg(risk_score)) * 1e6 + 0.5) / 1e6 AS avg_risk_score,
  round_even(count(*) FILTER (is_fraud) / nullif(count(is_fraud), 0) * 100, 2) AS fraud_rate
FROM scored WHERE card_id_clean IS NOT NULL GROUP BY ALL ORDER BY fraud_count DESC, card_id LIMIT 20""")
    sql["h05_top_transactions"] = on("scored", f"""SELECT txn_id_clean AS transaction_id, {show(['risk_score'])}, is_fraud,
  {show(['amount'])} FROM (SELECT * FROM scored ORDER BY risk_score DESC NULLS LAST, txn_id_clean LIMIT 20)""")
    sql["h06_by_channel"] = on("risk", _rates("channel_std", "channel"))
    sql["h07_by_hour"] = on("risk", _rates("hour(txn_ts)", "hour"))

    # key figures
    sql["i01_dataset_overview"] = on("risk", """SELECT (SELECT count(*) FROM risk) AS total_rows, count(*) AS filtered_rows,
  count(*) FILTER (is_fraud) AS fraud_count, count(*) FILTER (NOT is_fraud) AS non_fraud_count,
  round_even(count(*) FILTER (is_fraud) / count(*) * 100, 2) AS fraud_pct,
  strftime(min(txn_date), '%Y-%m-%d') AS date_min, strftime(max(txn_date), '%Y-%m-%d') AS date_max,
  floor((CAST(sum(amount) AS DOUBLE) / count(amount)) * 1e6 + 0.5) / 1e6 AS amount_avg, floor((CAST(sum(amount) AS DOUBLE)) * 1e6 + 0.5) / 1e6 AS amount_sum,
  count(DISTINCT merchant_risk_tier) AS tiers, count(DISTINCT channel_std) AS channels,
  count(DISTINCT country_std) AS countries FROM view""", f"view AS (SELECT * FROM risk WHERE {VIEW})")
    bands = ", ".join(
        f"count(*) FILTER (risk_band = '{b}') AS {b.lower()}_count, "
        f"round_even(count(*) FILTER (risk_band = '{b}') / count(*) * 100, 2) AS {b.lower()}_pct"
        for b in ("LOW", "MEDIUM", "HIGH")
    )
    sql["i02_filtered_statistics"] = on("scored", f"""SELECT count(*) AS filtered_rows, any_value(n) AS total_rows,
  count(*) - any_value(n) AS rows_delta, count(*) FILTER (is_fraud) AS fraud_count,
  count(*) FILTER (NOT is_fraud) AS non_fraud_count,
  round_even(count(*) FILTER (is_fraud) / count(*) * 100, 2) AS fraud_pct,
  round_even(count(*) FILTER (NOT is_fraud) / count(*) * 100, 2) AS non_fraud_pct,
  round_even(any_value(f) / any_value(n) * 100, 2) AS fraud_pct_all,
  round_even(count(*) FILTER (is_fraud) / count(*) * 100 - any_value(f) / any_value(n) * 100, 2) AS fraud_pct_delta,
  {bands}, floor((avg(risk_score)) * 1e6 + 0.5) / 1e6 AS risk_score_avg,
  floor((CAST(sum(amount) AS DOUBLE)) * 1e6 + 0.5) / 1e6 AS amount_sum, floor((CAST(sum(amount) AS DOUBLE) / count(amount)) * 1e6 + 0.5) / 1e6 AS amount_avg,
  floor((CAST(max(amount) AS DOUBLE)) * 1e6 + 0.5) / 1e6 AS amount_max, floor((CAST(min(amount) AS DOUBLE)) * 1e6 + 0.5) / 1e6 AS amount_min,
  floor((quantile_cont(CAST(amount AS DOUBLE), 0.5)) * 1e6 + 0.5) / 1e6 AS amount_median
FROM (SELECT * FROM scored WHERE {VIEW}), (SELECT count(*) AS n, count(*) FILTER (is_fraud) AS f FROM scored)""")
    sql["i03_value_breakdown"] = on("risk", " UNION ALL ".join(
        f"""SELECT '{c}' AS category, {c} AS category_value, count(*) AS row_count,
  round_even(count(*) / (SELECT count(*) FROM risk) * 100, 2) AS row_pct FROM risk WHERE {c} IS NOT NULL GROUP BY {c}"""
        for c in ("merchant_risk_tier", "channel_std", "country_std")
    ))
    sql["i04_band_distribution"] = on("scored", """SELECT b.risk_band, count(s.risk_band) AS row_count,
  round_even(count(s.risk_band) / (SELECT count(*) FROM scored) * 100, 1) AS row_pct
FROM (VALUES ('LOW'), ('MEDIUM'), ('HIGH')) b(risk_band) LEFT JOIN scored s ON s.risk_band = b.risk_band GROUP BY 1""")
    sql["i05_unscored_rows"] = on("scored", f"SELECT count(*) AS unscored_rows FROM scored WHERE NOT {VIEW} OR risk_score = 0.5")
    parameters = {
        "Transactions (24h)": "CAST(txns_last_24h AS VARCHAR)", "Declined (24h)": "CAST(declined_txns_last_24h AS VARCHAR)",
        "Amount vs Card Avg": fixed("amount_vs_card_avg", 2) + " || 'x'", "Amount": money("amount"),
        "Merchant Risk": "merchant_risk_tier",
        "Merchant Fraud Rate (30d)": fixed("merchant_fraud_rate_30d * 100", 1) + " || '%'",
        "High-Risk Merchant": "CASE WHEN is_high_risk_merchant THEN 'Yes' ELSE 'No' END",
        "Emulator Device": "CASE WHEN is_emulator_device THEN 'Yes' ELSE 'No' END",
    }
    sql["i06_risk_parameters"] = on("risk", " UNION ALL ".join(
        f"SELECT txn_id_clean, '{n}' AS parameter, coalesce({v}, 'N/A') AS value FROM risk" for n, v in parameters.items()
    ))

    # scoring
    sql["j01_rule_score"] = on("scored", f"SELECT txn_id_clean, {show(['rule_score'])} FROM scored")
    sql["j02_risk_band"] = on("scored", f"SELECT txn_id_clean, {show(['risk_score'])}, risk_band FROM scored")
    sql["j08_score_dispatch"] = sql["j02_risk_band"]
    sql["j03_imputation"] = on("risk", "SELECT txn_id_clean, " + ", ".join(f"floor(({c}) * 1e6 + 0.5) / 1e6 AS {c}" for c in MODEL_FEATURES)
                               + " FROM imputed", IMPUTED)
    sql["j04_feature_moments"] = on("risk", "SELECT " + ", ".join(
        f"floor((avg({c})) * 1e6 + 0.5) / 1e6 AS {c}_mean, floor((stddev_pop({c})) * 1e6 + 0.5) / 1e6 AS {c}_std" for c in MODEL_FEATURES
    ) + " FROM imputed", IMPUTED)
    sql["j12_without_model"] = on("risk", "SELECT txn_id_clean, CAST(0.5 AS DOUBLE) AS risk_score, 'MEDIUM' AS risk_band FROM risk")
    sql["j13_training_sample"] = on("risk", f"""SELECT txn_id_clean, is_fraud FROM ordered, sizes
WHERE place <= CASE WHEN is_fraud THEN fraud_rows ELSE least(n, 4000) - fraud_rows END""",
        f"""known AS (SELECT * FROM risk WHERE is_fraud IS NOT NULL),
sizes AS (SELECT count(*) AS n, least(greatest(300,
    floor(least(count(*), 4000) * (count(*) FILTER (is_fraud) / count(*)))), count(*) FILTER (is_fraud)) AS fraud_rows FROM known),
ordered AS (SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY {HASH}) AS place FROM known)""")
    sql["j18_scenario_prior"] = on("enr", """SELECT txn_id_clean, floor((least(0.003
  + CASE WHEN amount > 10000 THEN 0.03 ELSE 0 END + CASE WHEN amount > 50000 THEN 0.07 ELSE 0 END
  + CASE upper(merchant_risk_tier) WHEN 'HIGH' THEN 0.04 WHEN 'MEDIUM' THEN 0.01 ELSE 0 END
  + CASE WHEN is_emulator = 1 THEN 0.03 ELSE 0 END
  + CASE WHEN country_std <> 'IN' THEN 0.02 ELSE 0 END, 0.3)::DOUBLE) * 1e6 + 0.5) / 1e6 AS fraud_prior FROM enr""")

    # explanations
    sql["k01_rule_explanation"] = on("risk", rules("velocity amount merchant emulator rate declines"))
    sql["k02_rule_explanation_variant"] = on("risk", rules("velocity declines merchant emulator rate"))
    sql["k03_risk_assessment"] = on("scored", f"""SELECT txn_id_clean, CASE
  WHEN risk_score >= 0.6 AND is_fraud THEN {quoted(w.ASSESS_HIGH_CONFIRMED)}
  WHEN risk_score >= 0.6 AND {STRONG} <> '' THEN {filled(w.ASSESS_HIGH_FACTORS, STRONG)}
  WHEN risk_score >= 0.6 THEN {quoted(w.ASSESS_HIGH)}
  WHEN risk_score >= 0.3 AND {MODERATE} <> '' THEN {filled(w.ASSESS_MEDIUM_FACTORS, MODERATE)}
  WHEN risk_score >= 0.3 THEN {quoted(w.ASSESS_MEDIUM)}
  WHEN is_fraud THEN {quoted(w.ASSESS_LOW_CONFIRMED)} ELSE {quoted(w.ASSESS_LOW)} END AS assessment FROM scored""")

    # evaluation
    sql["l01_train_test_split"] = on("risk", """SELECT txn_id_clean, CASE WHEN place <= CASE WHEN is_fraud
    THEN fraud_train ELSE train - fraud_train END THEN 'train' ELSE 'test' END AS split FROM ordered, sizes""",
        f"""known AS (SELECT * FROM risk WHERE is_fraud IS NOT NULL),
totals AS (SELECT count(*) AS n, count(*) FILTER (is_fraud) AS f, count(*) - CAST(ceil(count(*) * 0.2) AS BIGINT) AS train FROM known),
sizes AS (SELECT train, train * f // n + CASE WHEN train * f % n > train * (n - f) % n THEN 1 ELSE 0 END AS fraud_train FROM totals),
ordered AS (SELECT *, row_number() OVER (PARTITION BY is_fraud ORDER BY {HASH}) AS place FROM known)""")
    sql["l02_classification_report"] = on("scored", """SELECT 'Legitimate' AS class_name, floor((p0) * 1e6 + 0.5) / 1e6 AS precision, floor((r0) * 1e6 + 0.5) / 1e6 AS recall,
  floor((f0) * 1e6 + 0.5) / 1e6 AS f1_score, n0 AS support FROM measures
UNION ALL SELECT 'Fraud', floor((p1) * 1e6 + 0.5) / 1e6, floor((r1) * 1e6 + 0.5) / 1e6, floor((f1) * 1e6 + 0.5) / 1e6, n1 FROM measures
UNION ALL SELECT 'accuracy', NULL, NULL, floor((accuracy) * 1e6 + 0.5) / 1e6, n0 + n1 FROM measures
UNION ALL SELECT 'macro avg', floor(((p0 + p1) / 2) * 1e6 + 0.5) / 1e6, floor(((r0 + r1) / 2) * 1e6 + 0.5) / 1e6, floor(((f0 + f1) / 2) * 1e6 + 0.5) / 1e6, n0 + n1 FROM measures
UNION ALL SELECT 'weighted avg', floor(((p0 * n0 + p1 * n1) / (n0 + n1)) * 1e6 + 0.5) / 1e6, floor(((r0 * n0 + r1 * n1) / (n0 + n1)) * 1e6 + 0.5) / 1e6,
  floor(((f0 * n0 + f1 * n1) / (n0 + n1)) * 1e6 + 0.5) / 1e6, n0 + n1 FROM measures""", CONFUSION, """
rates AS (SELECT tn + fp AS n0, tp + fn AS n1, coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
  coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
  (tn + tp) / (tn + fp + fn + tp) AS accuracy FROM cells),
measures AS (SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1 FROM rates)""")
    sql["l03_roc_auc"] = on("scored", """SELECT floor((sum(CAST(neg AS DOUBLE) * (tp - pos + pos / 2))
  / (any_value(all_pos) * any_value(all_neg))) * 1e6 + 0.5) / 1e6 AS roc_auc FROM steps""", STEPS)
    sql["l04_confusion_matrix"] = on("scored", """SELECT 'Legitimate' AS actual, 'Legitimate' AS predicted, tn AS row_count FROM cells
UNION ALL SELECT 'Legitimate', 'Fraud', fp FROM cells UNION ALL SELECT 'Fraud', 'Legitimate', fn FROM cells
UNION ALL SELECT 'Fraud', 'Fraud', tp FROM cells""", CONFUSION)
    sql["l05_roc_curve"] = on("scored", """SELECT CAST(NULL AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT floor((threshold) * 1e6 + 0.5) / 1e6, floor((fp / all_neg) * 1e6 + 0.5) / 1e6, floor((tp / all_pos) * 1e6 + 0.5) / 1e6 FROM steps
WHERE n = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg""", STEPS)
    sql["l06_precision_recall_curve"] = on("scored", """SELECT floor((threshold) * 1e6 + 0.5) / 1e6 AS threshold, floor((tp / (tp + fp)) * 1e6 + 0.5) / 1e6 AS precision,
  floor((tp / all_pos) * 1e6 + 0.5) / 1e6 AS recall FROM steps UNION ALL SELECT NULL, 1.0, 0.0""", STEPS)
    sql["l06_best_f1"] = on("scored", """SELECT floor((threshold) * 1e6 + 0.5) / 1e6 AS best_threshold, floor((f1) * 1e6 + 0.5) / 1e6 AS best_f1,
  floor((p) * 1e6 + 0.5) / 1e6 AS precision_at_best, floor((r) * 1e6 + 0.5) / 1e6 AS recall_at_best
FROM (SELECT *, 2 * p * r / (p + r) AS f1 FROM (SELECT threshold, tp / (tp + fp) AS p, tp / all_pos AS r FROM steps WHERE tp > 0))
ORDER BY f1 DESC, threshold LIMIT 1""", STEPS)
    sql["l07_band_performance"] = on("scored", """SELECT risk_band, count(is_fraud) AS total, count(*) FILTER (is_fraud) AS fraud_count,
  round_even(count(*) FILTER (is_fraud) / nullif(count(is_fraud), 0), 4) AS fraud_rate,
  round_even(avg(risk_score), 4) AS avg_risk_score FROM scored GROUP BY risk_band""")
    sql["l08_score_histogram"] = on("scored", "", bins("risk_score", "class_name", "scored", "true", False))
    sql["l09_score_boxes"] = on("scored", "", boxes("risk_score", "class_name", "scored", "true"))
    sql["l10_score_description"] = on("scored", """SELECT count(risk_score) AS count, floor((avg(risk_score)) * 1e6 + 0.5) / 1e6 AS mean,
  floor((stddev_samp(risk_score)) * 1e6 + 0.5) / 1e6 AS std, floor((min(risk_score)) * 1e6 + 0.5) / 1e6 AS min, floor((quantile_cont(risk_score, 0.25)) * 1e6 + 0.5) / 1e6 AS q1,
  floor((quantile_cont(risk_score, 0.5)) * 1e6 + 0.5) / 1e6 AS median, floor((quantile_cont(risk_score, 0.75)) * 1e6 + 0.5) / 1e6 AS q3,
  floor((max(risk_score)) * 1e6 + 0.5) / 1e6 AS max FROM scored""")
    sql["l11_fraud_rate"] = on("risk", """SELECT count(*) AS row_count, count(*) FILTER (is_fraud) AS fraud_count,
  count(*) FILTER (NOT is_fraud) AS legitimate_count,
  floor((count(*) FILTER (is_fraud) / count(is_fraud) * 100) * 1e6 + 0.5) / 1e6 AS fraud_rate_pct FROM risk""")

    # profiling and concentration
    keys = ["txn_id_clean", "txn_ts", "amount", "is_fraud", "txns_last_24h", "amt_last_24h", "distinct_merchants_last_24h",
            "card_txn_count_30d", "card_fraud_rate_30d", "merchant_txn_count_30d", "merchant_fraud_rate_30d"]
    sql["m01_table_profile"] = on("risk", "SELECT 'rows' AS metric, count(*) AS metric_value FROM risk UNION ALL "
        f"SELECT 'columns', CAST({len(risk_columns())} AS BIGINT)" + "".join(
            f" UNION ALL SELECT 'has {k}', CAST(1 AS BIGINT)" for k in keys))
    sql["m02_label_distribution"] = on("risk", """SELECT CASE WHEN is_fraud THEN 'Fraud' WHEN NOT is_fraud THEN 'Non-Fraud'
  ELSE 'Unknown' END AS label, count(*) AS row_count,
  round_even(count(*) / (SELECT count(*) FROM risk) * 100, 2) AS row_pct FROM risk GROUP BY 1""")
    sql["m04_most_missing"] = on("risk", """SELECT column_name, null_count, round_even(null_count / row_count * 100, 2) AS null_pct
FROM missing WHERE null_count > 0 ORDER BY null_count DESC, column_name LIMIT 10""",
        f"missing AS ({missing(risk_columns(), 'risk')})")
    signals = {
        "velocity": ("txns_last_24h", "txns_last_24h IS NOT NULL"), "amount_ratio": ("amount_vs_card_avg", "amount_vs_card_avg < 10"),
        "merchant_rate": ("merchant_fraud_rate_30d", "merchant_fraud_rate_30d IS NOT NULL"),
    }
    for name, (value, where) in signals.items():
        sql[f"m05_sample_{name}"] = on("risk", "", signal_sample(value, where))
    sql["m06_velocity_boxes"] = on("risk", "", boxes("txns_last_24h", "transaction_type", "risk", "true"))
    sql["m06_merchant_rate_boxes"] = on(
        "risk", "", boxes("merchant_fraud_rate_30d", "transaction_type", "risk", "true"))
    sql["m07_amount_ratio_histogram"] = on(
        "risk", "", bins("amount_vs_card_avg", "transaction_type", "risk", "amount_vs_card_avg < 10", True))
    sql["m08_merchant_totals"] = on("risk", """SELECT merchant_id_clean, total_txns, total_fraud_txns,
  floor((fraud_rate) * 1e6 + 0.5) / 1e6 AS fraud_rate FROM merchant_totals""", PARETO)
    sql["m09_pareto"] = on("risk", f"SELECT {PARETO_COLUMNS} FROM pareto", PARETO)
    sql["m10_top_merchants"] = on("risk", f"SELECT {PARETO_COLUMNS} FROM pareto WHERE merchant_rank <= 20", PARETO)
    sql["m10_top_share"] = on("risk", """SELECT CAST(sum(total_fraud_txns) FILTER (merchant_rank <= 20) AS BIGINT) AS top_fraud_txns,
  floor((sum(total_fraud_txns) FILTER (merchant_rank <= 20) / sum(total_fraud_txns) * 100) * 1e6 + 0.5) / 1e6 AS top_fraud_pct FROM pareto""", PARETO)
    sql["m11_concentration"] = on("risk", """SELECT count(*) AS merchants, count(*) FILTER (cumulative_fraud_pct <= 80) AS p80_merchants,
  max(merchant_rank) FILTER (cumulative_fraud_pct <= 80) AS p80_rank,
  floor((max(cumulative_fraud_pct) FILTER (cumulative_fraud_pct <= 80)) * 1e6 + 0.5) / 1e6 AS p80_share_pct,
  floor((count(*) FILTER (cumulative_fraud_pct <= 80) / count(*) * 100) * 1e6 + 0.5) / 1e6 AS p80_merchant_pct,
  floor((max(cumulative_fraud_pct) FILTER (merchant_rank <= 10)) * 1e6 + 0.5) / 1e6 AS top_10_pct,
  floor((max(cumulative_fraud_pct) FILTER (merchant_rank <= 50)) * 1e6 + 0.5) / 1e6 AS top_50_pct FROM pareto""", PARETO)

    # quality checks
    sql["n01_row_parity"] = on("feat", """SELECT (SELECT count(*) FROM enr) AS rows_before, count(*) AS rows_after,
  abs((SELECT count(*) FROM enr) - count(*)) AS difference, (SELECT count(*) FROM enr) = count(*) AS rows_match FROM feat""")
    sql["n03_null_rates"] = on("feat", """SELECT column_name, row_count, null_count, round_even(null_count / row_count * 100, 1) AS null_pct,
  CASE WHEN null_count / row_count * 100 < 50 THEN 'OK' ELSE 'WARN' END AS status FROM missing""",
        f"missing AS ({missing(CARD_ACTIVITY, 'feat')})")

    def mean(column: str) -> str:
        return f"floor((CAST(sum({column}) AS DOUBLE) / count({column})) * 1e6 + 0.5) / 1e6 AS avg_{column}"

    sql["n04_card_activity_statistics"] = on("feat", f"""SELECT count(*) AS row_count, {mean('txns_last_24h')},
  max(txns_last_24h) AS max_txns_last_24h, {mean('amt_last_24h')}, {mean('amount_vs_card_avg')},
  {mean('distinct_merchants_last_24h')} FROM feat WHERE txn_ts IS NOT NULL""")
    sql["n05_risk_history_statistics"] = on("risk", f"""SELECT count(*) AS row_count, {mean('card_txn_count_30d')},
  max(card_txn_count_30d) AS max_card_txn_count_30d, {mean('card_fraud_rate_30d')}, {mean('merchant_txn_count_30d')},
  {mean('merchant_fraud_rate_30d')} FROM risk WHERE txn_ts IS NOT NULL""")
    sql["n06_recent_slice_parity"] = on("feat", """SELECT count(*) AS rows_before, count(*) AS rows_after,
  CAST(0 AS BIGINT) AS difference, true AS rows_match FROM recent""", _recent("feat"))
    sql["n07_first_rows"] = on("feat", f"""SELECT txn_id_clean, {show(['amount', *CARD_ACTIVITY])}, is_fraud FROM (
  SELECT * FROM feat WHERE txn_ts IS NOT NULL ORDER BY txn_id_clean LIMIT 10)""")
    sql["n07_newest_rows"] = on("risk", f"""SELECT txn_id_clean, {show(['txn_date', *RISK_HISTORY])}, is_fraud FROM (
  SELECT * FROM risk WHERE txn_ts IS NOT NULL ORDER BY txn_ts DESC, txn_id_clean LIMIT 10)""")
    return sql
