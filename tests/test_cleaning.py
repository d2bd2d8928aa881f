import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tollgate.functions import cleaning as c
from tollgate.functions import formatting as fmt
from tollgate.operators.staging import stage_transactions
from tollgate.schemas import RAW_COLUMNS, raw_schema, staged_columns


def apply(spark, expression, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [row[1] for row in df.select("i", expression(F.col("x"))).orderBy("i").collect()]


def test_blank_to_null_strips_spaces_only(spark):
    assert apply(spark, c.blank_to_null, ["  a ", "", "   ", None, "\tb"]) == ["a", None, None, None, "\tb"]


def test_amount_accepts_plain_decimals_only(spark):
    values = ["12.50", "-3", "1e3", "+5", "abc", "99999999999.99", ".5", "5.", "7.005", None]
    assert apply(spark, c.parse_amount, values) == [
        Decimal("12.50"), Decimal("-3.00"), None, None, None, None, None, None, Decimal("7.01"), None,
    ]


def test_timestamp_allows_one_digit_parts(spark):
    values = ["2024-01-05 03:04:05", "2024-1-5 3:4:5", "2024-13-01 00:00:00", "2024-01-05", "2024-01-05 03:04:05x",
              "2024-02-30 00:00:00", "not-a-date", None]
    moment = dt.datetime(2024, 1, 5, 3, 4, 5)
    assert apply(spark, c.parse_timestamp, values) == [moment, moment, None, None, None, None, None, None]


def test_timestamp_does_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist on that day in New York.
        assert apply(spark, c.parse_timestamp, ["2024-03-10 02:30:00"]) == [dt.datetime(2024, 3, 10, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_flags_are_tri_state(spark):
    assert apply(spark, c.parse_flag, ["YES", "y", "True", "1", "0", "No", "n", "FALSE", "maybe", None]) == [
        True, True, True, True, False, False, False, False, None, None,
    ]


def test_emulator_spellings_differ_from_flags(spark):
    assert apply(spark, c.parse_emulator, ["1", "true", "Yes", "0", "No", "y", "n", "tRue", None]) == [
        1, 1, 1, 0, 0, None, None, None, None,
    ]


def test_country_counts_bytes(spark):
    assert apply(spark, c.standardise_country, ["us", "USA", "é", "日", None]) == ["US", "OTHER", "É", "OTHER", None]


def test_channel_synonyms(spark):
    standard = lambda x: c.standardise(x, c.CHANNEL_SYNONYMS)
    assert apply(spark, standard, ["online", "App", "point_of_sale", "API", "kiosk", None]) == [
        "WEB", "MOBILE", "POS", "API", "OTHER", None,
    ]


def test_stage_layout_and_null_flags(spark):
    empty = dict.fromkeys(RAW_COLUMNS["raw_transactions"])
    staged = stage_transactions(spark.createDataFrame([tuple(empty.values())], raw_schema("raw_transactions")))
    assert staged.columns == staged_columns() and len(staged.columns) == 31
    row = staged.first()
    assert row["is_fraud"] is None and row["txn_date"] is None
    assert [row[c] for c in ("is_declined", "is_zero_amount", "is_negative_amt", "is_high_amount")] == [False] * 4


@pytest.mark.parametrize("value,digits,text", [
    (0.125, 2, "0.12"), (2.5, 0, "2"), (1234.5, 1, "1234.5"), (-0.001, 2, "-0.00"), (-1.25, 1, "-1.2"), (None, 1, None),
])
def test_fixed_rounds_half_to_even(spark, value, digits, text):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(fmt.fixed(F.col("x"), digits)).first()[0] == text


def test_currency_and_score_text(spark):
    df = spark.createDataFrame([(Decimal("1234567.50"), 70.0), (Decimal("-5.00"), 69.96), (None, None)],
                               "a decimal(12,2), s double")
    rows = df.select(fmt.currency(F.col("a")), fmt.score_text(F.col("s"))).collect()
    assert [tuple(r) for r in rows] == [
        ("$1,234,567.50", "70.0 (🔴 High)"), ("$-5.00", "70.0 (🟡 Medium)"), ("N/A", "N/A"),
    ]
