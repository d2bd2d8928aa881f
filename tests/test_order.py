"""Queries whose order is part of their meaning, read in the order Spark gives."""

import hashlib

import pytest

import __spark_entry__ as contract

QUERIES = contract.queries()


def digest(text):
    return hashlib.md5(text.encode()).hexdigest()


def falling(value):
    """Largest first, missing last."""
    return (value is None, -(value or 0))


ORDERS = {
    "f06_shuffled_extract": lambda r: digest(f"{r['txn_id_clean'] or ''}|43"),
    "g04_overview_order": lambda r: falling(r["risk_score"]),
    "h01_fraud_trends": lambda r: r["date"] or "",
    "h02_by_country": lambda r: falling(r["fraud_rate"]),
    "h03_top_merchants": lambda r: -r["fraud_count"],
    "h04_top_cards": lambda r: -r["fraud_count"],
    "h06_by_channel": lambda r: falling(r["fraud_rate"]),
    "h07_by_hour": lambda r: -1 if r["hour"] is None else r["hour"],
    "m10_top_merchants": lambda r: r["merchant_rank"],
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_rows_come_in_order(spark, sf_dir, name):
    keys = [ORDERS[name](row.asDict()) for row in QUERIES[name](spark, sf_dir).collect()]
    assert len(keys) > 1 and keys == sorted(keys)
