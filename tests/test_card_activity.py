import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from tollgate.operators.card_activity import add_card_activity, card_moments
from tollgate.schemas import CARD_ACTIVITY

LAYOUT = ("txn_id_clean string, card_id_clean string, merchant_id_clean string, txn_ts timestamp_ntz, "
          "amount decimal(12,2), is_declined boolean")
START = dt.datetime(2024, 1, 1)
HOUR, DAY = dt.timedelta(hours=1), dt.timedelta(hours=24)


def row(i, card, merchant, seconds, amount="1.00", declined=False):
    time = None if seconds is None else START + dt.timedelta(seconds=seconds)
    return (f"t{i}", card, merchant, time, None if amount is None else Decimal(amount), declined)


def features(spark, rows):
    df = add_card_activity(spark.createDataFrame(rows, LAYOUT))
    assert df.count() == len(rows)
    return {r["txn_id_clean"]: {c: r[c] for c in CARD_ACTIVITY} for r in df.collect()}


def by_hand(rows):
    """The definition, row by row."""
    first = {}
    for _, card, merchant, time, _, _ in rows:
        if card is not None and merchant is not None and time is not None:
            key = (card, merchant)
            first[key] = min(first.get(key, time), time)
    out = {}
    for i, card, _, time, amount, _ in rows:
        mine = [r for r in rows if r[1] == card]
        known = [r[4] for r in mine if r[4] is not None]
        average = float(sum(known)) / len(known) if known else None
        got = dict.fromkeys(CARD_ACTIVITY)
        if amount is not None and average:
            got["amount_vs_card_avg"] = round(float(amount) / average, 6)
        if time is not None:
            day = [r for r in mine if r[3] is not None and time - DAY <= r[3] <= time]
            got["txns_last_1h"] = len([r for r in day if r[3] >= time - HOUR])
            got["txns_last_24h"] = len(day)
            got["amt_last_24h"] = sum((r[4] for r in day if r[4] is not None), Decimal(0))
            got["declined_txns_last_24h"] = len([r for r in day if r[5]])
            seen = [t for (c, _), t in first.items() if c == card and time - DAY <= t <= time]
            if card is not None and seen:
                latest = max(seen)
                got["distinct_merchants_last_24h"] = len(
                    [t for (c, _), t in first.items() if c == card and latest - DAY <= t <= latest])
        out[i] = got
    return out


def test_frame_edges_are_inclusive(spark):
    got = features(spark, [row(1, "c", "m", 0), row(2, "c", "m", 86_400), row(3, "c", "m", 86_401), row(4, "c", "m", 90_001)])
    assert [got[f"t{i}"]["txns_last_24h"] for i in (1, 2, 3, 4)] == [1, 2, 2, 3]
    assert [got[f"t{i}"]["txns_last_1h"] for i in (1, 2, 3, 4)] == [1, 1, 2, 2]


def test_ties_count_each_other(spark):
    got = features(spark, [row(1, "c", "m", 5), row(2, "c", "m", 5)])
    assert [got[t]["txns_last_1h"] for t in ("t1", "t2")] == [2, 2]


def test_distinct_merchants_looks_back_to_the_latest_first_sighting(spark):
    got = features(spark, [row(1, "c", "A", 0), row(2, "c", "A", 25 * 3600), row(3, "c", "B", 26 * 3600)])
    assert [got[t]["distinct_merchants_last_24h"] for t in ("t1", "t2", "t3")] == [1, None, 1]


def test_look_back_of_two_days_crosses_a_slice_edge(spark):
    # Slices start on Thursdays (1970-01-01); 2024-01-04 is one.
    edge = 3 * 86_400
    rows = [row(1, "c", "A", edge - 40 * 3600), row(2, "c", "B", edge - 20 * 3600), row(3, "c", "B", edge + 3600)]
    assert features(spark, rows) == by_hand(rows)
    assert features(spark, rows)["t3"]["distinct_merchants_last_24h"] == 2


def test_missing_card_and_missing_time(spark):
    got = features(spark, [row(1, None, "m", 9), row(2, None, "m", 9), row(3, "c", "m", None, "4.00"), row(4, "c", "m", 1, "2.00")])
    assert [got[t]["txns_last_24h"] for t in ("t1", "t2")] == [2, 2]
    assert got["t1"]["distinct_merchants_last_24h"] is None
    assert got["t3"] == {**dict.fromkeys(CARD_ACTIVITY), "amount_vs_card_avg": round(4 / 3, 6)}
    assert got["t4"]["txns_last_24h"] == 1


def test_zero_average_has_no_ratio(spark):
    got = features(spark, [row(1, "c", "m", 1, "5.00"), row(2, "c", "m", 2, "-5.00"), row(3, "d", "m", 2, None)])
    assert [got[t]["amount_vs_card_avg"] for t in ("t1", "t2", "t3")] == [None, None, None]
    assert got["t3"]["amt_last_24h"] == 0


def test_random_rows_match_the_definition_with_a_hot_card(spark):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        card = "hot" if i % 3 == 0 else rng.choice(["a", "b", None])
        seconds = None if rng.random() < 0.03 else rng.choice([rng.randrange(40 * 86_400), rng.randrange(20) * 43_200])
        amount = None if rng.random() < 0.1 else f"{rng.randrange(-500, 90_000) / 100:.2f}"
        merchant = rng.choice(["m1", "m2", "m3", f"n{i % 40}", None])
        rows.append(row(i, card, merchant, seconds, amount, rng.random() < 0.3))
    expected = by_hand(rows)
    assert features(spark, rows) == expected
    rng.shuffle(rows)
    assert features(spark, rows) == expected


def test_copies_of_one_moment_are_added_up_before_the_shuffle(spark):
    df = spark.range(5_000).select(
        F.concat(F.lit("t"), "id").alias("txn_id_clean"), F.lit("hot").alias("card_id_clean"),
        F.lit("m").alias("merchant_id_clean"), F.lit(START).cast("timestamp_ntz").alias("txn_ts"),
        F.lit(Decimal("1.10")).cast("decimal(12,2)").alias("amount"), (F.col("id") % 2 == 0).alias("is_declined"),
    )
    assert card_moments(df).count() == 1
    out = add_card_activity(df).select("txns_last_24h", "amt_last_24h", "declined_txns_last_24h").distinct().collect()
    assert [tuple(r) for r in out] == [(5000, Decimal("5500.00"), 2500)]


def test_no_window_is_partitioned_by_card_alone(spark):
    df = spark.createDataFrame([row(1, "c", "m", 0)], LAYOUT)
    plan = add_card_activity(df)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if line.strip(" +-:").startswith("Window")]
    assert windows and all("slice" in line for line in windows)
