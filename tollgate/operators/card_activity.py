"""Card features over trailing hours, built to hold when one card has a third of all rows.

A range window per card would put a busy card (or all rows without a card) into one
task and re-add its whole frame for every row. Instead:

1. rows are added up per (card, second) before the shuffle, so a card has at most
   86,400 rows a day however many transactions it has;
2. each card's timeline is cut into week slices, and the last two days of a slice are
   repeated in the next one, because a look-back reaches at most 24 h + 24 h;
3. inside a slice every moment enters the totals once and leaves them after the frame
   length, so one running sum gives every frame in linear time;
4. the result is joined back to the rows by (card, time).

Frames are closed on both ends: a row exactly 24 h old still counts, rows with the same
time count each other. Rows without a card form one group, as NULLs do in a window.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tollgate.schemas import CARD_ACTIVITY

SLICE_DAYS = 7
LOOKBACK_DAYS = 2

CARD = "card_id_clean"
TIME = "txn_ts"


def first_sightings(df: DataFrame) -> DataFrame:
    """When each card was first seen at each merchant."""
    known = df.where(
        F.col(CARD).isNotNull() & F.col("merchant_id_clean").isNotNull() & F.col(TIME).isNotNull()
    )
    return known.groupBy(CARD, "merchant_id_clean").agg(F.min(TIME).alias("first_seen_ts"))


def card_moments(df: DataFrame) -> DataFrame:
    """One row per (card, time) with everything that happened then."""
    # Whole cents in a bigint keep sums exact and cheap; an overflow would raise, not wrap.
    cents = (F.col("amount") * 100).cast("bigint")
    visits = df.select(
        CARD, TIME, F.coalesce(cents, F.lit(0)).alias("cents"), F.lit(1).alias("txns"),
        F.col("is_declined").cast("int").alias("declined"), F.lit(0).alias("new_merchants"),
    )
    sightings = first_sightings(df).select(
        CARD, F.col("first_seen_ts").alias(TIME), F.lit(0).cast("bigint").alias("cents"),
        F.lit(0).alias("txns"), F.lit(0).alias("declined"), F.lit(1).alias("new_merchants"),
    )
    return visits.unionByName(sightings).groupBy(CARD, TIME).agg(
        F.sum("txns").alias("txns"),
        F.sum("cents").alias("cents"),
        F.sum("declined").alias("declined"),
        F.sum("new_merchants").alias("new_merchants"),
    )


def _cut_into_slices(moments: DataFrame) -> DataFrame:
    day = F.datediff(F.to_date(TIME), F.lit("1970-01-01").cast("date"))
    home = F.floor(day / SLICE_DAYS)
    near_end = F.pmod(day, F.lit(SLICE_DAYS)) >= SLICE_DAYS - LOOKBACK_DAYS
    slices = F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))
    return moments.withColumn("home", home).withColumn("slice", F.explode(slices))


def _enter_and_leave(sliced: DataFrame) -> DataFrame:
    """Each moment as three changes to the running totals."""
    none = F.lit(0)

    def change(at, leaving, hour, sign):
        return F.struct(
            at.alias("at"), F.lit(leaving).alias("leaving"), hour.alias("hour_txns"),
            (F.col("txns") * sign).alias("day_txns"), (F.col("cents") * sign).alias("day_cents"),
            (F.col("declined") * sign).alias("day_declined"),
            (F.col("new_merchants") * sign).alias("day_new"),
        )

    time, txns = F.col(TIME), F.col("txns")
    changes = F.array(
        change(time, 0, txns, 1),
        change(time + F.expr("INTERVAL '1' HOUR"), 1, -txns, 0),
        change(time + F.expr("INTERVAL '24' HOUR"), 1, none.cast("bigint"), -1),
    )
    return sliced.select(CARD, "slice", "home", F.inline(changes))


def card_timeline(df: DataFrame) -> DataFrame:
    """Trailing totals per (card, time): counts, amount, declines, newly met merchants."""
    # Spread by (card, slice) first: unfolding keeps that layout, so three times the
    # rows are never shuffled.
    sliced = card_moments(df).transform(_cut_into_slices).repartition(CARD, "slice")
    changes = _enter_and_leave(sliced)
    so_far = (
        Window.partitionBy(CARD, "slice").orderBy("at", "leaving")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = changes.select(
        CARD, "slice", "home", "at", "leaving", "day_new",
        F.sum("hour_txns").over(so_far).alias("txns_last_1h"),
        F.sum("day_txns").over(so_far).alias("txns_last_24h"),
        F.sum("day_cents").over(so_far).alias("cents_last_24h"),
        F.sum("day_declined").over(so_far).alias("declined_txns_last_24h"),
        F.sum("day_new").over(so_far).alias("new_merchants_24h"),
    )
    # The distinct-merchant feature reads the count at the latest first sighting.
    is_sighting = (F.col("leaving") == 0) & (F.col("day_new") > 0)
    latest = F.last(
        F.when(is_sighting, F.struct("at", F.col("new_merchants_24h").alias("merchants"))), ignorenulls=True
    ).over(so_far)
    found = totals.withColumn("latest", latest).where(
        (F.col("leaving") == 0) & F.col("slice").eqNullSafe(F.col("home"))
    )
    fresh = F.col("latest.at") >= F.col("at") - F.expr("INTERVAL '24' HOUR")
    timed = F.col("at").isNotNull()
    amount = (F.col("cents_last_24h").cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast("decimal(22,2)")
    return found.select(
        CARD,
        F.col("at").alias(TIME),
        F.when(timed, F.col("txns_last_1h")).alias("txns_last_1h"),
        F.when(timed, F.col("txns_last_24h")).alias("txns_last_24h"),
        F.when(timed, amount).alias("amt_last_24h"),
        F.when(timed, F.col("declined_txns_last_24h")).alias("declined_txns_last_24h"),
        F.when(timed & F.col(CARD).isNotNull() & fresh, F.col("latest.merchants")).alias("distinct_merchants_last_24h"),
    )


def card_averages(df: DataFrame) -> DataFrame:
    """Whole-history average amount per card."""
    average = F.sum("amount").cast("double") / F.count("amount")
    return df.groupBy(CARD).agg(F.nullif(average, F.lit(0.0)).alias("card_average"))


def join_same_card_and_time(df: DataFrame, facts: DataFrame) -> DataFrame:
    """Left join on (card, time) where NULL matches NULL; ``facts`` has one row per pair."""
    keyed = facts.withColumnsRenamed({CARD: "_card", TIME: "_time"})
    same = F.col(CARD).eqNullSafe(F.col("_card")) & F.col(TIME).eqNullSafe(F.col("_time"))
    return df.join(keyed, same, "left").drop("_card", "_time")


def with_averages(timeline: DataFrame, df: DataFrame) -> DataFrame:
    averages = card_averages(df).withColumnRenamed(CARD, "_card")
    return timeline.join(averages, F.col(CARD).eqNullSafe(F.col("_card")), "left").drop("_card")


def amount_ratio():
    """Amount over the card's average, at the six decimals a DECIMAL(12,2) division keeps."""
    return F.round(F.col("amount").cast("double") / F.col("card_average"), 6)


def add_card_activity(df: DataFrame) -> DataFrame:
    """The six card features, one output row per input row."""
    facts = with_averages(card_timeline(df), df)
    joined = join_same_card_and_time(df, facts).withColumn("amount_vs_card_avg", amount_ratio())
    return joined.select(*df.columns, *CARD_ACTIVITY)


def add_card_activity_to_sample(df: DataFrame, card_share: float, seed: int = 42) -> DataFrame:
    """The same features on a share of the cards, chosen by hash: a pre-flight build.

    Cards are taken whole, so their features are those of the full build; rows without a card count as one card.
    """
    place = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(CARD), F.lit("")), F.lit(f"|{seed}"))), 1, 7), 16, 10)
    return add_card_activity(df.where(place.cast("bigint") < F.lit(round(card_share * 16**7))))
