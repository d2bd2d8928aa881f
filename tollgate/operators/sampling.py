"""Exact, repeatable samples: the first n rows of each stratum in the order of a hashed key.

The hash is md5 of the key and a seed, so a rerun, another cluster size or another
engine picks the same rows. No stratum is sorted as a whole. Counts per hash prefix say
in which prefix the n-th row lies; where many rows lie there, longer prefixes inside it
are counted, at last of a hash of all columns, which parts rows that share a key or
have none. The counts are a few thousand numbers, and the edges they give, one per
stratum, are plain filters: one pass decides all rows, and only the few rows on an edge
are put in order. Exact copies are counted, not sorted, so copies cannot pile up in one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hash digits counted at a time: of the key's hash, then of the hash of all columns.
LEVELS = [("_key", 3), ("_key", 7), ("_all", 3), ("_all", 7)]
KEY_DIGITS = 7
#: An edge piece with at most so many rows is put in order as it is.
ORDERED_ROWS = 10_000
COPIES_PER_CHUNK = 100_000

Counts = dict[object, int]


def hash_order(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.coalesce(F.col(key), F.lit("")), F.lit(f"|{seed}")))


def class_counts(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Fraud, non-fraud and all rows (unknown labels included), as one row."""
    return df.agg(
        F.count_if(F.col(label)).alias("fraud_count"),
        F.count_if(~F.col(label)).alias("non_fraud_count"),
        F.count(F.lit(1)).alias("total_count"),
    )


@dataclass
class _Edge:
    """Where a stratum's last taken row lies: hash prefixes, and how many rows to take inside them."""

    take: int
    rows: int = 0
    prefixes: tuple[tuple[str, str], ...] = ()


def split_by_quota(df: DataFrame, quotas: Callable[[Counts], Counts], stratum: str, key: str = "txn_id_clean",
                   seed: int = 42) -> DataFrame:
    """Add ``taken``: true for exactly the quota of rows of each stratum (all, if it has fewer).

    ``quotas`` gets the rows per stratum (a handful of values) and gives the rows to take.
    Rows of a stratum without a quota are not taken. The order is the first digits of the key's hash, then the hash of
    all columns.
    """
    columns = df.columns
    everything = F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
    hashed = df.withColumns({"_key": F.substring(hash_order(key, seed), 1, KEY_DIGITS), "_all": everything})
    pieces = _counted(hashed, stratum, *LEVELS[0])
    totals: Counts = {}
    for value, _, rows in pieces:
        totals[value] = totals.get(value, 0) + rows
    takes = {value: min(take, totals.get(value, 0)) for value, take in quotas(totals).items()}
    edges = {value: _Edge(take, totals[value]) for value, take in takes.items() if 0 < take < totals[value]}
    _move_edges(edges, pieces, LEVELS[0][0])
    for name, digits in LEVELS[1:]:
        wide = {value: edge for value, edge in edges.items() if edge.rows > ORDERED_ROWS}
        if not wide:
            break
        inside = hashed.where(_any(F.col(stratum).eqNullSafe(value) & _on_edge(edge) for value, edge in wide.items()))
        _move_edges(wide, _counted(inside, stratum, name, digits), name)

    whole = [value for value, take in takes.items() if take == totals.get(value, 0)]
    taken, on_edge = _any(F.col(stratum).eqNullSafe(value) for value in whole), F.lit(False)
    for value, edge in edges.items():
        here = F.col(stratum).eqNullSafe(value)
        taken = taken | (here & _before(edge))
        on_edge = on_edge | (here & _on_edge(edge))
    clear = hashed.where(~on_edge).withColumn("taken", taken)
    if not edges:
        return clear.select(*columns, "taken")

    need = F.coalesce(*[F.when(F.col(stratum).eqNullSafe(value), F.lit(edge.take)) for value, edge in edges.items()])
    copies = hashed.where(on_edge).groupBy(*columns, "_key", "_all").agg(F.count(F.lit(1)).alias("_copies"))
    others = [F.col(c).asc_nulls_first() for c in columns if c != stratum]
    ahead = Window.partitionBy(stratum).orderBy("_key", "_all", *others).rowsBetween(Window.unboundedPreceding, -1)
    room = need - F.coalesce(F.sum("_copies").over(ahead), F.lit(0))
    count = F.greatest(F.least(F.col("_copies"), room), F.lit(0))
    parts = F.array(
        F.struct(F.lit(True).alias("taken"), count.alias("_n")),
        F.struct(F.lit(False).alias("taken"), (F.col("_copies") - count).alias("_n")),
    )
    ranked = copies.withColumn("_parts", parts).select(*columns, F.inline("_parts")).where("_n > 0")
    return clear.select(*columns, "taken").unionByName(_unfold(ranked).select(*columns, "taken"))


def _any(conditions) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out


def _counted(df: DataFrame, stratum: str, name: str, digits: int) -> list[tuple]:
    """Rows per stratum and hash prefix, in order: 16^3 or 16^4 numbers for each of a handful of strata."""
    found = df.groupBy(stratum, F.substring(name, 1, digits).alias("_piece")).agg(F.count(F.lit(1)).alias("_rows"))
    return sorted((tuple(row) for row in found.collect()), key=lambda row: row[1])


def _move_edges(edges: dict[object, _Edge], pieces: list[tuple], name: str) -> None:
    """Narrow each edge to the prefix that holds its last taken row."""
    for value, edge in edges.items():
        seen = 0
        for _, piece, rows in (p for p in pieces if p[0] == value):
            if seen + rows >= edge.take:
                earlier = tuple(p for p in edge.prefixes if p[0] != name)
                edge.prefixes, edge.take, edge.rows = (*earlier, (name, piece)), edge.take - seen, rows
                break
            seen += rows


def _on_edge(edge: _Edge) -> Column:
    out = F.lit(True)
    for name, prefix in edge.prefixes:
        out = out & F.col(name).startswith(prefix)
    return out


def _before(edge: _Edge) -> Column:
    """Rows ahead of the edge piece."""
    out, same = F.lit(False), F.lit(True)
    for name, prefix in edge.prefixes:
        out = out | (same & (F.substring(name, 1, len(prefix)) < prefix))
        same = same & F.col(name).startswith(prefix)
    return out


def _unfold(df: DataFrame) -> DataFrame:
    """Repeat each row ``_n`` times, in chunks that can be spread over tasks."""
    size = F.lit(COPIES_PER_CHUNK)
    start = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, size.cast("bigint")))
    chunks = df.withColumn("_start", start)
    count = F.least(F.col("_n") - F.col("_start"), size)
    return chunks.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), count)))


def budgeted_sample(df: DataFrame, target_rows: int, label: str = "is_fraud", seed: int = 42) -> DataFrame:
    """All fraud rows plus non-fraud rows up to ``target_rows``; unknown labels are left out."""
    def quotas(rows: Counts) -> Counts:
        fraud = rows.get(True, 0)
        return {True: fraud, False: max(target_rows - fraud, 0)}

    split = split_by_quota(df.where(F.col(label).isNotNull()), quotas, label, seed=seed)
    return split.where("taken").drop("taken")


def sample_budget(target_rows: int) -> Column:
    """Non-fraud rows to take, from the columns of ``class_counts``."""
    room = F.greatest(F.lit(target_rows) - F.col("fraud_count"), F.lit(0))
    return F.least(room, F.col("non_fraud_count"))


def proportional_sample(df: DataFrame, rows: int, label: str = "is_fraud", seed: int = 42) -> DataFrame:
    """``rows`` labelled rows that keep the class ratio; the fraud share is rounded down."""
    def quotas(counts: Counts) -> Counts:
        total = counts.get(True, 0) + counts.get(False, 0)
        fraud = math.floor(rows * (counts.get(True, 0) / total)) if total else 0
        return {True: fraud, False: rows - fraud}

    split = split_by_quota(df.where(F.col(label).isNotNull()), quotas, label, seed=seed)
    return split.where("taken").drop("taken")


def train_test_split(df: DataFrame, test_share: float = 0.2, label: str = "is_fraud", seed: int = 42) -> DataFrame:
    """Add ``split`` (train or test), stratified by label; unknown labels are left out.

    The test part is the ceiling of its share. Training rows go to the classes in
    proportion, a left-over row to the class with the larger remainder.
    """
    def quotas(counts: Counts) -> Counts:
        fraud, other = counts.get(True, 0), counts.get(False, 0)
        total = fraud + other
        if not total:
            return {}
        train = total - math.ceil(total * test_share)
        more = train * fraud % total > train * other % total
        fraud_train = train * fraud // total + more
        return {True: fraud_train, False: train - fraud_train}

    split = split_by_quota(df.where(F.col(label).isNotNull()), quotas, label, seed=seed)
    return split.select(*df.columns, F.when(F.col("taken"), "train").otherwise("test").alias("split"))


def training_sample(df: DataFrame, max_rows: int = 100_000, min_fraud: int = 1_000, label: str = "is_fraud",
                    seed: int = 42) -> DataFrame:
    """Labelled rows to fit a model on: all of them, or a class-proportional sample of ``max_rows``.

    The sample has at least ``min_fraud`` fraud rows if there are that many.
    """
    def quotas(counts: Counts) -> Counts:
        fraud, total = counts.get(True, 0), counts.get(True, 0) + counts.get(False, 0)
        size = min(total, max_rows)
        taken = min(max(min_fraud, math.floor(size * (fraud / total))), fraud) if total else 0
        return {True: taken, False: size - taken}

    split = split_by_quota(df.where(F.col(label).isNotNull()), quotas, label, seed=seed)
    return split.where("taken").drop("taken")
