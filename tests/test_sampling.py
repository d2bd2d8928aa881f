import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tollgate.operators import extract, sampling
from tollgate.schemas import EXTRACT_COLUMNS


def labelled(spark, fraud, other, unknown=0):
    rows = [(f"t{i}", True) for i in range(fraud)] + [(f"u{i}", False) for i in range(other)]
    rows += [(f"v{i}", None) for i in range(unknown)]
    return spark.createDataFrame(rows, "txn_id_clean string, is_fraud boolean")


def quota(*pairs):
    return lambda counts: dict(pairs)


def test_takes_the_first_rows_in_hash_order(spark):
    df = labelled(spark, 40, 200)
    split = sampling.split_by_quota(df, quota((True, 7), (False, 33)), "is_fraud").collect()
    assert len(split) == 240
    for label, prefix, n, take in [(True, "t", 40, 7), (False, "u", 200, 33)]:
        names = sorted((f"{prefix}{i}" for i in range(n)), key=lambda x: hashlib.md5(f"{x}|42".encode()).hexdigest())
        assert {r["txn_id_clean"] for r in split if r["is_fraud"] is label and r["taken"]} == set(names[:take])


@pytest.mark.parametrize("take,expected", [(0, 0), (1, 1), (1000, 30), (30, 30)])
def test_quota_bounds(spark, take, expected):
    split = sampling.split_by_quota(labelled(spark, 30, 5), quota((True, take)), "is_fraud")
    counts = Counter((r["is_fraud"], r["taken"]) for r in split.collect())
    assert counts[(True, True)] == expected and counts[(False, True)] == 0 and sum(counts.values()) == 35


def test_exact_copies_are_split_to_the_row(spark):
    # Half of all rows are copies of one row, spread over chunks.
    copies = spark.range(250_000).select(F.lit("same").alias("txn_id_clean"), F.lit(False).alias("is_fraud"))
    df = copies.unionByName(labelled(spark, 0, 50))
    split = sampling.split_by_quota(df, quota((False, 123_456)), "is_fraud")
    counts = {r["taken"]: r["count"] for r in split.groupBy("taken").count().collect()}
    assert counts == {True: 123_456, False: 250_050 - 123_456}


def test_sample_does_not_depend_on_partitioning(spark):
    df = labelled(spark, 100, 900)
    one = sampling.budgeted_sample(df.coalesce(1), 300)
    many = sampling.budgeted_sample(df.repartition(13), 300)
    assert one.exceptAll(many).isEmpty() and one.count() == many.count() == 300
    other_seed = sampling.budgeted_sample(df, 300, seed=7)
    assert not one.exceptAll(other_seed).isEmpty()


def test_budget_keeps_all_fraud_and_drops_unknown(spark):
    sample = sampling.budgeted_sample(labelled(spark, 50, 100, 20), 30)
    assert Counter(r["is_fraud"] for r in sample.collect()) == {True: 50}
    sample = sampling.budgeted_sample(labelled(spark, 50, 100, 20), 1000)
    assert Counter(r["is_fraud"] for r in sample.collect()) == {True: 50, False: 100}


def test_proportional_sample_rounds_fraud_down(spark):
    sample = sampling.proportional_sample(labelled(spark, 33, 67, 5), 10)
    assert Counter(r["is_fraud"] for r in sample.collect()) == {True: 3, False: 7}


@pytest.mark.parametrize("fraud,other,expected", [
    (10, 90, {("train", True): 8, ("train", False): 72, ("test", True): 2, ("test", False): 18}),
    (3, 8, {("train", True): 2, ("train", False): 6, ("test", True): 1, ("test", False): 2}),
    (0, 11, {("train", False): 8, ("test", False): 3}),
])
def test_train_test_split_sizes(spark, fraud, other, expected):
    split = sampling.train_test_split(labelled(spark, fraud, other, 4))
    assert dict(Counter((r["split"], r["is_fraud"]) for r in split.collect())) == expected


def test_training_sample(spark):
    df = labelled(spark, 40, 160, 10)
    count = lambda **k: Counter(r["is_fraud"] for r in sampling.training_sample(df, **k).collect())
    assert count() == {True: 40, False: 160}
    assert count(max_rows=100, min_fraud=5) == {True: 20, False: 80}
    assert count(max_rows=100, min_fraud=1000) == {True: 40, False: 60}
    assert sampling.training_sample(labelled(spark, 0, 80, 20), max_rows=60).count() == 60
    assert sampling.training_sample(labelled(spark, 0, 0, 20)).count() == 0


def test_a_third_without_an_id_is_split_to_the_row(spark):
    """Rows that share a missing id but differ elsewhere are parted by the hash of all columns."""
    plain = spark.range(40_000).select(F.concat(F.lit("t"), "id").alias("txn_id_clean"), F.lit(False).alias("is_fraud"), F.col("id").alias("n"))
    bare = spark.range(20_000).select(F.lit(None).cast("string").alias("txn_id_clean"), F.lit(False).alias("is_fraud"), F.col("id").alias("n"))
    df = plain.unionByName(bare)
    first = hashlib.md5(b"|42").hexdigest()[:7]
    ahead = sum(hashlib.md5(f"t{i}|42".encode()).hexdigest()[:7] < first for i in range(40_000))
    split = sampling.split_by_quota(df, quota((False, ahead + 7_000)), "is_fraud")
    counts = Counter((r["txn_id_clean"] is None, r["taken"]) for r in split.collect())
    assert counts[(True, True)] == 7_000 and counts[(False, True)] == ahead and sum(counts.values()) == 60_000
    again = sampling.split_by_quota(df.repartition(5), quota((False, ahead + 7_000)), "is_fraud")
    assert split.where("taken").exceptAll(again.where("taken")).isEmpty()


def test_a_split_reads_its_rows_twice(spark, tmp_path):
    """Counting is done when the plan is made; the plan itself reads all rows once and the edge pieces once."""
    path = str(tmp_path / "rows")
    labelled(spark, 300, 3_000).write.parquet(path)
    plan = sampling.train_test_split(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 2 and "NestedLoop" not in plan and "Cartesian" not in plan


def test_extract_plan(spark):
    plan = extract.extract_plan(labelled(spark, 5, 20, 3), 12).first()
    assert tuple(plan) == (5, 20, 28, 7, 12)
    assert len(EXTRACT_COLUMNS) == 17
