import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tollgate.functions.numbers import coarse_key
from tollgate.operators import ranking


def numbers(seed=1, n=600):
    rng = np.random.default_rng(seed)
    values = np.round(np.concatenate([rng.normal(0, 1, n // 2), rng.lognormal(3, 2, n // 4), np.full(n // 4, 0.5)]), 4)
    return pd.DataFrame({"group": np.where(np.arange(len(values)) % 3 == 0, "a", "b"), "x": values})


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e12, 1e12, allow_nan=False, allow_subnormal=False), min_size=2, max_size=60))
def test_coarse_key_keeps_the_order(spark, values):
    values = values + [0.0, 1.0, 2.0, 1.9999999999999998, 4.0, 3.9999999999999996, -8.0]
    df = spark.createDataFrame([(v,) for v in values], "x double").select("x", coarse_key(F.col("x")).alias("k"))
    keys = [r["k"] for r in df.collect()]
    order = sorted(range(len(values)), key=lambda i: values[i])
    assert all(keys[a] <= keys[b] for a, b in zip(order, order[1:]))


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    counts = numbers().groupby(["group", "x"]).size().reset_index(name="rows")
    got = ranking.running_totals(spark.createDataFrame(counts), "x", ["rows"], ["group"], descending).toPandas()
    want = counts.sort_values(["group", "x"], ascending=[True, not descending]).reset_index(drop=True)
    want["before_rows"] = want.groupby("group")["rows"].cumsum() - want["rows"]
    want["total_rows"] = want.groupby("group")["rows"].transform("sum")
    got = got.sort_values(["group", "x"], ascending=[True, not descending]).reset_index(drop=True)
    pd.testing.assert_frame_equal(got[want.columns], want, check_dtype=False)


def test_quantiles_are_exact(spark):
    data = numbers(2)
    points = {"p10": 0.1, "median": 0.5, "p99": 0.99}
    got = ranking.exact_quantiles(spark.createDataFrame(data), "x", points, ["group"]).toPandas().set_index("group")
    for group, values in data.groupby("group")["x"]:
        for name, point in points.items():
            assert got.loc[group, name] == pytest.approx(np.quantile(values, point), abs=1e-9)


def test_describe(spark):
    data = numbers(3)
    got = ranking.describe(spark.createDataFrame(data), "x").first()
    want = data["x"].describe()
    assert [got[c] for c in ("count", "mean", "std", "min", "q1", "median", "q3", "max")] == pytest.approx(list(want))


def test_box_summary_counts_outliers(spark):
    data = pd.DataFrame({"g": "a", "x": [1.0, 2, 3, 4, 5, 100]})
    got = ranking.box_summary(spark.createDataFrame(data), "x", "g").first()
    assert (got["q1"], got["median"], got["q3"]) == (2.25, 3.5, 4.75)
    assert (got["whisker_low"], got["whisker_high"], got["max"], got["outliers"], got["rows"]) == (1.0, 5.0, 100.0, 1, 6)


@pytest.mark.parametrize("shared", [False, True])
def test_histogram_matches_numpy(spark, shared):
    rng = np.random.default_rng(5)
    data = pd.DataFrame({"g": ["a"] * 200 + ["b"] * 100, "x": np.r_[rng.random(200), rng.random(100) * 3 + 1]})
    got = ranking.histogram(spark.createDataFrame(data), "x", "g", 10, shared).toPandas()
    for group, values in data.groupby("g")["x"]:
        span = (data["x"].min(), data["x"].max()) if shared else (values.min(), values.max())
        want, _ = np.histogram(values, bins=10, range=span)
        assert list(got[got["g"] == group].sort_values("bin")["rows"]) == list(want)


def test_histogram_of_a_single_value(spark):
    got = ranking.histogram(spark.createDataFrame([("a", 2.0)] * 3, "g string, x double"), "x", "g", 4).orderBy("bin")
    assert [r["rows"] for r in got.collect()] == [0, 0, 3, 0]


def test_global_positions_with_most_rows_tied(spark):
    rows = [(f"m{i}", 0 if i % 10 else i) for i in range(500)]
    df = spark.createDataFrame(rows, "name string, score long")
    got = ranking.global_positions(df, "score", "name").toPandas().sort_values("position")
    assert list(got["position"]) == list(range(500))
    assert got["score"].is_monotonic_decreasing
    assert list(got["running_key"]) == list(got["score"].cumsum())
    assert set(got["total_key"]) == {sum(s for _, s in rows)}
    part = ranking.global_positions(df, "score", "name", span=(30, 90)).toPandas().sort_values("position")
    assert list(part["name"]) == list(got["name"])[30:90]


def test_a_third_of_copies_and_rows_without_an_id(spark):
    """Copies are counted, and rows that share a missing id are cut by their other columns."""
    copies = spark.range(3000).selectExpr("'same' as name", "7L as score", "0L as n")
    bare = spark.range(3000).selectExpr("cast(null as string) as name", "7L as score", "id as n")
    plain = spark.range(3000).selectExpr("concat('m', id) as name", "id % 9 as score", "id as n")
    df = copies.unionByName(bare).unionByName(plain)
    got = ranking.global_positions(df, "score", "name", piece_rows=50)
    rows = got.toPandas().sort_values("position")
    assert list(rows["position"]) == list(range(9000)) and rows["score"].is_monotonic_decreasing
    assert list(rows["running_key"]) == list(rows["score"].cumsum())
    part = ranking.global_positions(df.repartition(7), "score", "name", span=(2000, 5000), piece_rows=50).toPandas().sort_values("position")
    assert part[["name", "n"]].astype(str).values.tolist() == rows[["name", "n"]].astype(str).values.tolist()[2000:5000]


def test_crowded_values_are_cut_by_their_number(spark, monkeypatch):
    """Values crowded within one piece are ordered in cells of a bounded size."""
    monkeypatch.setattr(ranking, "PIECE_ROWS", 100)
    df = spark.range(20_000).selectExpr("0.30000 + id * 1e-10 as x", "1L as rows")
    got = ranking.running_totals(df, "x", ["rows"])
    values = got.toPandas().sort_values("x")
    assert list(values["before_rows"]) == list(range(20_000)) and set(values["total_rows"]) == {20_000}
    cells = got._jdf.queryExecution().analyzed().toString()
    assert "_cell" in cells
