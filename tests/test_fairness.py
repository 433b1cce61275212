from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.operators import fairness as fr
from blotter.operators import forecast as fc

SCHEMA = "g string, label double, prediction double"


def listed(df):
    return [tuple(r) for r in df.collect()]


def test_rates_and_unknown_groups(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "district int, arrest int")
    got = {r.district: (r.n, r.arrest_n, r.arrest_pct) for r in fr.rate_by_group(df, "district", "arrest").collect()}
    assert got == {1: (2, 1, 50.0), 2: (1, None, None)}


def test_bands(spark):
    df = fr.add_band(spark.createDataFrame([(8,), (9,), (16,), (17,), (None,)], "district int"))
    assert [r.band for r in df.collect()] == ["North", "Central", "Central", "South", "Unknown"]


def test_fairness_and_disparity(spark):
    rows = [("a", 2.0, 1.0), ("a", 0.0, 3.0), ("b", 1.0, 1.0), (None, 5.0, 4.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.g: tuple(r)[1:] for r in fr.fairness_by_group(df, "g").collect()}
    assert got == {
        "a": (2, 1.0, 2.0, 2.0, 1.0), "b": (1, 1.0, 1.0, 0.0, 0.0), None: (1, 5.0, 4.0, 1.0, -1.0),
    }
    assert listed(fr.disparity(fr.fairness_by_group(df, "g"))) == [(3, 0.25, 2.0, True)]
    one = fr.fairness_by_group(df.filter("g = 'a'"), "g")
    assert listed(fr.disparity(one)) == [(1, None, None, None)]
    zero = fr.fairness_by_group(df.withColumn("prediction", F.lit(0.0)), "g")
    assert fr.disparity(zero).first().impact_ratio == 0.0


def test_metrics(spark):
    rng = np.random.default_rng(3)
    y, p = rng.normal(5, 2, 40), rng.normal(5, 2, 40)
    df = spark.createDataFrame([("a", float(a), float(b)) for a, b in zip(y, p)], SCHEMA)
    row = fc.regression_metrics(df).first()
    mse = ((y - p) ** 2).mean()
    assert row.n == 40
    assert row.mse == pytest.approx(mse)
    assert row.rmse == pytest.approx(mse**0.5)
    assert row.mae == pytest.approx(abs(y - p).mean())
    assert row.r2 == pytest.approx(1 - mse / y.var())
    flat = fc.regression_metrics(df.withColumn("label", F.lit(1.0))).first()
    assert flat.r2 is None
    lines = fc.metrics_text(fc.regression_metrics(df)).first().value.splitlines()
    assert lines[0] == f"RMSE: {mse**0.5:.4f}"


def groups():
    rng = random.Random(5)
    return {
        "even": [rng.uniform(-3, 3) for _ in range(900)],
        "tail": [rng.gauss(0, 1) for _ in range(700)] + [1e6, -1e7],
        "far": [1000 + rng.random() for _ in range(300)],
        "ties": [float(rng.randint(-2, 2)) for _ in range(800)],
        "zero": [0.0] * 50,
        "same": [7.5] * 3,
        "one": [2.0],
        "two": [1.0, 4.0],
        None: [float(i) for i in range(11)],
    }


@pytest.mark.parametrize(("small", "cuts"), [(4, 2), (50, 8), (10_000, 64)])
def test_quantiles_equal_brute_force(spark, small, cuts):
    data = groups()
    rows = [(g, v) for g, vs in data.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)
    got = fr.exact_quantiles(fr.value_counts(df, "g", F.col("v")), probs, small, cuts).collect()
    assert len(got) == len(data)
    for row in got:
        values = data[row.key.g]
        assert (row.n, row.min_value, row.max_value) == (len(values), min(values), max(values))
        assert row.quantiles == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)


def test_no_bracket_keeps_many_of_skewed_values(spark):
    """Nearly all values in a thin band far from one outlier: even bins would gather them."""
    n = 20_000
    df = spark.range(n).select(F.struct(F.lit("g").alias("g")).alias("key"), (1e6 + F.col("id") * 1e-3).alias("value"), F.lit(1).cast("bigint").alias("n"))
    outlier = spark.range(1).select(F.struct(F.lit("g").alias("g")).alias("key"), F.lit(0.0).alias("value"), F.lit(1).cast("bigint").alias("n"))
    counts = df.union(outlier).repartition(8)
    rows = counts.withColumn("bracket", F.lit(""))
    ranks = F.array(F.struct(F.lit(0).alias("i"), F.lit(n // 2).cast("bigint").alias("rank")))
    start = counts.groupBy("key").agg(F.count("*").alias("size")).withColumns(
        {"bracket": F.lit(""), "before": F.lit(0).cast("bigint"), "ranks": ranks}
    )
    left, brackets = fr._refined(rows, start, 500, 64)
    assert left.count() == brackets.first()["size"] < 3 * n / 64
    assert brackets.count() == 1
    got = fr.exact_quantiles(counts, (0.25, 0.5), 100, 16).first()
    values = [0.0] + [1e6 + i * 1e-3 for i in range(n)]
    assert got.quantiles == pytest.approx(list(np.quantile(values, (0.25, 0.5))), rel=1e-15)


def test_box_plot_figures(spark):
    data = groups()
    rows = [(g, 10.0, 10.0 + v) for g, vs in data.items() for v in vs]
    got = fr.error_quartiles(spark.createDataFrame(rows, SCHEMA), "g").collect()
    assert len(got) == len(data)
    for row in got:
        errors = np.array([10.0 + v - 10.0 for v in data[row.g]])
        q1, median, q3 = np.quantile(errors, (0.25, 0.5, 0.75))
        inside = (errors >= q1 - 1.5 * (q3 - q1)) & (errors <= q3 + 1.5 * (q3 - q1))
        assert (row.q1, row.median, row.q3) == pytest.approx((q1, median, q3))
        assert (row.whisker_low, row.whisker_high) == (errors[inside].min(), errors[inside].max())
        assert row.outliers == (~inside).sum()


def test_cloud(spark):
    rows = [("a", 1.2, 2.9), ("a", 1.9, 2.0), ("b", 7.0, -0.5)]
    cells = fr.actual_vs_predicted(spark.createDataFrame(rows, SCHEMA), "g").collect()
    assert {tuple(r) for r in cells} == {("a", 1, 2, 2, 7.0), ("b", 7, -1, 1, 7.0)}


def test_weights_give_each_group_the_same_total(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0)] * 6 + [("b", 0.0, 0.0)] * 2 + [(None, 0.0, 0.0)], SCHEMA)
    weighted = fr.add_weights(df, fr.group_weights(df, "g"), "g")
    assert weighted.count() == 9
    totals = {r.g: r.w for r in weighted.groupBy("g").agg(F.sum("weight").alias("w")).collect()}
    assert totals == pytest.approx({"a": 3.0, "b": 3.0, None: 3.0})


def test_calibration_centres_the_groups_it_saw(spark):
    rng = random.Random(1)
    rows = [(g, rng.random(), rng.random() + k) for k, g in enumerate(("a", "b", None)) for _ in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    adjusted = fr.calibrate_by_group(df, df, "g")
    assert adjusted.count() == 90
    for row in fr.fairness_by_group(adjusted, "g", prediction="calibrated").collect():
        assert row.mean_error == pytest.approx(0, abs=1e-12)
    unseen = fr.calibrate_by_group(df.filter("g = 'a'"), df.filter("g = 'b'"), "g").first()
    assert unseen.calibrated == unseen.prediction
