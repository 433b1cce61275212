"""The five analyses on files, and the shape of the physical plans."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from blotter.operators import fairness, forecast, panel, places, profiles, summary
from blotter.plans.arrest_patterns import arrest_patterns
from blotter.plans.fairness_audit import fairness_audit
from blotter.plans.forecasting import forecast_next_week
from blotter.plans.geography import geography
from blotter.plans.temporal import temporal_report
from blotter.roles import Roles
from blotter.sources.sinks import write_parquet
from catalogue.fixtures import order_incidents
from catalogue.queries import QUERIES

SF = "/root/testdata/sf0.001"
CATEGORIES = ("BATTERY", "THEFT", "ASSAULT", "NARCOTICS", "BURGLARY")


@pytest.fixture(scope="module")
def inc(spark):
    """Six units in three districts over 60 weeks; one unit has a third of the rows."""
    rng = random.Random(11)
    rows = []
    for i in range(3000):
        unit = rng.choice(["0111", "0112", "0911", "0912", "1711", "1712"])
        unit = "0111" if i % 3 == 0 else unit
        ts = dt.datetime(2018, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 7 * 60))
        rows.append(
            (i, ts, f"{unit} ST", unit, int(unit[:2]), rng.choice(CATEGORIES),
             None, rng.randint(0, 1), rng.randint(0, 1))
        )
    schema = (
        "id bigint, ts timestamp_ntz, block string, unit string, district int, "
        "category string, violent int, arrest int, domestic int"
    )
    return spark.createDataFrame(rows, schema).cache()


def lines(spark, path):
    return [r.value for r in spark.read.text(path).collect()]


def test_arrest_patterns(spark, inc, tmp_path):
    results = arrest_patterns(inc, str(tmp_path / "out"))
    for period in ("month", "hour", "dow"):
        direct = profiles.count_by_period(inc, period, where="arrest", drop_null_bucket=False)
        expected = [tuple(r) for r in direct.collect()]
        assert [tuple(r) for r in results[f"arrests_by_{period}"].collect()] == expected
        written = lines(spark, str(tmp_path / f"out/arrests_by_{period}"))
        assert sorted(written) == sorted(f"{b}\t{n}" for b, n in expected)


def test_temporal_report(spark, inc, tmp_path):
    results = temporal_report(inc, str(tmp_path / "out"))
    n = inc.count()
    for name in ("by_month", "by_hour", "by_dow", "by_year", "districts"):
        assert results[name].agg(F.sum("n")).first()[0] == n
    month = results["by_month"]
    assert month.filter("violent_n + non_violent_n <> n").isEmpty()
    row = results["summary"].first()
    assert row.total_n == n
    assert row.violent_n == inc.filter(F.col("category").isin("BATTERY", "ASSAULT")).count()
    assert lines(spark, str(tmp_path / "out/summary"))[0] == f"Incidents: {n:,}"
    districts = spark.read.option("header", True).csv(str(tmp_path / "out/district_distribution"))
    assert {r.district for r in districts.collect()} == {"1", "9", "17"}


def test_geography(spark, inc, tmp_path):
    results = geography(inc, str(tmp_path / "out"))
    assert results["correlations"].count() == 3
    assert results["paired_t"].first().n == 3
    blocks = [line.split("\t") for line in lines(spark, str(tmp_path / "out/top_blocks"))]
    counts = [int(n) for _, n in blocks]
    assert counts == sorted(counts, reverse=True)
    for line in lines(spark, str(tmp_path / "out/correlations")):
        u1, u2, r = line.split("\t")
        assert u1 < u2 and u1[:-2] == u2[:-2] and abs(float(r)) <= 1
        assert re.fullmatch(r"-?\d\.\d{1,4}", r)
    (t,) = lines(spark, str(tmp_path / "out/t_statistic"))
    assert re.fullmatch(r"T-statistic: -?\d+\.\d{4}", t)


def test_forecast(spark, inc, tmp_path):
    results = forecast_next_week(inc, str(tmp_path / "out"), dense=True, max_iter=5)
    predictions = results["predictions"]
    assert predictions.count() == results["metrics"].first().n > 0
    assert predictions.filter("prediction is null").isEmpty()
    assert [x.split(":")[0] for x in lines(spark, str(tmp_path / "out/forecast_metrics"))] == [
        "RMSE", "MAE", "MSE", "R2",
    ]


def test_forecast_learns(spark, inc):
    """Counts that follow a pattern are predicted better than by their mean."""
    rows = [(u, 2018 + w // 50, w % 50 + 1, 6 + w % 2 * 6 + k) for k, u in enumerate("abc") for w in range(100)]
    p = spark.createDataFrame(rows, "unit string, year int, week int, total bigint").withColumns(
        {"violent": F.col("total"), "arrest_rate": F.lit(0.0), "domestic_rate": F.lit(0.0)}
    )
    split = panel.split_by_index(panel.features_full(p)).cache()
    model = forecast.fit_forecast(panel.train_part(split), max_iter=5)
    scored = forecast.predict(model, panel.test_part(split)).select("label", "prediction")
    assert forecast.regression_metrics(scored).first().r2 > 0.5


def test_layout_of_training_rows_depends_on_the_rows_only(spark):
    rows = spark.range(1000).select(F.col("id").alias("unit"), (F.col("id") % 7).alias("label"))

    def layout(df):
        spread = forecast.laid_out(df, ["unit"], 5).withColumn("part", F.spark_partition_id())
        return [tuple(r) for r in spread.collect()]

    assert layout(rows.coalesce(1)) == layout(rows.repartition(8).orderBy(F.desc("unit")))
    assert len({part for _, _, part in layout(rows)}) == 5


@pytest.mark.parametrize("options", [{"dense": True}, {"split": "date"}])
def test_forecast_on_calendar_weeks(inc, options):
    results = forecast_next_week(inc, week_mode="calendar", max_iter=2, **options)
    assert results["metrics"].first().n == results["predictions"].count() > 0


def test_fairness_audit(spark, inc, tmp_path):
    results = fairness_audit(
        inc, str(tmp_path / "out"), reweight=True, calibrate=True, max_iter=3
    )
    bands = {r.band: r.n for r in results["by_band"].collect()}
    assert sum(bands.values()) == results["predictions"].count() == results["metrics"].first().n
    assert results["errors"].agg(F.sum("n")).first()[0] == sum(bands.values())
    assert results["cloud"].agg(F.sum("n")).first()[0] == sum(bands.values())
    assert results["disparity"].first().groups == len(bands)
    assert {r.band for r in results["calibrated_by_band"].collect()} == set(bands)
    assert results["arrest_rates"].count() == 3
    written = spark.read.option("header", True).csv(str(tmp_path / "out/fairness_by_band"))
    assert written.columns == results["by_band"].columns


def test_full_feature_list():
    stages = forecast.forecast_pipeline().getStages()
    assert len(stages[2].getInputCols()) == 19
    assert stages[3].getMaxIter() == 100
    base = forecast.forecast_pipeline(forecast.FEATURES_BASE).getStages()
    assert len(base[2].getInputCols()) == 8


# --- physical plans ---------------------------------------------------------


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def formatted(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def operators(plan, name):
    return len(re.findall(rf"[ *)]{name}\b", plan))


def test_filters_and_columns_reach_the_scan(spark):
    orders = order_incidents(spark, SF)
    plan = formatted(places.hotspots(orders, since=1999))
    assert "GreaterThanOrEqual(o_orderdate,1999-01-01" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_year_directories_are_pruned(spark, inc, tmp_path):
    path = str(tmp_path / "inc")
    write_parquet(inc, path)
    table = spark.read.parquet(path)
    recent = places.yearly_counts(table, since=2019, roles=Roles(year_part="year"))
    assert "PartitionFilters: [isnotnull(year" in formatted(recent)
    assert recent.agg(F.sum("n")).first()[0] == inc.filter("ts >= '2019-01-01'").count()


def test_one_window_and_one_sort_for_all_features(spark):
    plan = final_plan(panel.features_full(panel.weekly_panel(order_incidents(spark, SF))))
    assert (operators(plan, "Window"), operators(plan, "Sort")) == (1, 1)
    assert operators(plan, "Exchange") == 2


def test_dense_features_need_no_further_shuffle(spark):
    p = panel.densify(panel.weekly_panel(order_incidents(spark, SF)))
    plan = final_plan(panel.features_full(p))
    assert operators(plan, "Exchange") == 2
    assert operators(plan, "SortMergeJoin") == 0


def test_summary_reads_the_table_once(spark):
    plan = final_plan(summary.summary_report(order_incidents(spark, SF)))
    assert plan.count("FileScan") == 2  # orders and customer


@pytest.mark.parametrize("same_prefix", [True, False])
def test_pairs_are_joined_on_keys(spark, same_prefix):
    df = places.pairwise_corr(
        order_incidents(spark, SF), years=range(1995, 2001), same_prefix=same_prefix
    )
    plan = final_plan(df)
    assert "CartesianProduct" not in plan
    assert "NestedLoop" not in plan
    assert operators(plan, "SortMergeJoin") == 1


def test_audit_uses_no_python_and_no_products(spark):
    p = panel.weekly_panel(order_incidents(spark, SF), ("unit", "district"))
    scored = forecast.persistence(fairness.add_band(panel.features_base(p)))
    for df in (
        fairness.error_quartiles(scored, "band"),
        fairness.actual_vs_predicted(scored, "band"),
        fairness.disparity(fairness.fairness_by_group(scored, "band")),
        fairness.group_weights(scored, "band"),
    ):
        plan = final_plan(df)
        assert not re.search("Python|Pandas|CartesianProduct|NestedLoop", plan)
        # The quartiles read counted values and groups that are stored; nothing reads a table twice.
        assert plan.count("FileScan") <= (4 if "whisker_low" in df.columns else 2)


def test_order_queries_do_not_read_customers(spark):
    for name in ("violent_flags", "overall_summary", "monthly_violent", "hotspots_top10"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "customer" not in plan
