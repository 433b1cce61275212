"""Category dictionary, coordinate vectors and the model kept as a table."""

from __future__ import annotations

import json
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import functions as F

from blotter.operators import encoding as en
from blotter.operators import fairness as fr
from blotter.operators import forecast as fc
from blotter.operators import panel as pn
from blotter.operators.ranking import global_rank
from blotter.runtime import materialise
from catalogue.fixtures import order_incidents

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def split(spark):
    p = pn.weekly_panel(order_incidents(spark, SF).withColumn("unit", F.col("district").cast("string")))
    return materialise(pn.split_by_index(materialise(pn.features_full(p))))


def test_global_rank(spark):
    rows = [(g, v) for g, n in (("a", 500), ("b", 1), ("c", 40)) for v in range(n)]
    df = spark.createDataFrame(rows, "g string, v int").repartition(7, "v")
    got = global_rank(df, "g", [F.col("v").desc()]).collect()
    assert len(got) == len(rows)
    size = {"a": 500, "b": 1, "c": 40}
    assert all(r["rank"] == size[r.g] - 1 - r.v for r in got)
    assert global_rank(df.limit(0), "g", [F.col("v")]).count() == 0


def test_dictionary_equals_the_indexer(spark):
    values = ["b", "a", "c", None, "B", "é", "a", "c", "", "10", "9"]
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(values)], "x string, y int")
    labels = fc.category_indexer(["x", "y"]).fit(df).labelsArray
    for column, expected in zip(("x", "y"), labels):
        own = en.category_index(df, ["x", "y"]).filter(F.col("column") == column).orderBy("index").collect()
        assert [r.value for r in own] == list(expected)
        assert [r["index"] for r in own] == list(range(len(expected)))


def test_slots_equal_the_assembled_vectors(spark, split):
    train = pn.train_part(split)
    known = materialise(en.category_index(train, fc.CATEGORIES))
    stages = fc.forecast_pipeline().getStages()[:-1]
    assert [type(s) for s in stages[1:]] == [OneHotEncoder, VectorAssembler]
    vectors = Pipeline(stages=stages).fit(train).transform(split)
    expected = {}
    for r in vectors.select(*fc.CATEGORIES, "features").collect():
        found = r.features.toArray()
        expected[tuple(r)[:3]] = {i: v for i, v in enumerate(found.tolist()) if v}
    got = {key: {} for key in expected}
    slots = en.feature_slots(split, known, fc.CATEGORIES, fc.CATEGORIES, fc.FEATURES_FULL)
    for r in slots.collect():
        got[tuple(r)[:3]][r.slot] = r.value
    assert got == expected


def test_unknown_values_and_null_scalars(spark):
    known = en.category_index(spark.createDataFrame([("a",), ("a",), ("b",)], "c string"), ["c"])
    rows = spark.createDataFrame([(1, "b", 2.0), (2, "new", 3.0), (3, None, 0.0), (4, "a", None)], "k int, c string, s double")
    kept = en.feature_slots(rows, known, ["k"], ["c"], ["s"], invalid="skip")
    assert sorted(map(tuple, kept.collect())) == [(1, 1, 1.0), (1, 2, 2.0), (2, 2, 3.0)]
    with pytest.raises(Exception, match="scalar feature is null"):
        en.feature_slots(rows, known, ["k"], ["c"], ["s"]).collect()


def test_table_predicts_as_the_model(spark, split):
    train = pn.train_part(split)
    model = fc.fit_forecast(train, max_iter=8, partitions=4)
    nodes = materialise(fc.model_table(model))
    assert nodes.columns == ["tree", "node", "feature", "threshold", "left", "right", "value", "weight"]
    assert nodes.select("tree").distinct().count() == 8
    known = materialise(en.category_index(train, fc.CATEGORIES))
    rows = en.encoded(fc.predict(model, split), known, fc.CATEGORIES, fc.FEATURES_FULL)
    scored = fc.predict_by_table(rows, nodes, prediction="own")
    assert scored.count() == split.count()
    assert scored.filter(~(F.abs(F.col("own") - F.col("prediction")) <= 1e-9)).count() == 0


def test_sides_of_a_category_split(spark):
    """A tree on 0/1 slots alone, with both ways round of a split."""
    rows = [(k, k % 4, float((k % 4 == 1) * 5 - (k % 4 == 2) * 7)) for k in range(200)]
    train = spark.createDataFrame(rows, "id int, unit int, label double").withColumns({"year": F.col("id") % 3, "week": F.lit(1)})
    model = fc.fit_forecast(train, max_iter=3, partitions=2, features=())
    known = en.category_index(train, fc.CATEGORIES)
    rows = en.encoded(fc.predict(model, train), known, fc.CATEGORIES, ())
    scored = fc.predict_by_table(rows, fc.model_table(model), prediction="own")
    assert scored.filter(~(F.abs(F.col("own") - F.col("prediction")) <= 1e-9)).count() == 0


SCRIPT = """
import json, sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[{cores}]").config("spark.ui.enabled", "false")
    .config("spark.sql.session.timeZone", "UTC").config("spark.sql.shuffle.partitions", "{cores}")
    .config("spark.checkpoint.dir", {shared!r}).getOrCreate())
from blotter.operators import forecast as fc, panel as pn
from blotter.runtime import materialise
from catalogue.fixtures import order_incidents
p = pn.weekly_panel(order_incidents(spark, {sf!r}).withColumn("unit", F.col("district").cast("string")))
train = pn.train_part(pn.split_by_index(materialise(pn.features_full(p))))
nodes = fc.model_table(fc.fit_forecast(train, max_iter=4)).orderBy("tree", "node")
print("NODES" + json.dumps([list(r) for r in nodes.collect()]))
"""


def test_equal_tables_with_two_and_four_cores(tmp_path):
    tables = []
    for cores in (2, 4):
        code = SCRIPT.format(repo=str(Path(__file__).resolve().parents[1]), cores=cores, shared=str(tmp_path), sf=SF)
        out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
        line = next(x for x in out.stdout.splitlines() if x.startswith("NODES"))
        tables.append(json.loads(line[5:]))
    assert tables[0] == tables[1]
    assert len(tables[0]) > 20


def test_out_of_fold(spark, split):
    rows = materialise(split.drop("split").withColumn("band", F.when(F.col("unit").cast("int") <= 8, "a").otherwise("b")))
    scored = fc.out_of_fold(rows, "band", folds=2, features=fc.FEATURES_FULL, max_iter=3, partitions=4)
    assert scored.columns == [*rows.columns, "fold", "prediction"]
    assert rows.exceptAll(scored.drop("fold", "prediction")).count() == 0
    assert scored.count() == rows.count()
    assert scored.groupBy("unit").agg(F.count_distinct("fold").alias("n")).filter("n > 1").count() == 0
    assert scored.select("fold").distinct().count() == 2
    assert scored.filter("prediction is null").count() == 0
    # The weighted fit of one fold, done by hand.
    others = scored.filter("fold = 1").drop("fold", "prediction")
    train = materialise(fr.add_weights(others, fr.group_weights(others, "band"), "band"))
    model = fc.fit_forecast(train, weight_col="weight", features=fc.FEATURES_FULL, max_iter=3, partitions=4)
    again = fc.predict(model, scored.filter("fold = 0").withColumnRenamed("prediction", "given"))
    assert again.filter("abs(prediction - given) > 1e-12").count() == 0
    adjusted = fr.calibrate_by_group(scored, scored, "band")
    for r in fr.fairness_by_group(adjusted, "band", prediction="calibrated").collect():
        assert abs(r.mean_error) < 1e-12
    with pytest.raises(ValueError):
        fc.out_of_fold(rows, "band", folds=1)
