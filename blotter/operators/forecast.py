"""Boosted-tree forecast of the next week, and its metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.operators.encoding import slot_value
from blotter.operators.fairness import add_weights, group_weights
from blotter.runtime import materialise, scratch_path

CATEGORIES = ("unit", "year", "week")

# Partitions of the training rows. Trees pick their split candidates by
# partition, so the number is part of the model, like the seed.
FIT_PARTITIONS = 16

# Scalar inputs of the full forecast; with the three encoded categories, 19.
FEATURES_FULL = (
    "total",
    "arrest_rate",
    "domestic_rate",
    "total_per_violent",
    "total_lag_1",
    "total_lag_2",
    "total_lag_3",
    "violent_lag_1",
    "violent_lag_2",
    "total_mean_3",
    "violent_mean_3",
    "total_mean_4",
    "is_summer",
    "is_winter",
    "is_holiday_season",
    "trend",
)

# Scalar inputs of the smaller forecast; with the categories, 8.
FEATURES_BASE = (
    "total",
    "arrest_rate",
    "domestic_rate",
    "violent_share",
    "total_lag_1",
)


def category_indexer(cols: Sequence[str] = CATEGORIES) -> StringIndexer:
    """Index categories by frequency, ties in text order.

    A value that training never saw gets an index of its own.
    """
    return StringIndexer(
        inputCols=list(cols), outputCols=[f"{c}_index" for c in cols], handleInvalid="keep"
    )


def forecast_pipeline(
    features: Sequence[str] = FEATURES_FULL,
    categories: Sequence[str] = CATEGORIES,
    max_iter: int = 100,
    seed: int = 42,
    invalid: str = "error",
    weight_col: str | None = None,
) -> Pipeline:
    """Indexer, one-hot encoder, assembler and boosted trees."""
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in categories],
        outputCols=[f"{c}_vec" for c in categories],
    )
    assembler = VectorAssembler(
        inputCols=[*encoder.getOutputCols(), *features],
        outputCol="features",
        handleInvalid=invalid,
    )
    trees = GBTRegressor(
        labelCol="label", featuresCol="features", maxIter=max_iter, seed=seed
    )
    if weight_col:
        trees.setWeightCol(weight_col)
    return Pipeline(stages=[category_indexer(categories), encoder, assembler, trees])


def laid_out(train: DataFrame, keys: Sequence[str], partitions: int) -> DataFrame:
    """Training rows in a layout that depends on the rows and ``partitions`` only.

    Rows are placed by their keys and sorted by all columns, so neither the
    cores of a cluster nor the order of its reads change the fitted model.
    """
    return train.repartition(partitions, *keys).sortWithinPartitions(*train.columns)


def fit_forecast(
    train: DataFrame,
    categories: Sequence[str] = CATEGORIES,
    partitions: int = FIT_PARTITIONS,
    **options,
) -> PipelineModel:
    """Fit the pipeline. ``train`` is read several times: pass it materialised."""
    pipeline = forecast_pipeline(categories=categories, **options)
    return pipeline.fit(laid_out(train, categories, partitions))


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows)


def out_of_fold(
    rows: DataFrame,
    group: str,
    series: Sequence[str] = ("unit",),
    folds: int = 3,
    **options,
) -> DataFrame:
    """Every row with the forecast of a model that never saw its series.

    The hash of a series decides its fold. For each fold one model is fitted
    on the others, with weights that give every ``group`` the same total, and
    its forecasts are added to one stored table, which is returned with
    ``fold`` and ``prediction``. ``rows`` is read once per fold and more: pass
    it materialised. ``options`` go to ``fit_forecast``.
    """
    if folds < 2:
        raise ValueError("a row must be left out of at least one fit: two folds or more")
    kept = rows.columns
    dealt = rows.withColumn("fold", F.pmod(F.xxhash64(*series), F.lit(folds)).cast("int"))
    path = scratch_path(rows.sparkSession, "folds")
    for fold in range(folds):
        others = dealt.filter(F.col("fold") != fold)
        train = materialise(add_weights(others, group_weights(others, group), group), "fold-train")
        model = fit_forecast(train, weight_col="weight", **options)
        scored = predict(model, dealt.filter(F.col("fold") == fold))
        scored.select(*kept, "fold", "prediction").write.mode("append").parquet(path)
    return rows.sparkSession.read.parquet(path)


def model_table(model: PipelineModel) -> DataFrame:
    """The fitted trees as rows (tree, node, feature, threshold, left, right, value, weight).

    A row goes left where the value at slot ``feature`` is at most
    ``threshold``; a leaf has no feature. Splits of a 0/1 slot, which Spark
    keeps as sets of categories, are written as thresholds as well. Spark
    saves the model as a table, which is read back; its size is set by the
    number and depth of the trees.
    """
    trees = model.stages[-1]
    spark = SparkSession.active()
    path = scratch_path(spark, "trees")
    trees.write().save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "_", "weight").select("tree", "weight")
    nodes = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    held, kinds = F.col("split.leftCategoriesOrThreshold"), F.col("split.numCategories")
    leaf, listed = F.col("leftChild") < 0, kinds >= 0
    zero, one = F.array_contains(held, 0.0), F.array_contains(held, 1.0)
    # The sides change places where the left one is that of the ones.
    swapped = listed & one & ~zero
    threshold = (
        F.when(~listed, held[0])
        .when(kinds > 2, F.raise_error(F.lit("only 0/1 slots may be split by category")).cast("double"))
        .when(zero & one, F.lit(float("inf")))
        .when(zero | one, 0.5)
        .otherwise(float("-inf"))
    )
    return nodes.join(weights, "tree").select(
        "tree",
        F.col("id").alias("node"),
        F.when(~leaf, F.col("split.featureIndex")).alias("feature"),
        F.when(~leaf, threshold).alias("threshold"),
        F.when(~leaf, F.when(swapped, F.col("rightChild")).otherwise(F.col("leftChild"))).alias("left"),
        F.when(~leaf, F.when(swapped, F.col("leftChild")).otherwise(F.col("rightChild"))).alias("right"),
        F.col("prediction").alias("value"),
        "weight",
    )


def predict_by_table(
    rows: DataFrame, nodes: DataFrame, max_depth: int = 5, prediction: str = "prediction"
) -> DataFrame:
    """Forecast of rows from ``encoding.encoded`` by a table of nodes.

    The trees are gathered into one value, whose size the fit's parameters
    bound, and every row walks down all of them inside its task: no join, no
    shuffle, no model object. Nodes are numbered from 0 within a tree, as
    ``model_table`` has them; ``max_depth`` is that of the fit.
    """
    fields = ("node", "feature", "threshold", "left", "right", "value")
    trees = (
        nodes.groupBy("tree", "weight")
        .agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("nodes"))
        .agg(F.array_sort(F.collect_list(F.struct("tree", "weight", "nodes"))))
        .scalar()
    )

    def below(at: Column, own: Column) -> Column:
        node = F.get(own, at)
        left = slot_value(node["feature"]) <= node["threshold"]
        return F.when(node["feature"].isNull(), at).when(left, node["left"]).otherwise(node["right"])

    def leaf_value(own: Column) -> Column:
        levels = F.sequence(F.lit(1), F.lit(max_depth))
        leaf = F.aggregate(levels, F.lit(0), lambda at, _: below(at, own))
        return F.get(own, leaf)["value"]

    total = F.aggregate(
        "_trees", F.lit(0.0), lambda done, tree: done + tree["weight"] * leaf_value(tree["nodes"])
    )
    return rows.withColumn("_trees", trees).withColumn(prediction, total).drop("_trees")


def persistence(features: DataFrame) -> DataFrame:
    """Forecast that repeats this week's count: the yardstick for the trees."""
    return features.withColumn("prediction", F.col("violent").cast("double"))


def regression_metrics(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row: n, rmse, mae, mse, r2, from one pass over the predictions."""
    y = F.col(label).cast("double")
    error = y - F.col(prediction)
    sums = predictions.agg(
        F.count("*").alias("n"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(y).alias("spread"),
    )
    return sums.select(
        "n",
        F.sqrt("mse").alias("rmse"),
        "mae",
        "mse",
        (1 - F.try_divide(F.col("mse"), F.col("spread"))).alias("r2"),
    )


def metrics_text(metrics: DataFrame) -> DataFrame:
    """The metrics as one text value, one line per figure."""
    names = ("rmse", "mae", "mse", "r2")
    lines = [
        F.concat(F.lit(f"{c.upper()}: "), F.when(F.col(c).isNull(), "-").otherwise(F.format_string("%.4f", c)))
        for c in names
    ]
    return metrics.select(F.concat_ws("\n", *lines).alias("value"))
