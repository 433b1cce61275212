"""Rates by group and differences of a forecast between groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.functions.cleaning import band, pct
from blotter.roles import ROLES
from blotter.runtime import materialise

# Upper ends of the district bands.
DISTRICT_CUTS = ((8, "North"), (16, "Central"))
LAST_BAND = "South"


def add_band(df: DataFrame, district: str = ROLES.district, name: str = "band") -> DataFrame:
    """Band of a district; ``Unknown`` where there is none."""
    return df.withColumn(name, band(district, DISTRICT_CUTS, LAST_BAND))


def _names(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _all_known(cols: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in cols])


def rate_by_group(
    df: DataFrame, group: str | Sequence[str], flags: str | Sequence[str]
) -> DataFrame:
    """Rows, flagged rows and flagged percentage per known group."""
    keys, named = _names(group), _names(flags)
    counts = (
        df.filter(_all_known(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("n"), *[F.sum(f).alias(f"{f}_n") for f in named])
    )
    return counts.withColumns({f"{f}_pct": pct(f"{f}_n", "n") for f in named})


def fairness_by_group(
    predictions: DataFrame,
    group: str | Sequence[str],
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """n, mean actual and predicted, MAE and mean signed error per group."""
    error = F.col(prediction) - F.col(label)
    return predictions.groupBy(*_names(group)).agg(
        F.count("*").alias("n"),
        F.avg(label).alias("actual_avg"),
        F.avg(prediction).alias("predicted_avg"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error).alias("mean_error"),
    )


def disparity(fairness: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row: ratio of the group means, error gap, and whether it is flagged.

    Ratio and gap are null for fewer than two groups; the ratio is 0 if no
    group has a positive mean prediction.
    """
    top, low = F.max("predicted_avg"), F.min("predicted_avg")
    several = F.count("*") > 1
    values = fairness.agg(
        F.count("*").alias("groups"),
        F.when(several, F.when(top > 0, low / top).otherwise(0.0)).alias("impact_ratio"),
        F.when(several, F.max("mean_error") - F.min("mean_error")).alias("error_gap"),
    )
    return values.withColumn("flagged", F.col("impact_ratio") < threshold)


def value_counts(df: DataFrame, group: str, value: Column) -> DataFrame:
    """Rows per (group, value), so that equal values travel as one row.

    The group is kept inside a struct: as a join key a null group then matches
    itself, and its rows are not lost.
    """
    return (
        df.select(F.struct(group).alias("key"), value.cast("double").alias("value"))
        .filter(F.col("value").isNotNull())
        .groupBy("key", "value")
        .agg(F.count("*").alias("n"))
    )


#: Values of a bracket that one task sorts, and the parts a larger one is cut into.
SMALL_BRACKET = 10_000
CUTS = 64


def _wanted_between(first: str, last: str) -> Column:
    """The wanted ranks from ``first`` to before ``last``."""
    return F.filter("ranks", lambda x: (x["rank"] >= F.col(first)) & (x["rank"] < F.col(last)))


def _refined(rows: DataFrame, brackets: DataFrame, small: int, cuts: int) -> tuple[DataFrame, DataFrame]:
    """One round: cut the large brackets, keep the parts that hold a wanted rank.

    ``rows`` are (key, bracket, value, n), ``brackets`` (key, bracket, before,
    size, ranks), with ``size`` distinct values and ``before`` rows below. The
    cuts are values of the bracket itself, taken at even steps of its distinct
    values by a sketch that is merged from all tasks, so that the parts are of
    like size however the values are spread.
    """
    own = ["key", "bracket"]
    steps = F.array(*[F.lit((i + 1) / cuts) for i in range(cuts - 1)])
    large = brackets.filter(F.col("size") > small).select(*own)
    cut_at = rows.join(large, own).groupBy(*own).agg(
        F.array_distinct(F.percentile_approx("value", steps, F.lit(100 * cuts))).alias("cuts")
    )
    part = F.coalesce(F.size(F.filter("cuts", lambda c: c < F.col("value"))), F.lit(0))
    # The cuts have one row per large bracket, and AQE broadcasts them by their
    # real size; else it splits the rows of a hot one.
    cut = materialise(
        rows.join(cut_at, own, "left").select(*own, part.alias("part"), "value", "n"), "brackets"
    )
    below = Window.partitionBy(*own).orderBy("part")
    parts = (
        cut.groupBy(*own, "part")
        .agg(F.sum("n").alias("part_n"), F.count("*").alias("size"))
        .withColumn("upto", F.sum("part_n").over(below))
        .join(brackets.drop("size"), own)
        .withColumns({"before": F.col("before") + F.col("upto") - F.col("part_n"), "last": F.col("before") + F.col("upto")})
        .withColumn("ranks", _wanted_between("before", "last"))
        .filter(F.size("ranks") > 0)
    )
    # A bracket is named by its parts so far, so that names stay apart.
    deeper = F.concat_ws(".", "bracket", F.col("part").cast("string"))
    kept = materialise(
        parts.select("key", "bracket", "part", deeper.alias("deeper"), "before", "size", "ranks"), "parts"
    )
    survivors = cut.join(kept.select(*own, "part", "deeper"), [*own, "part"]).select(
        "key", F.col("deeper").alias("bracket"), "value", "n"
    )
    return survivors, kept.select("key", F.col("deeper").alias("bracket"), "before", "size", "ranks")


def exact_quantiles(
    counts: DataFrame,
    probs: Sequence[float],
    small: int = SMALL_BRACKET,
    cuts: int = CUTS,
    group: str = "key",
) -> DataFrame:
    """Exact interpolated quantiles of weighted values, for groups of any size.

    ``counts`` holds (key, value, n), as ``value_counts`` gives it; it is read
    several times: pass it materialised. A group starts as one bracket. In every round the rows are counted by bracket, and
    only brackets that hold a wanted rank go on; those with more than ``small``
    distinct values are cut into about ``cuts`` parts of like size, at values
    taken from the data. So a round leaves a small part of the one before, the
    number of rounds grows with the logarithm of the largest group, and in the
    end a task sorts at most ``small`` values of a bracket, whatever the spread
    of the values. The driver learns the size of the largest bracket only.

    One row per group: the key, ``min_value``, ``max_value``, ``n`` and
    ``quantiles``, in the order of ``probs``. A group without values has none.
    """
    if cuts < 2 or small < cuts:
        raise ValueError("a large bracket must be cut, into no more parts than a small one has values")
    rows = counts.select(F.col(group).alias("key"), F.lit("").alias("bracket"), "value", "n")
    groups = materialise(
        rows.groupBy("key").agg(
            F.min("value").alias("lo"),
            F.max("value").alias("hi"),
            F.sum("n").alias("total"),
            F.count("*").alias("size"),
        ),
        "groups",
    )
    # Each quantile lies between two ranks (which may be the same).
    targets = F.array(
        *[
            F.struct(F.lit(i).alias("i"), side(F.lit(float(p)) * (F.col("total") - 1)).alias("rank"))
            for i, p in enumerate(probs)
            for side in (F.floor, F.ceil)
        ]
    )
    brackets = groups.select(
        "key", F.lit("").alias("bracket"), F.lit(0).cast("bigint").alias("before"), "size", targets.alias("ranks")
    )
    while (brackets.agg(F.max("size")).first()[0] or 0) > small:
        rows, brackets = _refined(rows, brackets, small, cuts)

    in_bracket = Window.partitionBy("key", "bracket").orderBy("value")
    found = (
        rows.join(brackets, ["key", "bracket"])
        .withColumn("last", F.col("before") + F.sum("n").over(in_bracket))
        .withColumn("first", F.col("last") - F.col("n"))
        .select("key", "value", F.inline(_wanted_between("first", "last")))
    )

    def quantile(i: int, p: float) -> Column:
        mine = F.when(F.col("i") == i, F.col("value"))
        at = F.lit(float(p)) * (F.col("total") - 1)
        return F.min(mine) + (F.max(mine) - F.min(mine)) * (at - F.floor(at))

    of_group = ["key", "lo", "hi", "total"]
    return (
        found.join(groups.drop("size"), "key")
        .groupBy(*of_group)
        .agg(F.array(*[quantile(i, p) for i, p in enumerate(probs)]).alias("quantiles"))
        .select(
            F.col("key").alias(group),
            F.col("lo").alias("min_value"),
            F.col("hi").alias("max_value"),
            F.col("total").alias("n"),
            "quantiles",
        )
    )


def error_quartiles(
    predictions: DataFrame,
    group: str,
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """Box-plot figures of the signed error per group.

    Whiskers are the last values within 1.5 times the interquartile range of
    the box; ``outliers`` counts the rows beyond them.
    """
    counts = materialise(value_counts(predictions, group, F.col(prediction) - F.col(label)), "errors")
    box = exact_quantiles(counts, (0.25, 0.5, 0.75)).select(
        "key",
        F.col("n").alias("size"),
        "min_value",
        "max_value",
        *[F.col("quantiles")[i].alias(c) for i, c in enumerate(("q1", "median", "q3"))],
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("value").between(F.col("q1") - reach, F.col("q3") + reach)
    fixed = ("size", "min_value", "q1", "median", "q3", "max_value")
    return (
        counts.join(box, "key")
        .groupBy("key", *fixed)
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
        )
        .select(
            F.col("key")[group].alias(group),
            F.col("size").alias("n"),
            F.col("min_value").alias("min"),
            "q1",
            "median",
            "q3",
            F.col("max_value").alias("max"),
            "whisker_low",
            "whisker_high",
            "outliers",
        )
    )


def actual_vs_predicted(
    predictions: DataFrame,
    group: str,
    width: float = 1.0,
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """Cells of the actual-versus-predicted cloud and how many rows each has.

    ``diagonal_end`` is the largest actual value, the end of the line of
    perfect prediction.
    """
    cells = predictions.groupBy(
        group,
        F.floor(F.col(label) / width).alias("actual_bin"),
        F.floor(F.col(prediction) / width).alias("predicted_bin"),
    ).agg(F.count("*").alias("n"), F.max(label).alias("cell_max"))
    end = cells.agg(F.max("cell_max")).scalar()
    return cells.withColumn("diagonal_end", end).drop("cell_max")


def group_weights(train: DataFrame, group: str) -> DataFrame:
    """Weight per group that gives every group the same total weight."""
    counts = train.groupBy(group).agg(F.count("*").alias("n"))
    every = counts.agg(F.struct(F.sum("n").alias("rows"), F.count("*").alias("groups"))).scalar()
    return counts.withColumn("weight", every["rows"] / (every["groups"] * F.col("n")))


def add_weights(train: DataFrame, weights: DataFrame, group: str) -> DataFrame:
    """Join the weights on. AQE broadcasts them if their real size allows it."""
    return train.join(
        weights.select(F.col(group).alias("_group"), "weight"),
        F.col(group).eqNullSafe(F.col("_group")),
        "left",
    ).drop("_group")


def calibrate_by_group(
    train_predictions: DataFrame,
    predictions: DataFrame,
    group: str,
    label: str = "label",
    prediction: str = "prediction",
) -> DataFrame:
    """Subtract each group's mean training error from its predictions.

    Adds ``calibrated``. A group training never saw is left as it is.
    """
    offsets = train_predictions.groupBy(F.col(group).alias("_group")).agg(
        F.avg(F.col(prediction) - F.col(label)).alias("_offset")
    )
    return (
        predictions.join(offsets, F.col(group).eqNullSafe(F.col("_group")), "left")
        .withColumn("calibrated", F.col(prediction) - F.coalesce("_offset", F.lit(0.0)))
        .drop("_group", "_offset")
    )
