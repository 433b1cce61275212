"""Counts and yearly means per era, and the paired t-statistic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.calendar import between_years
from blotter.functions.cleaning import as_col, era_label
from blotter.functions.special import student_p
from blotter.roles import ROLES, Era, Roles
from blotter.runtime import materialise


def _labelled(df: DataFrame, group: str, eras: Sequence[Era], roles: Roles) -> DataFrame:
    """Group and era of every row that has both, read from two columns."""
    span = between_years(df, min(e.first for e in eras), max(e.last for e in eras), roles)
    return span.select(
        F.col(group), era_label(F.year(roles.ts), eras).alias("era")
    ).filter(F.col(group).isNotNull() & F.col("era").isNotNull())


def era_counts(
    df: DataFrame, group: str, eras: Sequence[Era], roles: Roles = ROLES
) -> DataFrame:
    """Rows per (group, era)."""
    return _labelled(df, group, eras, roles).groupBy(group, "era").agg(F.count("*").alias("n"))


def era_means(
    df: DataFrame, group: str, eras: Sequence[Era], roles: Roles = ROLES
) -> DataFrame:
    """Mean rows per year of each era, one column per era; an absent era is 0."""
    return (
        _labelled(df, group, eras, roles)
        .groupBy(group)
        .agg(*[(F.count_if(F.col("era") == e.label) / e.years).alias(e.label) for e in eras])
    )


def era_counts_by_table(
    df: DataFrame, group: str, eras: DataFrame, roles: Roles = ROLES
) -> DataFrame:
    """Rows per (group, era) for a table of eras: ``label``, ``first``, ``last``.

    Eras may be many and may overlap; a row counts for each era that holds its
    year, and once for a label that has several spans. A null end is open. The
    incidents are counted by year first; the eras are then expanded to the
    years between the first and last of the incidents, and the two meet in an
    equi-join of small tables.
    """
    yearly = (
        df.filter(F.col(group).isNotNull() & F.col(roles.ts).isNotNull())
        .groupBy(group, F.year(roles.ts).alias("year"))
        .agg(F.count("*").alias("n"))
    )
    yearly = materialise(yearly, "yearly")
    span = yearly.agg(F.struct(F.min("year").alias("first"), F.max("year").alias("last"))).scalar()
    first = F.greatest(F.coalesce("first", span["first"]), span["first"])
    last = F.least(F.coalesce("last", span["last"]), span["last"])
    years = (
        eras.withColumns({"_from": first, "_to": last})
        .filter(F.col("_from") <= F.col("_to"))
        .select(F.col("label").alias("era"), F.explode(F.sequence("_from", "_to")).alias("year"))
        .distinct()
    )
    return yearly.join(years, "year").groupBy(group, "era").agg(F.sum("n").alias("n"))


def paired_t(df: DataFrame, a: Column | str, b: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """Paired test of a − b, one row, or one per value of ``by``.

    Columns n, mean difference, the statistic t, its degrees of freedom and
    the two-sided p. The statistic and p are null with fewer than two pairs or
    no spread.
    """
    d = F.col("d")
    stats = df.select(*by, (as_col(a) - as_col(b)).alias("d")).groupBy(*by).agg(
        F.count(d).alias("n"),
        F.avg(d).alias("mean_diff"),
        F.when(F.min(d) != F.max(d), F.stddev_samp(d)).alias("spread"),
    )
    error = F.col("spread") / F.sqrt(F.col("n"))
    return stats.select(
        *by,
        "n",
        "mean_diff",
        F.try_divide(F.col("mean_diff"), error).alias("t"),
        F.when(F.col("n") > 0, F.col("n") - 1).alias("df"),
    ).withColumn("p", student_p("t", "df"))
