"""Text, CSV and parquet sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.roles import ROLES, Roles


def _text(df: DataFrame, name: str) -> Column:
    """A value as text; small numbers are written out, not as powers of ten."""
    value = F.col(f"`{name}`")
    if dict(df.dtypes)[name] not in ("double", "float"):
        return value.cast("string")
    small = (F.abs(value) < 1e-3) & (F.abs(value) >= 1e-4)
    plain = F.regexp_replace(value.cast("decimal(20,16)").cast("string"), "0+$", "")
    return F.when(small, plain).otherwise(value.cast("string"))


def tsv_lines(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One text column of tab-joined values; a null prints as ``None``."""
    cells = [F.coalesce(_text(df, c), F.lit("None")) for c in cols or df.columns]
    return df.select(F.concat_ws("\t", *cells).alias("value"))


def write_tsv(
    df: DataFrame,
    path: str,
    cols: Sequence[str] | None = None,
    mode: str = "errorifexists",
) -> None:
    tsv_lines(df, cols).write.mode(mode).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_text(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a frame of one text column as lines."""
    df.write.mode(mode).text(path)


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: str | None = "year",
    mode: str = "errorifexists",
    roles: Roles = ROLES,
) -> None:
    """Typed columnar copy, by default one directory per calendar year.

    The rebalance hint lets AQE gather each year into files of the advisory
    size and split a year that holds far more than its share, so neither many
    small files nor one giant writer task results.
    """
    if partition_by is None:
        df.write.mode(mode).parquet(path)
        return
    if partition_by not in df.columns:
        if partition_by != "year":
            raise ValueError(f"no column {partition_by!r} to partition by")
        df = df.withColumn("year", F.year(roles.ts))
    (
        df.hint("rebalance", partition_by)
        .write.mode(mode)
        .partitionBy(partition_by)
        .parquet(path)
    )
