"""Reading and normalising the incident table."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.functions.cleaning import (
    as_col,
    bool_flag,
    clean_district,
    parse_ts,
    violent_flag,
)
from blotter.roles import RAW_HEADERS, RAW_TS_FORMAT, ROLES, VIOLENT_14, Roles, text_schema


def read_incidents_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Header CSV with every column as text.

    Without a schema the header names the columns. Every file's header must
    hold the same names in the same order; Spark refuses files where it does
    not, rather than take columns for one another (``read_mixed_csv`` reads
    such files). ``corrupt_column`` (which the schema must
    hold) receives the text of rows with too few or too many fields.
    """
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", False)
    )
    if schema is not None:
        reader = reader.schema(schema)
    if corrupt_column:
        if schema is None or corrupt_column not in schema.fieldNames():
            raise ValueError("corrupt_column needs a schema that holds it")
        # A pruned reader counts only the fields it needs, and so would take a
        # short row for a complete one.
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column).option(
            "columnPruning", False
        )
    return reader.csv(path)


def well_formed(raw: DataFrame, corrupt_column: str) -> DataFrame:
    """Rows the CSV reader found complete.

    Spark refuses a query that reads the malformed-row column alone, such as a
    count; the second condition, which always holds, makes it read another.
    """
    other = next(c for c in raw.columns if c != corrupt_column)
    read_too = F.length(F.concat_ws("", f"`{other}`")) >= 0
    return raw.filter(F.col(corrupt_column).isNull() & read_too).drop(corrupt_column)


def _group_files(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """Files by header line; files without a line are left out.

    One pass over the text of the files, of which each task hands on one line
    per file; the driver gets the names of the files, as it does for any read.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.monotonically_increasing_id().alias("at"), "value").alias("line"),
        (F.col("_metadata.file_block_start") == 0).alias("leading"),
    )
    first = lines.filter("leading").groupBy("file").agg(F.min("line").alias("line"))
    groups: dict[str, list[str]] = {}
    for row in first.select("file", "line.value").collect():
        groups.setdefault(row["value"], []).append(row["file"])
    if not groups:
        raise ValueError(f"no header line under {path!r}")
    return groups


def _header_names(line: str) -> list[str]:
    names = next(csv.reader([line.removeprefix("\ufeff")]))
    if len(set(names)) < len(names):
        raise ValueError(f"a header names a column twice: {line!r}")
    return names


def read_mixed_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Header CSV files whose headers differ, as one table with every column as text.

    Files are grouped by their header line and each group gets a reader of its
    own; the groups are united by name. Columns may stand in any order, and one
    that a file lacks is null there. The plan has one scan per distinct header,
    not per file. A header that names a column twice is refused.
    """
    parts = [
        read_incidents_csv(spark, sorted(files), text_schema(*_header_names(line)))
        for line, files in sorted(_group_files(spark, path).items())
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# Column that holds the text of a malformed row while good rows are separated.
MALFORMED = "_malformed"


def reject_reason(record: Column | str, fields: Column) -> Column:
    """Why the CSV reader could not take a record as a row of so many fields."""
    n = field_count(record)
    return (
        F.when(_unquoted(record).contains('"'), "unclosed quote")
        .when(n < fields, "too few fields")
        .when(n > fields, "too many fields")
        .otherwise("unreadable")
    )


def _unquoted(record: Column | str) -> Column:
    """The record without its quoted parts, whose commas part no fields."""
    return F.regexp_replace(as_col(record), r'"(?:[^"\\]|\\.)*"', "")


def field_count(record: Column | str) -> Column:
    plain = _unquoted(record)
    return F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1


def read_with_rejects(
    spark: SparkSession,
    path: str | list[str],
    names: Sequence[str] | None = None,
    mixed: bool = False,
    observation: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Header CSV as (good rows, rejects).

    Good rows have every column as text. Rejects are the rows with too few or
    too many fields: ``file``, ``reason``, ``fields`` (how many there are) and
    ``record`` (the text of the row). Both are lazy and read the files.
    ``mixed`` allows files of differing headers. ``observation`` counts
    ``rows`` and ``malformed`` while the good rows are read.
    """
    if mixed:
        parts = [
            read_with_rejects(spark, sorted(files), _header_names(line))
            for line, files in sorted(_group_files(spark, path).items())
        ]
        good, rejects = (
            reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), side) for side in zip(*parts)
        )
        return good, rejects
    columns = list(names or read_incidents_csv(spark, path).columns)
    raw = read_incidents_csv(spark, path, text_schema(*columns, corrupt=MALFORMED), MALFORMED)
    # The reader must be asked for another column beside the malformed one.
    rejects = raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col(MALFORMED).alias("record"),
        F.col(f"`{columns[0]}`").alias("first"),
    ).filter(F.col("record").isNotNull() & (F.length(F.concat_ws("", "first")) >= 0))
    if observation is not None:
        raw = raw.observe(
            observation,
            F.count("*").alias("rows"),
            F.count_if(F.col(MALFORMED).isNotNull()).alias("malformed"),
        )
    return well_formed(raw, MALFORMED), rejects.select(
        "file",
        reject_reason("record", F.lit(len(columns))).alias("reason"),
        field_count("record").alias("fields"),
        "record",
    )


def normalise(
    raw: DataFrame,
    violent: Iterable[str] = VIOLENT_14,
    null_as: int | None = None,
    headers: Roles = RAW_HEADERS,
    ts_format: str = RAW_TS_FORMAT,
) -> DataFrame:
    """Text columns to the typed incident table, in one projection."""

    def raw_col(name: str):
        return F.col(f"`{name}`")

    category = raw_col(headers.category)
    return raw.select(
        F.trim(raw_col(headers.id)).try_cast("bigint").alias(ROLES.id),
        parse_ts(raw_col(headers.ts), ts_format).alias(ROLES.ts),
        raw_col(headers.block).alias(ROLES.block),
        raw_col(headers.unit).alias(ROLES.unit),
        clean_district(raw_col(headers.district)).alias(ROLES.district),
        category.alias(ROLES.category),
        violent_flag(category, violent, null_as).alias(ROLES.violent),
        bool_flag(raw_col(headers.arrest)).alias(ROLES.arrest),
        bool_flag(raw_col(headers.domestic)).alias(ROLES.domestic),
    )
