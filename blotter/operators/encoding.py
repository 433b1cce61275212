"""Categories and scalars as coordinates of a sparse feature vector.

The vector of a row has one slot for every value of every category, in the
order of the dictionary, and then one for every scalar. A row is kept as the
slots of its categories, whose value is 1, and its scalars.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.operators.ranking import global_rank


def category_index(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Dictionary of the categories: rows (column, value, index, n).

    The most frequent value of a column has index 0, ties are in text order.
    Nulls are no value. Counting is one aggregation over all columns, and the
    index is the place in a distributed sort, so neither a task nor the driver
    holds all values of a column.
    """
    entries = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]
    )
    counts = (
        df.select(F.inline(entries))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    ranked = global_rank(counts, "column", [F.col("n").desc(), F.col("value").asc()], "index")
    return ranked.select("column", "value", F.col("index").cast("int").alias("index"), "n")


def _sizes(dictionary: DataFrame, categories: Sequence[str]) -> Column:
    """Struct of the number of values of each category."""
    counts = [F.count_if(F.col("column") == c).cast("int").alias(c) for c in categories]
    return dictionary.agg(F.struct(*counts)).scalar()


def encoded(
    rows: DataFrame,
    dictionary: DataFrame,
    categories: Sequence[str],
    features: Sequence[str],
    invalid: str = "error",
) -> DataFrame:
    """``rows`` with ``hot`` (slots that hold 1), ``scalars`` and ``first_scalar``.

    A value that the dictionary does not know, or a null, has no slot. Rows
    with a null scalar fail the job, or drop if ``invalid`` is ``skip``. One
    equi-join per category; AQE broadcasts the entries of a category if their
    real size allows it.
    """
    if invalid not in ("error", "skip"):
        raise ValueError(f"invalid must be 'error' or 'skip', not {invalid!r}")
    sizes = _sizes(dictionary, categories)
    complete = reduce(and_, [F.col(f).isNotNull() for f in features], F.lit(True))
    if invalid == "skip":
        rows = rows.filter(complete)
    slots, offset = [], F.lit(0)
    for i, c in enumerate(categories):
        entries = dictionary.filter(F.col("column") == c).select(
            F.col("value").alias(f"_value{i}"), F.col("index").alias(f"_index{i}")
        )
        rows = rows.join(entries, F.col(c).cast("string") == F.col(f"_value{i}"), "left")
        slots.append(F.col(f"_index{i}") + offset)
        offset = offset + sizes[c]
    scalars = F.array(*[F.col(f).cast("double") for f in features])
    if invalid == "error":
        scalars = F.when(complete, scalars).otherwise(F.raise_error(F.lit("a scalar feature is null")))
    return rows.withColumns(
        {
            "hot": F.array_compact(F.array(*slots)),
            "scalars": scalars,
            "first_scalar": reduce(add, [sizes[c] for c in categories], F.lit(0)),
        }
    ).drop(*[f"_{part}{i}" for part in ("value", "index") for i in range(len(categories))])


def slot_value(slot: Column) -> Column:
    """Value at a slot of an encoded row."""
    is_hot = F.array_contains("hot", slot).cast("double")
    return F.when(slot >= F.col("first_scalar"), F.get("scalars", slot - F.col("first_scalar"))).otherwise(is_hot)


def feature_slots(
    rows: DataFrame,
    dictionary: DataFrame,
    keys: Sequence[str],
    categories: Sequence[str],
    features: Sequence[str],
    invalid: str = "error",
) -> DataFrame:
    """The vectors in coordinate form: (keys, slot, value) of all that is not 0."""
    ones = F.transform("hot", lambda s: F.struct(s.alias("slot"), F.lit(1.0).alias("value")))
    others = F.transform(
        "scalars", lambda v, i: F.struct((F.col("first_scalar") + i).alias("slot"), v.alias("value"))
    )
    return (
        encoded(rows, dictionary, categories, features, invalid)
        .select(*keys, F.inline(F.concat(ones, others)))
        .filter(F.col("value") != 0)
    )
