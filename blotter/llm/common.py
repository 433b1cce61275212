"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The white space of the contracts: blank and \t \n \v \f \r; it parts words.
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    The optimizer repeats an expression wherever a lambda mentions it; binding
    it to a lambda variable is what keeps it from being computed per element.
    """
    return F.transform(F.array(value), body)[0]


def id_hash(doc_id: str = "doc_id") -> Column:
    """CRC-32 of the id as text; the contracts take folds from it."""
    return F.crc32(F.col(doc_id).cast("string"))


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under fixed names, so that no other name can clash."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def unused(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
