"""Column expressions that turn raw text into typed values."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter.roles import RAW_TS_FORMAT, Era


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(c: Column | str, fmt: str = RAW_TS_FORMAT) -> Column:
    """12-hour timestamp text to a wall-clock timestamp; unreadable text gives null.

    Run in a UTC session: in other zones the hour that daylight saving skips
    cannot be read as it is written.
    """
    return F.try_to_timestamp(as_col(c), F.lit(fmt)).cast("timestamp_ntz")


def violent_flag(
    category: Column | str, members: Iterable[str], null_as: int | None = None
) -> Column:
    """1 if the category is in ``members``, else 0; ``null_as`` for a null one."""
    flag = as_col(category).isin(list(members)).cast("int")
    return flag if null_as is None else F.coalesce(flag, F.lit(null_as))


def bool_flag(c: Column | str) -> Column:
    """Text or boolean to 0/1; anything that is no boolean gives null."""
    return as_col(c).try_cast("boolean").cast("int")


def is_set(c: Column | str) -> Column:
    """Predicate that holds where a 0/1 or boolean flag is set."""
    return as_col(c).cast("boolean")


def clean_district(c: Column | str, lo: int = 1, hi: int = 25) -> Column:
    """Text such as ``6``, ``06`` or `` 6.0`` to an int in [lo, hi], else null."""
    text = F.trim(as_col(c).cast("string"))
    # A trailing type letter is a number to the JVM but not to a reader.
    plain = F.when(~F.lower(F.right(text, F.lit(1))).isin("d", "f"), text)
    number = plain.try_cast("double").try_cast("int")
    return F.when(number.between(lo, hi), number)


def district_prefix(unit: Column | str, drop: int = 2) -> Column:
    """Unit code without its last ``drop`` characters."""
    u = as_col(unit)
    return F.left(u, F.length(u) - drop)


def band(
    c: Column | str,
    cuts: Sequence[tuple[float, str]],
    other: str,
    unknown: str | None = "Unknown",
) -> Column:
    """Label of the first cut that is not below the value.

    ``unknown`` labels nulls; give None to let them fall through to ``other``.
    """
    value = as_col(c)
    label = F.when(value.isNull(), F.lit(unknown)) if unknown is not None else None
    for limit, name in cuts:
        hit = value <= limit
        label = F.when(hit, F.lit(name)) if label is None else label.when(hit, F.lit(name))
    return F.lit(other) if label is None else label.otherwise(F.lit(other))


def era_label(year: Column | str, eras: Sequence[Era]) -> Column:
    """Label of the era that holds the year; null outside all of them."""
    y = as_col(year)
    first, *rest = eras
    label = F.when(y.between(first.first, first.last), F.lit(first.label))
    for era in rest:
        label = label.when(y.between(era.first, era.last), F.lit(era.label))
    return label


def pct(part: Column | str, whole: Column | str) -> Column:
    """``part`` as a percentage of ``whole``; null if ``whole`` is 0."""
    return F.try_divide(as_col(part), as_col(whole)) * 100


def known(c: Column | str) -> Column:
    """Predicate: not null and not empty text."""
    value = as_col(c)
    return value.isNotNull() & (value.cast("string") != "")


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(as_col(c), F.lit(0))
