"""Counts and shares by calendar bucket and by category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.calendar import BUCKET_RANGE, bucket, since as since_year
from blotter.functions.cleaning import as_col, is_set, known, pct
from blotter.operators.ranking import top_k
from blotter.roles import ROLES, Roles


def _names(periods: str | Sequence[str]) -> list[str]:
    return [periods] if isinstance(periods, str) else list(periods)


def _selected(
    df: DataFrame,
    where: Column | str | None,
    since: int | None,
    drop_null_bucket: bool,
    roles: Roles,
) -> DataFrame:
    if where is not None:
        df = df.filter(is_set(where) if isinstance(where, str) else where)
    if since is not None:
        return since_year(df, since, roles)
    return df.filter(F.col(roles.ts).isNotNull()) if drop_null_bucket else df


def count_by_period(
    df: DataFrame,
    periods: str | Sequence[str],
    *,
    where: Column | str | None = None,
    flags: Sequence[str] = (),
    complement: bool = False,
    since: int | None = None,
    drop_null_bucket: bool = True,
    fill_buckets: bool = False,
    ordered: bool = True,
    roles: Roles = ROLES,
) -> DataFrame:
    """Rows per calendar bucket, in bucket order unless ``ordered`` is off.

    Columns: the buckets, ``n``, then ``<flag>_n`` per 0/1 flag and, with
    ``complement``, ``non_<flag>_n``. ``where`` is a flag column or predicate.
    ``since`` keeps rows of that year on. With ``drop_null_bucket=False``
    undated rows form a null bucket. ``fill_buckets`` adds absent months,
    hours or weekdays with zeros.
    """
    names = _names(periods)
    rows = _selected(df, where, since, drop_null_bucket, roles).select(
        *[bucket(p, roles.ts).alias(p) for p in names],
        *flags,
        F.lit(1).alias("_rows"),
    )
    if fill_buckets:
        rows = rows.unionByName(_empty_buckets(rows, names), allowMissingColumns=True)
    total = F.sum("_rows")
    measures = [total.alias("n")]
    for flag in flags:
        hits = F.coalesce(F.sum(flag), F.lit(0))
        measures.append(hits.alias(f"{flag}_n"))
        if complement:
            measures.append((total - hits).alias(f"non_{flag}_n"))
    profile = rows.groupBy(*names).agg(*measures)
    return profile.orderBy(*names) if ordered else profile


def _empty_buckets(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per bucket of a recurring period that counts as no incident.

    Counted along with the incidents, these rows make every bucket appear
    without a join or a second aggregation.
    """
    if len(names) != 1 or names[0] not in BUCKET_RANGE:
        raise ValueError("only a single month, hour or dow profile has a fixed bucket list")
    first, last = BUCKET_RANGE[names[0]]
    return rows.sparkSession.range(first, last + 1).select(
        F.col("id").cast("int").alias(names[0]), F.lit(0).alias("_rows")
    )


def category_counts(
    df: DataFrame,
    key: Column | str,
    *,
    name: str | None = None,
    order: str = "numeric",
    top: int | None = None,
) -> DataFrame:
    """Rows per value of ``key``; null and empty values are left out.

    ``order`` is ``numeric`` (as an integer, then as text) or ``count``
    (largest first). ``top`` keeps that many of the largest.
    """
    label = name or (key if isinstance(key, str) else "key")
    counts = (
        df.select(as_col(key).alias(label))
        .filter(known(label))
        .groupBy(label)
        .agg(F.count("*").alias("n"))
    )
    return _ordered_counts(counts, label, order, top)


def _ordered_counts(counts: DataFrame, label: str, order: str, top: int | None) -> DataFrame:
    if top is not None:
        return top_k(counts, "n", top, ties=[label])
    if order == "count":
        return counts.orderBy(F.col("n").desc(), label)
    return counts.orderBy(F.col(label).cast("string").try_cast("int"), label)


def share_by_period(
    df: DataFrame,
    periods: str | Sequence[str],
    flag: str,
    *,
    since: int | None = None,
    ordered: bool = True,
    roles: Roles = ROLES,
) -> DataFrame:
    """``count_by_period`` plus the percentage of flagged rows per bucket."""
    profile = count_by_period(
        df, periods, flags=[flag], since=since, ordered=ordered, roles=roles
    )
    return add_share_pct(profile, flag)


def add_share_pct(profile: DataFrame, flag: str) -> DataFrame:
    return profile.withColumn(f"{flag}_pct", pct(f"{flag}_n", "n"))


def mean_share(shares: DataFrame, flag: str) -> DataFrame:
    """One row: plain mean of the bucket percentages, and the pooled one."""
    return shares.agg(
        F.avg(f"{flag}_pct").alias("mean_pct"),
        pct(F.sum(f"{flag}_n"), F.sum("n")).alias("pooled_pct"),
    )


def calendar_tally(
    df: DataFrame,
    flag: str,
    keys: Sequence[str] = (),
    roles: Roles = ROLES,
) -> DataFrame:
    """Counts by (year, month), by (weekday, hour) and by each of ``keys``.

    One pass over the table from which every profile, the distributions and
    the whole summary can be summed up. ``part`` is ``date``, ``clock`` or the
    key that a row counts. Grouping sets keep the parts apart: a map task
    hands on some hundred cells (twelve per year, 168, one per key value),
    where their product would be nearly as many cells as it has rows. Undated
    rows have null buckets.
    """
    periods = ["year", "month", "dow", "hour"]
    rows = df.select(
        *[bucket(p, roles.ts).alias(p) for p in periods],
        *keys,
        F.col(flag).alias("_flag"),
    )
    part = F.when(F.grouping("year") == 0, "date").when(F.grouping("hour") == 0, "clock")
    for key in keys:
        part = part.when(F.grouping(key) == 0, key)
    sets = [["year", "month"], ["dow", "hour"], *[[key] for key in keys]]
    return rows.groupingSets(sets, *periods, *keys).agg(
        part.alias("part"),
        F.count("*").alias("n"),
        F.coalesce(F.sum("_flag"), F.lit(0)).alias(f"{flag}_n"),
    )


# The part of a tally that holds each period.
TALLY_PART = {"year": "date", "month": "date", "dow": "clock", "hour": "clock"}


def profile_of_tally(
    tally: DataFrame,
    period: str,
    flag: str,
    *,
    complement: bool = False,
    since: int | None = None,
    drop_null_bucket: bool = True,
) -> DataFrame:
    """The profile ``count_by_period`` gives, summed from a tally."""
    rows = tally.filter(F.col("part") == TALLY_PART[period])
    if drop_null_bucket:
        rows = rows.filter(F.col(period).isNotNull())
    if since is not None:
        if TALLY_PART[period] != "date":
            raise ValueError("only the date part of a tally knows the year")
        rows = rows.filter(F.col("year") >= since)
    hits = F.sum(f"{flag}_n")
    measures = [F.sum("n").alias("n"), hits.alias(f"{flag}_n")]
    if complement:
        measures.append((F.sum("n") - hits).alias(f"non_{flag}_n"))
    return rows.groupBy(period).agg(*measures).orderBy(period)


def counts_of_tally(
    tally: DataFrame, key: str, order: str = "numeric", top: int | None = None
) -> DataFrame:
    """What ``category_counts`` gives, from a tally that counts the key."""
    counts = tally.filter((F.col("part") == key) & known(key)).select(key, "n")
    return _ordered_counts(counts, key, order, top)
