"""Unit-by-week panel, its time-series features and the train/test split.

The panel is the incidents counted per key and week. However hot a unit is, it
keeps one row per week, so the windows below sort at most a few thousand rows
per unit and key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from blotter.functions.calendar import week_keys, week_monday
from blotter.functions.cleaning import zero_if_null
from blotter.roles import ROLES, Roles
from blotter.runtime import materialise

TIME_KEYS = ("year", "week")


def weekly_panel(
    df: DataFrame,
    keys: Sequence[str] = (ROLES.unit,),
    week_mode: str = "iso",
    roles: Roles = ROLES,
) -> DataFrame:
    """Counts and rates per (keys, year, week); undated incidents drop."""
    year, week = week_keys(roles.ts, week_mode)
    return (
        df.filter(F.col(roles.ts).isNotNull())
        .groupBy(*keys, year.alias("year"), week.alias("week"))
        .agg(
            F.count(roles.id).alias("total"),
            zero_if_null(F.sum(roles.violent)).alias("violent"),
            zero_if_null(F.avg(roles.arrest)).alias("arrest_rate"),
            zero_if_null(F.avg(roles.domestic)).alias("domestic_rate"),
        )
    )


def series(keys: Sequence[str]) -> WindowSpec:
    """Rows of one series in time order."""
    return Window.partitionBy(*keys).orderBy(*TIME_KEYS)


def densify(panel: DataFrame, keys: Sequence[str] = (ROLES.unit,)) -> DataFrame:
    """Add zero rows for the weeks a series skips between its first and last.

    Needs ISO week keys. Each row is repeated for the weeks up to the next row
    of its series, which needs no join and no second shuffle: the features
    computed next use the same partitioning.
    """
    monday = week_monday("year", "week")
    following = F.lead(monday).over(series(keys))
    last_filled = F.coalesce(F.date_sub(following, 7), monday)
    weeks = panel.withColumns({"_monday": monday, "_last": last_filled}).withColumn(
        "_at", F.explode(F.expr("sequence(_monday, _last, interval 7 days)"))
    )
    seen = F.col("_at") == F.col("_monday")
    year, week = week_keys("_at", "iso")
    values = [c for c in panel.columns if c not in (*keys, *TIME_KEYS)]
    return weeks.select(
        *keys,
        year.alias("year"),
        week.alias("week"),
        *[F.when(seen, F.col(c)).otherwise(0).alias(c) for c in values],
    )


def week_calendar(df: DataFrame, week_mode: str = "iso", roles: Roles = ROLES) -> DataFrame:
    """The week keys of all days from the first incident to the last.

    Rows (year, week, position, monday): ``position`` numbers the keys in their
    order, ``monday`` is the Monday of a key's earliest day. Calendar keys need
    it: week 53 of 2005 holds the first two days of that year and yet comes
    last, and week 1 of 2018 holds its last day as well. The table has one row
    per week, so one task can number it; the incidents give it two dates.
    """
    span = df.agg(F.min(F.to_date(roles.ts)).alias("first"), F.max(F.to_date(roles.ts)).alias("last"))
    days = span.filter(F.col("first").isNotNull()).select(F.explode(F.sequence("first", "last")).alias("day"))
    year, week = week_keys("day", week_mode)
    keys = days.groupBy(year.alias("year"), week.alias("week")).agg(
        F.min(F.trunc("day", "week")).alias("monday")
    )
    position = F.row_number().over(Window.orderBy(*TIME_KEYS)) - 1
    return materialise(keys.select(*TIME_KEYS, position.alias("position"), "monday"), "calendar")


def add_calendar(panel: DataFrame, calendar: DataFrame) -> DataFrame:
    """Carry ``position`` and ``monday`` of each row's week."""
    return panel.join(calendar, list(TIME_KEYS))


def densify_by_calendar(
    panel: DataFrame, calendar: DataFrame, keys: Sequence[str] = (ROLES.unit,)
) -> DataFrame:
    """Add zero rows for the weeks of the calendar that a series skips.

    For week keys of any mode; ``densify`` needs no calendar but ISO keys. The
    result carries ``position`` and ``monday``.
    """
    values = [c for c in panel.columns if c not in (*keys, *TIME_KEYS)]
    dated = panel.join(calendar.select(*TIME_KEYS, F.col("position").alias("_own")), list(TIME_KEYS))
    following = F.lead("_own").over(Window.partitionBy(*keys).orderBy("_own"))
    filled = dated.withColumn("_last", F.coalesce(following - 1, F.col("_own"))).withColumn(
        "position", F.explode(F.sequence("_own", "_last"))
    )
    seen = F.col("position") == F.col("_own")
    return (
        filled.select(*keys, "position", *[F.when(seen, F.col(c)).otherwise(0).alias(c) for c in values])
        .join(calendar, "position")
        .select(*keys, *TIME_KEYS, *values, "position", "monday")
    )


def lag_columns(col: str, steps: Sequence[int], w: WindowSpec) -> dict[str, Column]:
    return {f"{col}_lag_{k}": F.lag(col, k, 0).over(w) for k in steps}


def rolling_columns(col: str, size: int, w: WindowSpec) -> dict[str, Column]:
    mean = F.avg(col).over(w.rowsBetween(-size, -1))
    return {f"{col}_mean_{size}": F.coalesce(mean, F.lit(0.0))}


def add_lags(
    panel: DataFrame, col: str, steps: Sequence[int], keys: Sequence[str] = (ROLES.unit,)
) -> DataFrame:
    """``<col>_lag_<k>``: the value ``k`` rows back, 0 before the start."""
    return panel.withColumns(lag_columns(col, steps, series(keys)))


def add_rolling(
    panel: DataFrame, col: str, size: int, keys: Sequence[str] = (ROLES.unit,)
) -> DataFrame:
    """``<col>_mean_<size>``: mean of the previous rows, 0 on the first."""
    return panel.withColumns(rolling_columns(col, size, series(keys)))


def add_label(
    panel: DataFrame, col: str = "violent", step: int = 1, keys: Sequence[str] = (ROLES.unit,)
) -> DataFrame:
    """``label``: the value ``step`` rows ahead; null at the end of a series."""
    return panel.withColumn("label", F.lead(col, step).over(series(keys)))


def add_time_index(panel: DataFrame, keys: Sequence[str] = (ROLES.unit,)) -> DataFrame:
    """``time_index``: 0-based position in the series."""
    return panel.withColumn("time_index", F.row_number().over(series(keys)) - 1)


def add_share(panel: DataFrame) -> DataFrame:
    """Violent share of the total, and total per violent incident; 0 if undefined."""
    total, violent = F.col("total"), F.col("violent")
    return panel.withColumns(
        {
            "violent_share": F.when(total != 0, violent / total).otherwise(0.0),
            "total_per_violent": F.when(violent != 0, total / violent).otherwise(0.0),
        }
    )


def add_season_flags(panel: DataFrame, week: str = "week") -> DataFrame:
    """0/1 flags of summer, winter and the holiday season by week number."""
    w = F.col(week)
    seasons = {
        "is_summer": w.between(22, 35),
        "is_winter": (w >= 48) | (w <= 9),
        "is_holiday_season": (w >= 47) | (w <= 2),
    }
    return panel.withColumns({k: F.when(c, 1).otherwise(0) for k, c in seasons.items()})


def add_trend(panel: DataFrame, col: str = "total") -> DataFrame:
    """Relative change against the previous row; 0 if that row is 0 or absent."""
    last = F.col(f"{col}_lag_1")
    change = F.when(last > 0, (F.col(col) - last) / last).otherwise(0.0)
    return panel.withColumn("trend", change)


def _with_label(panel: DataFrame, columns: dict[str, Column], w: WindowSpec) -> DataFrame:
    """Add window columns, label and time index together; drop unlabelled rows.

    All of them share one sort. The rows without a label end their series, so
    the position counted before they drop is the position after.
    """
    columns = {
        **columns,
        "label": F.lead("violent", 1).over(w),
        "time_index": F.row_number().over(w) - 1,
    }
    return panel.withColumns(columns).filter(F.col("label").isNotNull())


def features_full(panel: DataFrame, keys: Sequence[str] = (ROLES.unit,)) -> DataFrame:
    """All scalar inputs of the full forecast, with label and time index."""
    w = series(keys)
    columns = {
        **lag_columns("total", (1, 2, 3), w),
        **lag_columns("violent", (1, 2), w),
        **rolling_columns("total", 3, w),
        **rolling_columns("violent", 3, w),
        **rolling_columns("total", 4, w),
    }
    return add_trend(add_season_flags(add_share(_with_label(panel, columns, w))))


def features_base(
    panel: DataFrame, keys: Sequence[str] = (ROLES.unit, ROLES.district)
) -> DataFrame:
    """Scalar inputs of the smaller forecast that the fairness audit uses."""
    w = series(keys)
    return add_share(_with_label(panel, lag_columns("total", (1,), w), w))


def split_by_index(features: DataFrame, fraction: float = 0.8) -> DataFrame:
    """Mark rows ``train`` or ``test`` in the column ``split``.

    The cutoff is that fraction of the largest time index of any series, so a
    short series may be all training data. The scalar subquery reads the
    features again; pass them materialised if they are costly.
    """
    cutoff = features.agg(F.floor(F.max("time_index") * F.lit(float(fraction)))).scalar()
    return _mark(features, F.col("time_index") <= cutoff)


def split_by_date(features: DataFrame, fraction: float = 0.8) -> DataFrame:
    """Mark rows by a date that is the same for every series.

    The cutoff lies that fraction of the way from the first week to the last.
    The date of a row is its ``monday`` if it carries one (``add_calendar``),
    else that of its ISO week.
    """
    monday = F.col("monday") if "monday" in features.columns else week_monday("year", "week")
    days = F.date_diff(F.max(monday), F.min(monday)) * F.lit(float(fraction))
    cutoff = features.agg(F.date_add(F.min(monday), F.floor(days).cast("int"))).scalar()
    return _mark(features, monday <= cutoff)


def _mark(features: DataFrame, is_train: Column) -> DataFrame:
    return features.withColumn("split", F.when(is_train, "train").otherwise("test"))


def train_part(split: DataFrame) -> DataFrame:
    return split.filter(F.col("split") == "train")


def test_part(split: DataFrame) -> DataFrame:
    return split.filter(F.col("split") == "test")
