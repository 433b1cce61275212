"""Totals, extremes and the one-row summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.calendar import bucket, bucket_name
from blotter.functions.cleaning import is_set, known, pct
from blotter.operators.profiles import calendar_tally, count_by_period, share_by_period
from blotter.roles import ROLES, Roles


def overall_summary(df: DataFrame, flag: str = ROLES.violent) -> DataFrame:
    """One row: all rows, flagged rows, the rest, and both percentages."""
    counts = df.agg(
        F.count("*").alias("total_n"),
        F.count_if(is_set(flag)).alias(f"{flag}_n"),
    )
    share = pct(f"{flag}_n", "total_n")
    return counts.select(
        "total_n",
        f"{flag}_n",
        (F.col("total_n") - F.col(f"{flag}_n")).alias(f"non_{flag}_n"),
        share.alias(f"{flag}_pct"),
        (100 - share).alias(f"non_{flag}_pct"),
    )


def _first_largest(value: Column, amount: Column, where: Column | None = None) -> Column:
    """Value with the largest amount; the smallest such value on ties."""
    order = F.struct(amount, -value)
    return F.max_by(value, order if where is None else F.when(where, order))


def _first_smallest(value: Column, amount: Column, where: Column | None = None) -> Column:
    order = F.struct(amount, value)
    return F.min_by(value, order if where is None else F.when(where, order))


def peak_buckets(
    df: DataFrame,
    periods: Sequence[str] = ("month", "hour", "dow"),
    roles: Roles = ROLES,
) -> DataFrame:
    """Busiest bucket of each period and its count, from one scan.

    Grouping sets count every period by itself, so a map task hands on one row
    per bucket and not one per combination of buckets.
    """
    names = list(periods)
    dated = df.filter(F.col(roles.ts).isNotNull())
    rows = dated.select(*[bucket(p, roles.ts).alias(p) for p in names])
    period = F.coalesce(*[F.when(F.grouping(p) == 0, p) for p in names])
    per_bucket = rows.groupingSets([[p] for p in names], *names).agg(
        period.alias("period"),
        F.coalesce(*names).alias("bucket"),
        F.count("*").alias("n"),
    )
    return per_bucket.groupBy("period").agg(
        _first_largest(F.col("bucket"), F.col("n")).alias("bucket"),
        F.max("n").alias("n"),
    )


def share_extremes(df: DataFrame, period: str, flag: str, roles: Roles = ROLES) -> DataFrame:
    """One row: buckets of the highest and lowest flagged percentage."""
    shares = share_by_period(df, period, flag, ordered=False, roles=roles)
    b, share = F.col(period), F.col(f"{flag}_pct")
    return shares.agg(
        _first_largest(b, share).alias(f"high_{period}"),
        F.max(share).alias("high_pct"),
        _first_smallest(b, share).alias(f"low_{period}"),
        F.min(share).alias("low_pct"),
    )


def period_change(yearly: DataFrame, year: str = "year", n: str = "n") -> DataFrame:
    """One row: first and last year of a yearly profile and the change in %."""
    ends = yearly.agg(
        F.min(year).alias("first_year"),
        F.min_by(n, year).alias("first_year_n"),
        F.max(year).alias("last_year"),
        F.max_by(n, year).alias("last_year_n"),
    )
    gain = F.col("last_year_n") - F.col("first_year_n")
    return ends.withColumn("change_pct", pct(gain, "first_year_n"))


def yearly_change(df: DataFrame, since: int = 2001, roles: Roles = ROLES) -> DataFrame:
    yearly = count_by_period(df, "year", since=since, ordered=False, roles=roles)
    return period_change(yearly)


def top_share(df: DataFrame, key: str = ROLES.category) -> DataFrame:
    """One row: the most frequent value and its share of **all** rows."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    order = F.when(known(key), F.struct(-F.col("n"), F.col(key)))
    top = counts.agg(
        F.min_by(key, order).alias(key),
        F.min_by("n", order).alias("n"),
        F.sum("n").alias("total_n"),
    )
    return top.withColumn("share_pct", pct("n", "total_n"))


def summary_report(
    df: DataFrame,
    flag: str = ROLES.violent,
    since: int = 2001,
    roles: Roles = ROLES,
) -> DataFrame:
    """Every value of the summary in one row, from one scan of the table."""
    tally = calendar_tally(df, flag, [roles.category], roles)
    return summary_of_tally(tally, flag, since, roles)


def summary_of_tally(
    tally: DataFrame,
    flag: str = ROLES.violent,
    since: int = 2001,
    roles: Roles = ROLES,
) -> DataFrame:
    """``summary_report`` from a tally that counts the category.

    Each cell is summed into every report line it feeds (all, month and year;
    hour and weekday; category); the lines are then reduced to one row.
    """
    hits = f"{flag}_n"

    def line(kind: str, number: Column | None = None, text: Column | None = None) -> Column:
        none_int, none_text = F.lit(None).cast("int"), F.lit(None).cast("string")
        return F.struct(
            F.lit(kind).alias("kind"),
            (none_int if number is None else number).alias("number"),
            (none_text if text is None else text.cast("string")).alias("label"),
        )

    recent = F.when(F.col("year") >= since, F.col("year"))
    part = F.col("part")
    lines = (
        F.when(
            part == "date",
            F.array(line("all"), line("month", F.col("month")), line("year", recent)),
        )
        .when(part == "clock", F.array(line("hour", F.col("hour")), line("dow", F.col("dow"))))
        .when(
            part == roles.category, F.array(line("category", text=F.col(roles.category)))
        )
    )
    per_line = (
        tally.select(F.inline(lines), "n", hits)
        .groupBy("kind", "number", "label")
        .agg(F.sum("n").alias("n"), F.sum(hits).alias("v"))
    )

    kind, number, label, n, v = (F.col(c) for c in ("kind", "number", "label", "n", "v"))
    share = pct(v, n)
    dated = number.isNotNull()

    def of(name: str) -> Column:
        return (kind == name) & dated

    top = F.when((kind == "category") & known(label), F.struct(-n, label))
    values = per_line.agg(
        F.coalesce(F.sum(F.when(kind == "all", n)), F.lit(0)).alias("total_n"),
        F.coalesce(F.sum(F.when(kind == "all", v)), F.lit(0)).alias(hits),
        *[
            c
            for p in ("month", "hour", "dow")
            for c in (
                _first_largest(number, n, of(p)).alias(f"peak_{p}"),
                F.max(F.when(of(p), n)).alias(f"peak_{p}_n"),
            )
        ],
        F.min_by(label, top).alias("top_category"),
        F.min_by(n, top).alias("top_category_n"),
        F.min(F.when(of("year"), number)).alias("first_year"),
        F.min_by(n, F.when(of("year"), number)).alias("first_year_n"),
        F.max(F.when(of("year"), number)).alias("last_year"),
        F.max_by(n, F.when(of("year"), number)).alias("last_year_n"),
        _first_largest(number, share, of("hour")).alias("high_hour"),
        F.max(F.when(of("hour"), share)).alias("high_hour_pct"),
        _first_smallest(number, share, of("hour")).alias("low_hour"),
        F.min(F.when(of("hour"), share)).alias("low_hour_pct"),
    )
    total_share = pct(hits, "total_n")
    return values.withColumns(
        {
            f"non_{hits}": F.col("total_n") - F.col(hits),
            f"{flag}_pct": total_share,
            f"non_{flag}_pct": 100 - total_share,
            "top_category_pct": pct("top_category_n", "total_n"),
            "change_pct": pct(F.col("last_year_n") - F.col("first_year_n"), "first_year_n"),
        }
    )


def summary_text(report: DataFrame, flag: str = ROLES.violent) -> DataFrame:
    """The one-row report as a single text value, one line per figure."""

    def count(c: str) -> Column:
        return F.format_number(F.col(c), 0)

    def percent(c: str) -> Column:
        return F.concat(F.format_number(F.col(c), 2), F.lit("%"))

    def clock(c: str) -> Column:
        return F.format_string("%02d:00", F.col(c))

    def entry(title: str, *parts: Column) -> Column:
        shown = [F.coalesce(p, F.lit("-")) for p in parts]
        return F.concat(F.lit(f"{title}: "), F.concat_ws(", ", *shown))

    return report.select(
        F.concat_ws(
            "\n",
            entry("Incidents", count("total_n")),
            entry("Violent", count(f"{flag}_n"), percent(f"{flag}_pct")),
            entry("Non-violent", count(f"non_{flag}_n"), percent(f"non_{flag}_pct")),
            entry("Peak month", bucket_name("month", "peak_month"), count("peak_month_n")),
            entry("Peak hour", clock("peak_hour"), count("peak_hour_n")),
            entry("Peak weekday", bucket_name("dow", "peak_dow"), count("peak_dow_n")),
            entry(
                "Most common category",
                F.col("top_category"),
                count("top_category_n"),
                percent("top_category_pct"),
            ),
            entry("First year", F.col("first_year").cast("string"), count("first_year_n")),
            entry("Last year", F.col("last_year").cast("string"), count("last_year_n")),
            entry("Change", percent("change_pct")),
            entry("Highest violent share", clock("high_hour"), percent("high_hour_pct")),
            entry("Lowest violent share", clock("low_hour"), percent("low_hour_pct")),
        ).alias("value")
    )
