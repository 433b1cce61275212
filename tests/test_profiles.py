from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from blotter.operators import profiles, summary
from blotter.operators.ranking import top_k
from blotter.sources.sinks import tsv_lines

SCHEMA = "id int, ts timestamp_ntz, category string, violent int, arrest int"


def at(*args):
    return dt.datetime(*args)


@pytest.fixture(scope="module")
def inc(spark):
    rows = [
        (1, at(2000, 12, 31, 23), "A", 0, 1),
        (2, at(2001, 1, 1, 0), "B", 1, 1),
        (3, at(2001, 1, 7, 0), "B", 1, 0),
        (4, at(2001, 3, 4, 5), "A", 0, 1),
        (5, at(2003, 3, 4, 5), None, 0, 0),
        (6, None, "C", 1, 1),
        (7, None, "", 0, 0),
    ]
    return spark.createDataFrame(rows, SCHEMA).cache()


def listed(df):
    return [tuple(r) for r in df.collect()]


def test_null_bucket_is_kept_on_request(inc):
    arrests = profiles.count_by_period(inc, "month", where="arrest", drop_null_bucket=False)
    assert listed(arrests) == [(None, 1), (1, 1), (3, 1), (12, 1)]
    assert listed(profiles.count_by_period(inc, "month", where="arrest")) == [
        (1, 1), (3, 1), (12, 1),
    ]


def test_where_takes_a_predicate(inc):
    got = profiles.count_by_period(inc, "year", where=F.col("category") == "B")
    assert listed(got) == [(2001, 2)]


def test_flags_complement_and_since(inc):
    got = profiles.count_by_period(inc, "year", flags=["violent"], complement=True, since=2001)
    assert got.columns == ["year", "n", "violent_n", "non_violent_n"]
    assert listed(got) == [(2001, 3, 2, 1), (2003, 1, 0, 1)]


def test_fill_buckets(inc):
    got = listed(profiles.count_by_period(inc, "month", flags=["violent"], fill_buckets=True))
    assert [g[0] for g in got] == list(range(1, 13))
    assert sum(g[1] for g in got) == 5
    assert got[1] == (2, 0, 0)
    assert len(listed(profiles.count_by_period(inc, "hour", fill_buckets=True))) == 24
    with pytest.raises(ValueError):
        profiles.count_by_period(inc, "year", fill_buckets=True)


def test_two_periods(inc):
    assert listed(profiles.count_by_period(inc, ["year", "month"])) == [
        (2000, 12, 1), (2001, 1, 2), (2001, 3, 1), (2003, 3, 1),
    ]


def test_category_counts(spark, inc):
    assert listed(profiles.category_counts(inc, "category", order="count")) == [
        ("A", 2), ("B", 2), ("C", 1),
    ]
    assert listed(profiles.category_counts(inc, "category", top=1)) == [("A", 2)]
    districts = spark.createDataFrame([("10",), ("9",), ("x",), ("9",)], "d string")
    assert listed(profiles.category_counts(districts, "d")) == [("x", 1), ("9", 2), ("10", 1)]


def test_shares(inc):
    shares = profiles.share_by_period(inc, "year", "violent")
    assert [(y, round(p, 4)) for y, _, _, p in listed(shares)] == [
        (2000, 0.0), (2001, 66.6667), (2003, 0.0),
    ]
    mean, pooled = listed(profiles.mean_share(shares, "violent"))[0]
    assert (round(mean, 4), round(pooled, 4)) == (22.2222, 40.0)


def test_tally_gives_the_same_profiles(inc):
    tally = profiles.calendar_tally(inc, "violent", ["category", "arrest"])
    for period in ("month", "hour", "dow", "year"):
        direct = profiles.count_by_period(inc, period, flags=["violent"], complement=True)
        summed = profiles.profile_of_tally(tally, period, "violent", complement=True)
        assert listed(summed) == listed(direct)
    assert listed(profiles.profile_of_tally(tally, "year", "violent", since=2001)) == listed(
        profiles.count_by_period(inc, "year", flags=["violent"], since=2001)
    )
    with pytest.raises(ValueError):
        profiles.profile_of_tally(tally, "hour", "violent", since=2001)
    for key, order in (("category", "count"), ("arrest", "numeric")):
        assert listed(profiles.counts_of_tally(tally, key, order)) == listed(
            profiles.category_counts(inc, key, order=order)
        )
    assert listed(profiles.counts_of_tally(tally, "category", top=2)) == [("A", 2), ("B", 2)]


def test_overall(inc):
    row = summary.overall_summary(inc).first()
    assert (row.total_n, row.violent_n, row.non_violent_n) == (7, 3, 4)
    assert round(row.violent_pct + row.non_violent_pct, 9) == 100


def test_peaks_take_the_first_of_a_tie(inc):
    got = {r.period: (r.bucket, r.n) for r in summary.peak_buckets(inc).collect()}
    assert got == {"month": (1, 2), "hour": (0, 2), "dow": (1, 3)}


def test_share_extremes(inc):
    row = summary.share_extremes(inc, "hour", "violent").first()
    assert (row.high_hour, row.high_pct, row.low_hour, row.low_pct) == (0, 100.0, 5, 0.0)


def test_change_and_top_share(inc):
    row = summary.yearly_change(inc).first()
    assert (row.first_year, row.first_year_n, row.last_year, row.last_year_n) == (2001, 3, 2003, 1)
    assert round(row.change_pct, 4) == -66.6667
    top = summary.top_share(inc).first()
    assert (top.category, top.n, top.total_n) == ("A", 2, 7)


def test_summary_agrees_with_its_parts(inc):
    row = summary.summary_report(inc).first()
    total = summary.overall_summary(inc).first()
    assert (row.total_n, row.violent_n, row.violent_pct) == (
        total.total_n, total.violent_n, total.violent_pct,
    )
    peaks = {r.period: (r.bucket, r.n) for r in summary.peak_buckets(inc).collect()}
    assert (row.peak_month, row.peak_month_n) == peaks["month"]
    assert (row.peak_dow, row.peak_dow_n) == peaks["dow"]
    assert (row.top_category, row.top_category_n) == ("A", 2)
    assert (row.first_year, row.last_year) == (2001, 2003)
    assert (row.high_hour, row.low_hour) == (0, 5)


def test_summary_of_nothing(inc):
    row = summary.summary_report(inc.limit(0)).first()
    assert (row.total_n, row.violent_n, row.violent_pct, row.peak_month) == (0, 0, None, None)
    text = summary.summary_text(summary.summary_report(inc.limit(0))).first().value
    assert text.splitlines()[0] == "Incidents: 0"


def test_summary_text(inc):
    text = summary.summary_text(summary.summary_report(inc)).first().value
    assert text.splitlines() == [
        "Incidents: 7",
        "Violent: 3, 42.86%",
        "Non-violent: 4, 57.14%",
        "Peak month: Jan, 2",
        "Peak hour: 00:00, 2",
        "Peak weekday: Sun, 3",
        "Most common category: A, 2, 28.57%",
        "First year: 2001, 3",
        "Last year: 2003, 1",
        "Change: -66.67%",
        "Highest violent share: 00:00, 100.00%",
        "Lowest violent share: 05:00, 0.00%",
    ]


def test_top_k_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 3), ("d", None)], "k string, n int")
    assert [r.k for r in top_k(df, "n", 3, ["k"]).collect()] == ["c", "a", "b"]


def test_tsv_lines(spark):
    df = spark.createDataFrame([("a", 1, None)], "k string, n int, x double")
    assert listed(tsv_lines(df)) == [("a\t1\tNone",)]
    assert listed(tsv_lines(df, ["n", "k"])) == [("1\ta",)]
