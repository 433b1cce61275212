from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from blotter.operators import panel as pn

SCHEMA = "id bigint, ts timestamp_ntz, unit string, district int, violent int, arrest int, domestic int"


@pytest.fixture(scope="module")
def inc(spark):
    rows = [
        (1, dt.datetime(2018, 12, 31), "u", 1, 1, 1, 0),
        (2, dt.datetime(2019, 1, 1), "u", 1, 0, None, 0),
        (None, dt.datetime(2019, 1, 2), "u", 1, None, 0, 1),
        (4, dt.datetime(2018, 1, 1), "u", 1, 1, 0, 0),
        (5, dt.datetime(2019, 1, 29), "u", 2, 1, 0, 0),
        (6, None, "u", 1, 1, 1, 1),
        (7, dt.datetime(2005, 1, 1), "v", 3, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA).cache()


def keyed(df, *values):
    return {(r.unit, r.year, r.week): tuple(r[v] for v in values) for r in df.collect()}


def test_iso_and_calendar_weeks(inc):
    iso = keyed(pn.weekly_panel(inc), "total", "violent", "arrest_rate")
    assert iso == {
        ("u", 2018, 1): (1, 1, 0.0),
        ("u", 2019, 1): (2, 1, 0.5),
        ("u", 2019, 5): (1, 1, 0.0),
        ("v", 2004, 53): (1, 0, 0.0),
    }
    calendar = keyed(pn.weekly_panel(inc, week_mode="calendar"), "total", "violent")
    assert calendar == {
        ("u", 2018, 1): (2, 2),
        ("u", 2019, 1): (1, 0),
        ("u", 2019, 5): (1, 1),
        ("v", 2005, 53): (1, 0),
    }


def test_district_in_the_key(inc):
    p = pn.weekly_panel(inc, ("unit", "district"))
    assert p.filter("unit = 'u'").count() == 3
    assert pn.features_base(p).count() == 1


def series_of(spark, values, unit="u"):
    rows = [(unit, 2020, w, t, v) for w, t, v in values]
    return spark.createDataFrame(rows, "unit string, year int, week int, total bigint, violent bigint")


def test_lags_means_label(spark):
    totals = [4, 0, 2, 6, 1]
    p = series_of(spark, [(w + 1, t, t * 10) for w, t in enumerate(totals)])
    p = pn.add_lags(p, "total", [1, 2, 3])
    p = pn.add_rolling(pn.add_rolling(p, "total", 3), "violent", 4)
    p = pn.add_trend(pn.add_label(pn.add_time_index(p)))
    rows = p.orderBy("week").collect()
    for k in (1, 2, 3):
        assert [r[f"total_lag_{k}"] for r in rows] == [0] * k + totals[:-k]
    assert [r.total_mean_3 for r in rows] == [0, 4, 2, 2, pytest.approx(8 / 3)]
    assert [r.violent_mean_4 for r in rows] == [0, 40, 20, 20, 30]
    assert [r.label for r in rows] == [0, 20, 60, 10, None]
    assert [r.time_index for r in rows] == [0, 1, 2, 3, 4]
    assert [r.trend for r in rows] == [0, -1, 0, 2, pytest.approx(-5 / 6)]


def test_shares_and_seasons(spark):
    p = series_of(spark, [(2, 4, 1), (9, 4, 0), (10, 0, 0), (22, 1, 1), (35, 2, 1), (47, 1, 1), (48, 1, 1)])
    rows = pn.add_season_flags(pn.add_share(p)).orderBy("week").collect()
    assert [r.violent_share for r in rows] == [0.25, 0, 0, 1, 0.5, 1, 1]
    assert [r.total_per_violent for r in rows] == [4, 0, 0, 1, 2, 1, 1]
    assert [(r.is_summer, r.is_winter, r.is_holiday_season) for r in rows] == [
        (0, 1, 1), (0, 1, 0), (0, 0, 0), (1, 0, 0), (1, 0, 0), (0, 0, 1), (0, 1, 1),
    ]


def test_densify_fills_gaps_across_years(spark):
    rows = [("u", 2004, 52, 3, 1), ("u", 2005, 2, 5, 2), ("v", 2004, 53, 1, 1)]
    p = spark.createDataFrame(rows, "unit string, year int, week int, total bigint, violent bigint")
    assert keyed(pn.densify(p), "total", "violent") == {
        ("u", 2004, 52): (3, 1),
        ("u", 2004, 53): (0, 0),
        ("u", 2005, 1): (0, 0),
        ("u", 2005, 2): (5, 2),
        ("v", 2004, 53): (1, 1),
    }


def many_series(spark):
    rows = [
        (f"u{u}", 2015 + w // 50, w % 50 + 1, (w * 7 + u) % 11, (w * 3 + u) % 5, 0.0, 0.0)
        for u in range(4)
        for w in range(10 + 40 * u)
    ]
    return spark.createDataFrame(
        rows,
        "unit string, year int, week int, total bigint, violent bigint, "
        "arrest_rate double, domestic_rate double",
    )


def test_features_in_one_step_equal_steps(spark):
    p = many_series(spark)
    whole = pn.features_full(p)
    steps = pn.add_lags(pn.add_lags(p, "total", [1, 2, 3]), "violent", [1, 2])
    for col, size in (("total", 3), ("violent", 3), ("total", 4)):
        steps = pn.add_rolling(steps, col, size)
    steps = pn.add_label(steps).filter(F.col("label").isNotNull())
    steps = pn.add_time_index(steps)
    steps = pn.add_trend(pn.add_season_flags(pn.add_share(steps))).select(*whole.columns)
    assert whole.count() == steps.count() == p.count() - 4
    assert whole.exceptAll(steps).isEmpty()


@pytest.mark.parametrize("split", [pn.split_by_index, pn.split_by_date])
def test_splits_cover_the_panel(spark, split):
    features = pn.features_full(many_series(spark))
    marked = split(features).cache()
    train, test = pn.train_part(marked), pn.test_part(marked)
    assert train.count() + test.count() == features.count()
    assert train.count() and test.count()
    if split is pn.split_by_index:
        largest = max(r.time_index for r in features.collect())
        assert train.agg(F.max("time_index")).first()[0] == int(largest * 0.8)
        assert {r.unit for r in test.select("unit").collect()} == {"u3"}
    else:
        key = F.max(F.struct("year", "week"))
        assert train.agg(key).first()[0] < test.agg(F.min(F.struct("year", "week"))).first()[0]


def test_calendar_at_year_ends(spark, inc):
    """Week 53 of 2005 holds its first two days and comes last; week 1 of 2018 holds its last day, too."""
    rows = {(r.year, r.week): r for r in pn.week_calendar(inc, "calendar").collect()}
    assert rows[2005, 53].monday == dt.date(2004, 12, 27)
    assert rows[2005, 53].position == rows[2005, 52].position + 1
    assert rows[2006, 1].position == rows[2005, 53].position + 1
    assert rows[2006, 52].monday == dt.date(2005, 12, 26)
    assert rows[2018, 1].monday == dt.date(2018, 1, 1)
    assert sorted(r.position for r in rows.values()) == list(range(len(rows)))
    iso = pn.week_calendar(inc).orderBy("position").collect()
    assert all((b.monday - a.monday).days == 7 for a, b in zip(iso, iso[1:]))
    assert pn.week_calendar(inc.limit(0)).count() == 0


def test_dense_calendar_weeks(spark, inc):
    rows = [
        (1, dt.datetime(2018, 12, 20), "u", 1, 1, 1, 0),
        (2, dt.datetime(2018, 12, 31), "u", 1, 1, 1, 0),
        (3, dt.datetime(2019, 1, 8), "u", 1, 0, 0, 0),
        (4, dt.datetime(2019, 1, 1), "v", 1, 0, 0, 0),
    ]
    few = spark.createDataFrame(rows, SCHEMA)
    calendar = pn.week_calendar(few, "calendar")
    p = pn.weekly_panel(few, week_mode="calendar")
    dense = pn.densify_by_calendar(p, calendar)
    assert keyed(dense, "total", "violent") == {
        ("u", 2018, 1): (1, 1),
        ("u", 2018, 51): (1, 1),
        ("u", 2018, 52): (0, 0),
        ("u", 2019, 1): (0, 0),
        ("u", 2019, 2): (1, 0),
        ("v", 2019, 1): (1, 0),
    }
    assert dense.columns[-2:] == ["position", "monday"]


def test_dense_iso_weeks_agree_with_the_calendar(spark, inc):
    p = pn.weekly_panel(inc)
    plain = pn.densify(p)
    dense = pn.densify_by_calendar(p, pn.week_calendar(inc)).select(*plain.columns)
    assert plain.exceptAll(dense).count() == dense.exceptAll(plain).count() == 0


def test_split_by_the_carried_monday(spark):
    rows = [("u", 2018, w, dt.date(2018, 1, 1) + dt.timedelta(days=7 * (10 - w))) for w in range(1, 11)]
    df = spark.createDataFrame(rows, "unit string, year int, week int, monday date")
    split = {r.week: r.split for r in pn.split_by_date(df, 0.5).collect()}
    assert split == {w: "test" if w < 6 else "train" for w in range(1, 11)}
