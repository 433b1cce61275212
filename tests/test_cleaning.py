from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from blotter.functions import calendar as cal
from blotter.functions import cleaning as cl
from blotter.roles import VIOLENT_10, VIOLENT_14, Era, text_schema
from blotter.sources.sinks import tsv_lines
from blotter.sources.incidents import normalise, read_incidents_csv, well_formed


def values(spark, rows, expression, schema="x string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [row[0] for row in df.select(expression.alias("v")).collect()]


def test_parse_ts(spark):
    texts = [
        "09/05/2015 01:30:00 PM",
        "9/5/2015 1:30:00 PM",
        "01/01/2001 12:00:00 AM",
        "01/01/2001 12:00:00 PM",
        "31/31/2015 01:30:00 PM",
        "nonsense",
        "",
        None,
    ]
    got = values(spark, texts, cl.parse_ts("x"))
    assert got == [
        dt.datetime(2015, 9, 5, 13, 30),
        dt.datetime(2015, 9, 5, 13, 30),
        dt.datetime(2001, 1, 1, 0, 0),
        dt.datetime(2001, 1, 1, 12, 0),
        None,
        None,
        None,
        None,
    ]


def test_violent_flag(spark):
    rows = ["BATTERY", "THEFT", "NARCOTICS", None]
    assert values(spark, rows, cl.violent_flag("x", VIOLENT_10)) == [1, 0, 0, None]
    assert values(spark, rows, cl.violent_flag("x", VIOLENT_14)) == [1, 0, 1, None]
    assert values(spark, rows, cl.violent_flag("x", VIOLENT_10, null_as=0)) == [1, 0, 0, 0]


def test_bool_flag(spark):
    assert values(spark, ["true", "FALSE", "maybe", "", None], cl.bool_flag("x")) == [
        1, 0, None, None, None,
    ]


def test_clean_district(spark):
    texts = ["6", "06", " 6.0 ", "6.9", "26", "0.5", "-3", "x", "", "NaN", "6d", "1e1", None]
    assert values(spark, texts, cl.clean_district("x")) == [
        6, 6, 6, 6, None, None, None, None, None, None, None, 10, None,
    ]


def test_district_prefix(spark):
    assert values(spark, ["0523", "12", "1", ""], cl.district_prefix("x")) == ["05", "", "", ""]


def test_band(spark):
    cuts = ((8, "North"), (16, "Central"))
    rows = [1, 8, 9, 16, 17, None]
    named = cl.band("x", cuts, "South")
    assert values(spark, rows, named, "x int") == [
        "North", "North", "Central", "Central", "South", "Unknown",
    ]
    assert values(spark, rows, cl.band("x", cuts, "South", None), "x int")[-1] == "South"


def test_era_label(spark):
    eras = (Era("a", 2001, 2011), Era("b", 2012, 2018))
    got = values(spark, [2000, 2001, 2011, 2012, 2018, 2019], cl.era_label("x", eras), "x int")
    assert got == [None, "a", "a", "b", "b", None]
    assert (eras[0].years, eras[1].years, Era("b", 2012, 2018, 8).years) == (11, 7, 8)


def test_pct_and_known(spark):
    assert values(spark, [(1, 4), (1, 0)], cl.pct("a", "b"), "a int, b int") == [25.0, None]
    assert values(spark, ["a", "", None], cl.known("x")) == [True, False, False]


def test_week_keys(spark):
    dates = [dt.datetime(2018, 12, 31), dt.datetime(2005, 1, 1), dt.datetime(2020, 6, 3)]
    for mode, expected in (
        ("iso", [(2019, 1), (2004, 53), (2020, 23)]),
        ("calendar", [(2018, 1), (2005, 53), (2020, 23)]),
    ):
        year, week = cal.week_keys("x", mode)
        got = values(spark, dates, F.struct(year, week), "x timestamp_ntz")
        assert [tuple(g) for g in got] == expected
    with pytest.raises(ValueError):
        cal.week_keys("x", "other")


def test_week_monday(spark):
    got = values(spark, [(2019, 1), (2004, 53)], cal.week_monday("y", "w"), "y int, w int")
    assert got == [dt.date(2018, 12, 31), dt.date(2004, 12, 27)]


def test_names(spark):
    assert values(spark, [1, 12, None], cal.bucket_name("month", "x"), "x int") == [
        "Jan", "Dec", None,
    ]
    assert values(spark, [1, 7], cal.bucket_name("dow", "x"), "x int") == ["Sun", "Sat"]
    sunday = cal.bucket("dow", "x")
    assert values(spark, [dt.datetime(2024, 1, 7)], sunday, "x timestamp_ntz") == [1]
    with pytest.raises(ValueError):
        cal.bucket("fortnight", "x")


HEADER = [
    "ID", "Case Number", "Date", "Block", "IUCR", "Primary Type", "Description",
    "Location Description", "Arrest", "Domestic", "Beat", "District",
]


def csv_file(tmp_path, *lines):
    path = tmp_path / "incidents.csv"
    path.write_text("\n".join([",".join(HEADER), *lines]) + "\n")
    return str(path)


def test_csv_to_typed_table(spark, tmp_path):
    one = "1,H1,09/05/2015 01:30:00 PM,001XX N STATE ST,x,BATTERY,d,l,true,false,0523,006"
    path = csv_file(
        tmp_path,
        one,
        one,
        "2,H2,bad,,x,,d,l,false,true,0111,26",
        '3,H3,1/2/2019 12:05:00 AM,"A, B",x,THEFT,d,l,,x,,6.0',
    )
    raw = read_incidents_csv(spark, path)
    assert raw.columns == HEADER
    assert {t for _, t in raw.dtypes} == {"string"}
    rows = [tuple(r) for r in normalise(raw).orderBy("id").collect()]
    first = (
        1, dt.datetime(2015, 9, 5, 13, 30), "001XX N STATE ST", "0523", 6, "BATTERY", 1, 1, 0,
    )
    assert rows == [
        first,
        first,
        (2, None, None, "0111", None, None, None, 0, 1),
        (3, dt.datetime(2019, 1, 2, 0, 5), "A, B", None, 6, "THEFT", 0, None, None),
    ]


def test_malformed_rows(spark, tmp_path):
    good = "1,H1,09/05/2015 01:30:00 PM,B,x,BATTERY,d,l,true,false,0523,006"
    path = csv_file(tmp_path, good, "2,H2,09/05/2015 01:30:00 PM,B", good + ",too,many")
    raw = read_incidents_csv(spark, path, text_schema(*HEADER, corrupt="_bad"), "_bad")
    kept = well_formed(raw, "_bad")
    assert kept.columns == HEADER
    assert [r["ID"] for r in kept.collect()] == ["1"]
    assert kept.select("Beat").count() == 1
    assert normalise(kept).count() == 1
    with pytest.raises(ValueError):
        read_incidents_csv(spark, path, None, "_bad")


def test_schema_must_fit_the_header(spark, tmp_path):
    path = csv_file(tmp_path, "1,H1,09/05/2015 01:30:00 PM,B,x,BATTERY,d,l,true,false,0523,006")
    swapped = text_schema("Case Number", "ID", *HEADER[2:])
    with pytest.raises(Exception, match="header|Header"):
        read_incidents_csv(spark, path, swapped).collect()


def test_headers_in_another_order_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ID,Beat,District\n1,0112,1\n")
    (tmp_path / "b.csv").write_text("ID,District,Beat\n2,1,0112\n")
    with pytest.raises(Exception, match="header"):
        read_incidents_csv(spark, str(tmp_path)).collect()


def test_small_numbers_are_written_out(spark):
    df = spark.createDataFrame([(0.0005,), (-0.0001,), (0.9999,), (1.0,), (None,)], "r double")
    assert [x.value for x in tsv_lines(df).collect()] == ["0.0005", "-0.0001", "0.9999", "1.0", "None"]
