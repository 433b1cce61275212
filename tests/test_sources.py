"""Rejected rows and files whose headers differ."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from blotter.plans.prepare import prepare
from blotter.sources.incidents import field_count, read_mixed_csv, read_with_rejects, reject_reason

HEADER = "ID,Date,Block,Primary Type,Arrest,Domestic,Beat,District"
GOOD = '{k},09/05/2015 01:30:00 PM,"A, B",BATTERY,true,false,0112,1.0'


def write(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_reasons(spark):
    rows = [('1,"a,b",c',), ("1,2",), ("1,2,3,4",), ('1,"a""b,c",d,e',), ('1,"open,2',), ("",)]
    found = spark.createDataFrame(rows, "r string").select(field_count("r"), reject_reason("r", F.lit(3))).collect()
    assert [tuple(x) for x in found] == [
        (3, "unreadable"),
        (2, "too few fields"),
        (4, "too many fields"),
        (4, "too many fields"),
        (3, "unclosed quote"),
        (1, "too few fields"),
    ]


def test_rejects_are_kept_with_file_and_reason(spark, tmp_path):
    write(tmp_path / "in", "a.csv", HEADER, GOOD.format(k=1), "2,cut")
    write(tmp_path / "in", "b.csv", HEADER, GOOD.format(k=3) + ",more", GOOD.format(k=4))
    good, rejects = read_with_rejects(spark, str(tmp_path / "in"))
    assert sorted(r["ID"] for r in good.collect()) == ["1", "4"]
    assert {r["Block"] for r in good.collect()} == {"A, B"}
    found = {(r.file.rsplit("/", 1)[1], r.reason, r.fields, r.record) for r in rejects.collect()}
    assert found == {
        ("a.csv", "too few fields", 2, "2,cut"),
        ("b.csv", "too many fields", 9, GOOD.format(k=3) + ",more"),
    }
    assert rejects.count() == 2


def test_prepare_writes_good_rows_and_rejects(spark, tmp_path):
    write(tmp_path / "in", "a.csv", HEADER, GOOD.format(k=1), "2,cut", GOOD.format(k=3))
    out, rejected = str(tmp_path / "out"), str(tmp_path / "rejected")
    assert prepare(spark, str(tmp_path / "in"), out, rejected) == {"rows": 3, "malformed": 1}
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [1, 3]
    assert [r.record for r in spark.read.parquet(rejected).collect()] == ["2,cut"]


def test_prepare_without_rejects_writes_none(spark, tmp_path):
    write(tmp_path / "in", "a.csv", HEADER, GOOD.format(k=1))
    counts = prepare(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "rejected"))
    assert counts == {"rows": 1, "malformed": 0}
    assert not (tmp_path / "rejected").exists()


def test_prepare_of_mixed_headers(spark, tmp_path):
    write(tmp_path / "in", "a.csv", HEADER, GOOD.format(k=1), "2,cut")
    write(tmp_path / "in", "b.csv", ",".join(HEADER.split(",")[::-1]), "9.0,0999,false,true,THEFT,B,1/2/2019 1:00:00 AM,5")
    counts = prepare(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "rejected"), mixed=True)
    assert counts == {"malformed": 1}
    got = {(r.id, r.unit, r.district) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(1, "0112", 1), (5, "0999", 9)}


def test_files_of_differing_headers(spark, tmp_path):
    write(tmp_path / "in", "a.csv", "ID,Beat,District", "1,0112,1", "2,0113,1")
    write(tmp_path / "in", "b.csv", '"District",ID,"Beat, old",Beat', "7,3,x,0714")
    write(tmp_path / "in", "c.csv", "ID,Beat,District", "4,0114,1")
    write(tmp_path / "in", "d.csv", "ID")
    (tmp_path / "in" / "empty.csv").write_text("")
    df = read_mixed_csv(spark, str(tmp_path / "in"))
    got = sorted((r["ID"], r["Beat"], r["District"], r["Beat, old"]) for r in df.collect())
    assert got == [("1", "0112", "1", None), ("2", "0113", "1", None), ("3", "0714", "7", "x"), ("4", "0114", "1", None)]
    scans = df._jdf.queryExecution().executedPlan().toString().count("FileScan csv")
    assert scans == 3


def test_headers_that_cannot_be_read(spark, tmp_path):
    write(tmp_path / "in", "a.csv", "ID,ID", "1,2")
    with pytest.raises(ValueError, match="twice"):
        read_mixed_csv(spark, str(tmp_path / "in"))
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        read_mixed_csv(spark, str(tmp_path / "none"))


def test_large_file_has_one_header(spark, tmp_path):
    """A file of several splits: only the first line of the first one counts."""
    spark.range(20_000).select(F.concat(F.col("id"), F.lit(",0112,1")).alias("ID,Beat,District")).coalesce(1).write.option(
        "header", True
    ).option("sep", "\x01").csv(str(tmp_path / "in"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        assert read_mixed_csv(spark, str(tmp_path / "in")).count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
