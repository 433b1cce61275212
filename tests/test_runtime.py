"""Scratch paths and their removal."""

from __future__ import annotations

from pathlib import Path

import pytest

from blotter.runtime import materialise, scratch_path, scratch_scope


def local(path):
    return Path(path.removeprefix("file:"))


def test_a_scope_removes_what_was_written_inside(spark):
    outer = materialise(spark.range(5), "outer")
    kept = scratch_path(spark, "kept")
    with scratch_scope(spark):
        inner = materialise(spark.range(7), "inner")
        files = inner.inputFiles()
        with scratch_scope(spark):
            deeper = materialise(inner.filter("id > 3"), "deeper").inputFiles()
        assert not any(local(f.removeprefix("file://")).exists() for f in deeper)
        assert inner.count() == 7
        inner.write.parquet(kept)
    assert files and not any(local(f.removeprefix("file://")).exists() for f in files)
    assert outer.count() == 5
    assert spark.read.parquet(kept).count() == 7


def test_a_scope_keeps_what_is_named_and_cleans_after_errors(spark):
    kept = scratch_path(spark, "named")
    with pytest.raises(RuntimeError), scratch_scope(spark, kept):
        spark.range(3).write.parquet(kept)
        files = materialise(spark.range(2)).inputFiles()
        raise RuntimeError
    assert spark.read.parquet(kept).count() == 3
    assert not any(local(f.removeprefix("file://")).exists() for f in files)
