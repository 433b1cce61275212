"""Shared storage for intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir`` or ``setCheckpointDir``.

    Only a local session may go without that setting; it then gets a new
    temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Paths handed out, oldest first; ``scratch_scope`` removes them again.
_handed_out: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has been written to yet."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession, *keep: str) -> Iterator[None]:
    """On leaving, remove all that was written to scratch paths handed out inside.

    Frames that read such paths are of no use afterwards: write what is wanted
    elsewhere, or to a path named in ``keep``, before the scope ends.
    """
    before = len(_handed_out)
    try:
        yield
    finally:
        mine, _handed_out[before:] = _handed_out[before:], [p for p in _handed_out[before:] if p in keep]
        for path in mine:
            if path not in keep:
                _remove(spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that Spark writes to."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def materialise(df: DataFrame, label: str = "stored") -> DataFrame:
    """Compute ``df`` once, keep it as parquet in the shared folder, read that.

    Cuts the lineage, survives lost executors, and later jobs read only the
    columns they need. Meant for frames that several later jobs read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
