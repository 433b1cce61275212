"""Raw CSV in, typed table and rejected rows out."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Observation, SparkSession

from blotter.roles import VIOLENT_14
from blotter.sources.incidents import normalise, read_with_rejects
from blotter.sources.sinks import write_parquet


def prepare(
    spark: SparkSession,
    raw: str | list[str],
    out: str,
    rejected: str,
    violent: Iterable[str] = VIOLENT_14,
    mixed: bool = False,
) -> dict[str, int]:
    """Write the typed table by year to ``out`` and malformed rows to ``rejected``.

    Returns the counts ``rows`` and ``malformed``. They come with the pass that
    writes the good rows; the files are read again for the rejects only if
    there are any. With ``mixed``, files may have differing headers, the
    rejects are always looked for, and only ``malformed`` is counted.
    """
    counted = None if mixed else Observation("rows")
    good, rejects = read_with_rejects(spark, raw, mixed=mixed, observation=counted)
    write_parquet(normalise(good, violent), out)
    counts = {} if counted is None else dict(counted.get)
    if counts.get("malformed", 1):
        rejects.write.parquet(rejected)
        counts["malformed"] = spark.read.parquet(rejected).count()
    return counts
