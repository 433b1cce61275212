"""A corpus pipeline of four operators, each stage written before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm import cotrain, packing, simhash, zstd_langid
from blotter.llm.common import unused
from blotter.runtime import scratch_path, scratch_scope


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps.

    Null texts are judged as empty ones; ids play no part but in the labels. An
    empty table stays empty.
    """
    views = cotrain.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _where(docs, cotrain.judged(docs, views), "keep")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the compressed sizes settle.

    Null texts, and texts without a letter, have no language and go. An empty
    table stays empty.
    """
    return _where(docs, zstd_langid.predicted(docs, zstd_langid.learn(docs)), "accepted")


def _where(docs: DataFrame, verdict: Column, field: str) -> DataFrame:
    """Rows whose verdict has ``field`` set, under the columns they had."""
    name = unused(docs, "verdict")
    return docs.withColumn(name, verdict).where(F.col(name)[field]).drop(name)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of three-word shingles link within two bits.

    Documents without words are one group; a null id counts as the largest. An
    empty table stays empty.
    """
    return simhash.without_near_copies(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all pieces in sequences of 1,024 ids.

    A null or empty text is its end id alone; a null id is kept. An empty table
    has no pieces.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("language ID", language),
    ("SimHash near-dedup", deduplicate),
    ("best-fit packing", pack),
]

#: The trained stages and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again.

    What a stage stores on its way is removed once its result is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
