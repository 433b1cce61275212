"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from blotter.llm import attention_lm, cotrain, merkle, multi_index, packing, piece_codec, rule_cascade, simhash, token_alignment, tool_calls, url_filter, winnowing, zstd_langid
from blotter.llm.common import id_hash


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_winnowing_fingerprints(spark, sf):
    return winnowing.compared(table(spark, sf, "documents"))


def op2_best_fit_packing(spark, sf):
    return packing.pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_quality_cotraining(spark, sf):
    docs = table(spark, sf, "documents")
    views = cotrain.train(docs, table(spark, sf, "labels"))
    return docs.select("doc_id", cotrain.judged(docs, views).alias("v")).select("doc_id", "v.*")


def op4_bloom_url_filter(spark, sf):
    pages = table(spark, sf, "pages")
    return url_filter.judge(pages, url_filter.listed_urls(pages))


def op5_sentencepiece_codec(spark, sf):
    return piece_codec.round_trip(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_attention_lm_scores(spark, sf):
    return attention_lm.scores(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_simhash_components(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op8_inverted_multi_index(spark, sf):
    return multi_index.search(table(spark, sf, "embeddings"))


def op9_compression_language(spark, sf):
    docs = table(spark, sf, "documents")
    held_out = F.coalesce(id_hash() % 5 == 0, F.lit(False))
    learned = zstd_langid.learn(docs.where(~held_out))
    return docs.select("doc_id", held_out.alias("held_out"), zstd_langid.predicted(docs, learned).alias("p")).select(
        "doc_id", "held_out", "p.*"
    )


def op10_tool_call_linking(spark, sf):
    calls, results = tool_calls.chats_as_calls(table(spark, sf, "conversations"))
    return tool_calls.link(calls, results).withColumn("errors", F.array_join("errors", "; "))


def op11_rule_cascade(spark, sf):
    return rule_cascade.judge(table(spark, sf, "documents"))


def op12_merkle_manifest(spark, sf):
    found_later = F.when(id_hash() % 7 == 0, F.try_add(F.col("n_chars"), F.lit(1))).otherwise(F.col("n_chars"))
    return merkle.manifest(table(spark, sf, "documents"), {"n_chars": found_later})


def op13_token_alignment(spark, sf):
    return token_alignment.align(
        table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )


QUERIES = {
    "op1_winnowing_fingerprints": op1_winnowing_fingerprints,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_quality_cotraining": op3_quality_cotraining,
    "op4_bloom_url_filter": op4_bloom_url_filter,
    "op5_sentencepiece_codec": op5_sentencepiece_codec,
    "op6_attention_lm_scores": op6_attention_lm_scores,
    "op7_simhash_components": op7_simhash_components,
    "op8_inverted_multi_index": op8_inverted_multi_index,
    "op9_compression_language": op9_compression_language,
    "op10_tool_call_linking": op10_tool_call_linking,
    "op11_rule_cascade": op11_rule_cascade,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_token_alignment": op13_token_alignment,
}
