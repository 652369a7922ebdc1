"""Registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import importlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenreg.llm import (bpe, fingerprints, html_blocks, language, licenses, packing, quality_model,
                          quality_rules, sharding, simhash, toxicity, variants, whitening)
from lumenreg.llm.oracles import ORACLES  # noqa: F401

BYTE_RANKS = "byte_bpe_50k.tiktoken"
WORD_TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark, sf_dir):
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_RANKS),
                          public_tokenizers.PATTERN)


def document_files(spark, sf_dir):
    """Documents as files: the source is the top directory, then one for each thousand ids."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.concat_ws("/", "source", F.floor(F.col("doc_id") / 1000).cast("string"),
                              F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"),
        "text")


def op2_licenses(spark, sf_dir):
    return licenses.scan(document_files(spark, sf_dir))


def op3_fingerprints(spark, sf_dir):
    return fingerprints.edited_likeness(table(spark, sf_dir, "documents"))


def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.predict(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op5_quality_rules(spark, sf_dir):
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept", "stratum")


def op6_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_quality_model(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    forest = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    return quality_model.predict(docs, forest).select(
        "doc_id", quality_model.held_out("doc_id").alias("held_out"), "score", "predicted")


def op8_html(spark, sf_dir):
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def op9_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op10_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs)).select(
        "doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score", "rejected")


def op11_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_variants(spark, sf_dir):
    return variants.spelling_variants(table(spark, sf_dir, "documents"), damage=variants.DAMAGE)


def op13_sharding(spark, sf_dir):
    dealt = sharding.shuffle(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return dealt.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
                        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def pipeline(spark, sf_dir):
    return importlib.import_module("corpus_pipeline").run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_bpe, op2_licenses, op3_fingerprints, op4_toxicity,
                                   op5_quality_rules, op6_simhash, op7_quality_model, op8_html,
                                   op9_packing, op10_language, op11_whitening, op12_variants,
                                   op13_sharding, pipeline)}
