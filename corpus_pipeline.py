"""Corpus pipeline: language ID, quality rules, near-duplicates, packing.

Each stage takes the rows that the one before kept, written as Parquet to the
shared scratch folder and read again; the last packs what is left.
"""

from __future__ import annotations

import public_tokenizers

from lumenreg.llm import language, packing, quality_rules, simhash
from lumenreg.session import remove_scratch, scratch_dir


def identify_language(spark, docs, sf_dir):
    """Rows whose language a model of the stage's own documents accepts."""
    return language.keep_accepted(docs, language.fit(docs))


def apply_quality_rules(spark, docs, sf_dir):
    """Rows that pass the base rules and the cutoffs certified on the labels."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark, docs, sf_dir):
    """One row of each group of fingerprints (3-word shingles, 2 bits)."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def pack_sequences(spark, docs, sf_dir):
    """The pieces of the packed sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", identify_language), ("quality_rules", apply_quality_rules),
          ("near_duplicates", drop_near_duplicates), ("packing", pack_sequences)]

#: The character models and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages in order over ``documents``."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:  # read for the last time
            remove_scratch(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
