"""Every operator and stage on odd rows and on empty tables."""

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lumenreg.llm import (bpe, fingerprints, html_blocks, language, licenses, packing,
                          quality_model, quality_rules, sharding, simhash, toxicity)
from tests.llm.cases import no_documents, odd_documents, odd_rows, some_labels

OPERATORS = {
    "bpe": lambda d, la: bpe.round_trip(d, P.path("byte_bpe_50k.tiktoken"), P.PATTERN),
    "licenses": lambda d, la: licenses.scan(d.withColumn("path", F.concat("source", F.lit("/x")))),
    "fingerprint": lambda d, la: fingerprints.fingerprint(d),
    "edited": lambda d, la: fingerprints.edited_likeness(d, parts=4),
    "toxicity": lambda d, la: toxicity.predict(d, toxicity.fit(d, la)),
    "rules": lambda d, la: quality_rules.judge(d, la),
    "simhash": lambda d, la: simhash.near_duplicates(d),
    "model": lambda d, la: quality_model.predict(d, quality_model.fit(d, la)),
    "html": lambda d, la: html_blocks.extract(d, "doc_id", "source", "text"),
    "sharding": lambda d, la: sharding.shuffle(d, 5),
    "language": lambda d, la: language.predict(d, language.fit(d)),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_for_each_odd_row(spark, name):
    out = OPERATORS[name](odd_documents(spark), some_labels(spark)).collect()
    key = lambda v: (v is None, v or 0)
    assert sorted((r["doc_id"] for r in out), key=key) == sorted(
        (r[0] for r in odd_rows()), key=key)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_tables(spark, name):
    assert OPERATORS[name](no_documents(spark), some_labels(spark, [])).collect() == []


@pytest.mark.parametrize("name", ["toxicity", "rules", "model"])
def test_no_labels(spark, name):
    out = OPERATORS[name](odd_documents(spark), some_labels(spark, [])).count()
    assert out == len(odd_rows())


def test_packing_of_odd_rows(spark):
    path = P.path("word_bpe_49k.json")
    out = packing.pack(odd_documents(spark), path, context=64, least=4).collect()
    assert len({(r["doc_id"], r["start"], r["length"]) for r in out}) > len(odd_rows()) / 2
    assert sum(r["length"] for r in out) == sum(
        r["doc_tokens"] for r in out if r["start"] == 0)
    assert packing.pack(no_documents(spark), path).collect() == []


@pytest.mark.parametrize("empty", [False, True])
def test_stages_keep_columns(spark, tmp_path, empty):
    docs = no_documents(spark) if empty else odd_documents(spark)
    some_labels(spark, [] if empty else None).write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name == "packing":
            assert (out.count() > 0) is not empty
            break
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        assert (docs.count() > 0) is not empty
