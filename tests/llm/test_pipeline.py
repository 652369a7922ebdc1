"""The pipeline's stages, each against a plain version on its own input."""

import corpus_pipeline as C
from lumenreg.llm import document_stats as D
from lumenreg.llm import language as L
from lumenreg.llm import quality_rules as Q
from lumenreg.llm.queries import pipeline
from tests.conftest import SF_SMALL
from tests.llm.test_packing import check
from tests.llm.test_simhash import plain_components, plain_print


def test_stages_against_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").cache()
    columns, rows = docs.columns, {r["doc_id"]: r for r in docs.collect()}

    def stage(k, df):
        name, run = C.STAGES[k]
        out = run(spark, df, SF_SMALL)
        out.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    named = stage(0, docs)
    accepted = {r["doc_id"] for r in L.predict(docs, L.fit(docs)).where("not rejected").collect()}
    assert {r["doc_id"] for r in named.collect()} == accepted and named.columns == columns

    good = stage(1, named)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    cutoffs = Q.certify(Q.measure(named), labels)
    want = set()
    for i in accepted:
        s = dict(zip(D.NAMES, D.statistics(rows[i]["text"].encode())))
        if not Q.base_failed(s["n_words"], s["n_repeat_words"]) and Q.accepts(
                s, cutoffs.get(rows[i]["lang"], {})):
            want.add(i)
    assert {r["doc_id"] for r in good.collect()} == want and good.columns == columns

    single = stage(2, good)
    prints = [(i, plain_print(rows[i]["text"])) for i in sorted(want)]
    first = set(plain_components(prints))
    found = single.collect()
    assert {r["doc_id"] for r in found} == first and single.columns == columns
    assert all(r == rows[r["doc_id"]] for r in found)

    packed = C.STAGES[3][1](spark, single, SF_SMALL).collect()
    check(packed, {i: rows[i]["text"] for i in first})
    whole = pipeline(spark, SF_SMALL).collect()
    assert {r["doc_id"] for r in whole} == first
    assert sum(r["length"] for r in whole) == sum(r["length"] for r in packed)


def test_stage_list():
    assert [n for n, _ in C.STAGES] == ["language_id", "quality_rules", "near_duplicates", "packing"]
    assert C.ORACLE_SQL is None
