"""Fingerprints and the edited-text comparison against a plain loop."""

import hashlib

import pytest

from lumenreg.llm import fingerprints as FP
from lumenreg.llm.queries import op3_fingerprints
from tests.conftest import SF_SMALL
from tests.llm.cases import odd_documents, odd_rows, prose


def plain_counts(raw):
    counts = [0] * FP.BUCKETS
    for i in range(len(raw) - 4):
        for kind, places in enumerate(FP.TRIPLETS):
            h = 0
            for k, p in enumerate(places):
                h ^= int(FP.TABLES[kind, k][raw[i + p]])
            counts[h] += 1
    return counts


def expected(ordered):
    out = {}
    for (doc_id, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        t, n = text or "", after or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + n[:half]
        marks = [FP.digest(x.encode()) for x in (t, edited, n)]
        out.setdefault(doc_id, []).append(
            (len(t), hashlib.sha256(edited.encode()).hexdigest(), marks[0].hex(), marks[1].hex(),
             FP.likeness(marks[0], marks[1]), FP.likeness(marks[0], marks[2])))
    return {k: sorted(v) for k, v in out.items()}


def got(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    return {k: sorted(v) for k, v in out.items()}


def test_codes_are_quartiles():
    raw = prose(3, 300).encode()
    counts = plain_counts(raw)
    ordered = sorted(counts)
    cuts = [ordered[63], ordered[127], ordered[191]]
    assert FP._codes(FP.digest(raw)).tolist() == [sum(c > q for q in cuts) for c in counts]


def test_chunks_change_nothing(monkeypatch):
    raw = prose(9, 500).encode()
    whole = FP.digest(raw)
    monkeypatch.setattr(FP, "CHUNK", 100)
    assert FP.digest(raw) == whole


def test_likeness_bounds():
    a, b = (FP.digest(x.encode()) for x in (prose(1, 400), "0123456789" * 500))
    assert FP.likeness(a, a) == 1.0 and 0.0 <= FP.likeness(a, b) < 0.9
    assert FP.likeness(a, FP.digest((prose(1, 400) + " end").encode())) > 0.9
    assert FP.digest(b"") != FP.digest(b"abc") and FP.likeness(b"\0" * 66, b"\xff" * 66) >= 0.0


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_odd_rows_follow_by_id_then_text(spark, parts):
    rows = sorted([(r[0], r[1]) for r in odd_rows()],
                  key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    assert got(FP.edited_likeness(odd_documents(spark), parts=parts)) == expected(rows)


def test_single_row_follows_itself(spark):
    out = FP.edited_likeness(odd_documents(spark).where("doc_id = 1")).collect()
    assert len(out) == 1 and out[0]["near_next"] == 1.0


def test_query(spark):
    rows = sorted(((r["doc_id"], r["text"]) for r in
                   spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()), reverse=True)
    found = got(op3_fingerprints(spark, SF_SMALL))
    assert found == expected(rows)
    assert sum(v[0][4] > v[0][5] for v in found.values()) > 0.95 * len(found)
