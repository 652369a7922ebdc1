"""Language ID: the Kneser-Ney model against a plain one, accuracy, rejection."""

import math
import tracemalloc
import zlib

import numpy as np
import pytest

from lumenreg.llm import language as L
from lumenreg.llm.batches import Memo
from lumenreg.llm.queries import op10_language
from tests.conftest import SF_MID
from tests.llm.cases import prose


class Plain:
    """The same model by dictionaries, gram by gram."""

    def __init__(self, words, alphabet):
        self.raw = {}
        for w in words:
            for g in L.grams(L.bare(w)):
                self.raw[g] = self.raw.get(g, 0) + 1
        self.counts = {k: {} for k in range(1, L.ORDER + 1)}
        grams = set(self.raw)
        for order in range(L.ORDER, 0, -1):
            for g in {g for g in grams if len(g) == order}:
                self.counts[order][g] = self.raw.get(g, 0) + len(
                    {h for h in grams if len(h) == order + 1 and h[1:] == g})
            grams |= {g[1:] for g in grams if len(g) == order and order > 1}
        self.floor = 1 / (alphabet + 1)

    def p(self, gram):
        order = len(gram)
        if order == 0:
            return self.floor
        counts = self.counts[order]
        ones, twos = (sum(n == k for n in counts.values()) for k in (1, 2))
        d = ones / (ones + 2 * twos) if ones else 0.5
        follow = [n for g, n in counts.items() if g[:-1] == gram[:-1]]
        lower = self.p(gram[1:]) if order > 1 else self.floor
        if not follow:
            return lower
        n = counts.get(gram, 0)
        return max(n - d, 0) / sum(follow) * (n > 0) + d * len(follow) / sum(follow) * lower


WORDS = {"x": [b"anna", b"banana", b"ananas", b"band", b"anna", b"an"],
         "y": [b"otto", b"toto", b"oto", b"to", b"tot", b"banana"]}


def test_scores_equal_plain_model():
    counts = {}
    for lang, words in WORDS.items():
        for w in words:
            for g in L.grams(L.bare(w)):
                counts.setdefault(lang, {})[g] = counts.get(lang, {}).get(g, 0) + 1
    model = L.build(counts)
    alphabet = len({c for x in counts.values() for g in x for c in g})
    tests = [b"anna", b"banana,", b"TOTO!", b"zzz", b"otan", b"123", b"\xc3\xa9t\xc3\xa9"]
    scores = model.word_scores(tests)
    for k, lang in enumerate(model.languages):
        plain = Plain(WORDS[lang], alphabet)
        for i, w in enumerate(tests):
            want = -sum(math.log(plain.p(g)) for g in L.grams(L.bare(w)))
            assert scores[i, k] == pytest.approx(want, abs=1e-9), (lang, w)
    assert scores[:, -1].tolist() == [max(0, len(L.bare(w)) - 1) for w in tests]


def test_memo_limit_changes_nothing():
    counts = {k: {g: 1 for w in v for g in L.grams(L.bare(w))} for k, v in WORDS.items()}
    model = L.build(counts)
    texts = [b"anna to banana", b"toto band an an an", None, b""]
    whole, small = L.Scorer(model), L.Scorer(model, limit=2)
    for _ in range(2):
        for t in texts:
            a, b = whole.entropies([t]), small.entropies([t])
            assert np.allclose(a[0], b[0]) and a[1] == b[1]


def test_long_words_are_scored_in_runs(monkeypatch):
    counts = {k: {g: 1 for w in v for g in L.grams(L.bare(w))} for k, v in WORDS.items()}
    model = L.build(counts)
    words = [b"123", b"banana" * 50, b"anna", b"tot" * 70, b"", b"o"]
    whole = model.word_scores(words)
    for run in (1, 7, 64):
        monkeypatch.setattr(L, "RUN", run)
        assert np.allclose(model.word_scores(words), whole, atol=1e-9)


def test_memory_of_a_word_of_megabytes_is_bounded():
    names = [f"l{i}" for i in range(20)]
    model = L.build({n: {g: i + 1 for w in WORDS["x"] for g in L.grams(L.bare(w))}
                     for i, n in enumerate(names)})
    word = b"banana" * 500_000
    tracemalloc.start()
    scores = model.word_scores([word])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert scores[0, -1] == len(word) + 1
    assert peak < 200e6  # a row of floats for each letter and language would take 480 MB


def test_memo_holds_bounded_bytes():
    memo = Memo(lambda words: [len(w) for w in words], limit_bytes=1000)
    for i in range(50):
        new = {bytes([65 + i]) * 100, b"x"}
        memo.add(new)
        assert all(memo[w] == len(w) for w in new) and sum(map(len, memo)) <= 1000
    memo.add({b"y" * 5000})  # one token beyond the bound is held alone
    assert list(memo) == [b"y" * 5000]


def test_held_out_labels_are_never_learned(spark):
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    learned = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, prose(i, 40), "wrong") for i in held] + [(i, prose(i, 40), "en") for i in learned]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert L.fit(docs).languages == ["en"]


def test_foreign_text_is_rejected(spark):
    other = "zxqj vkwp qqzz jjxk wvvq pzkx"
    rows = [(i, prose(i, 60), "en") for i in range(200)] + [(900, " ".join([other] * 10), None),
                                                          (901, "12 34 !!", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r["doc_id"]: r for r in L.predict(docs, L.fit(docs)).collect()}
    assert [k for k, r in out.items() if r["rejected"]] == [900, 901]
    assert out[901]["lang_pred"] == "und" and out[901]["score"] == 0.0
    kept = L.keep_accepted(docs, L.fit(docs))
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(200))


def test_query_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in
            spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang").collect()}
    out = op10_language(spark, SF_MID).collect()
    held = [r for r in out if r["held_out"]]
    assert len(out) == len(lang) and all(
        r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    assert sum(lang[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.99 * len(held)
    assert sum(r["rejected"] for r in out) <= 0.01 * len(out)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_a_rare_language_is_learned(spark):
    """Its only documents fall to the hold-back; they are learned from all the same."""
    from pyspark.sql import functions as F

    back = F.pmod(F.xxhash64(F.lit("held back"), "id"), F.lit(L.HELD_BACK)) == 0
    ids = [r["id"] for r in spark.range(5000).where(back & ~L.held_out("id")).limit(2).collect()]
    docs = [(10_000 + i, prose(i, 60), "en") for i in range(60)]
    docs += [(i, "это короткий русский текст о погоде и природе " * 4, "ru") for i in ids]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = L.fit(df)
    assert sorted(model.languages) == ["en", "ru"]
    got = {r["doc_id"]: r["lang_pred"] for r in L.predict(df, model).collect()}
    assert {got[i] for i in ids} == {"ru"}
