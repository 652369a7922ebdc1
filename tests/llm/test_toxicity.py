"""Toxicity: the ordinal model's gradient, features, and held-out documents."""

import numpy as np

from lumenreg.llm import toxicity as T
from lumenreg.llm.quality_model import held_out, sample
from lumenreg.llm.queries import op4_toxicity
from tests.conftest import SF_MID
from tests.llm.cases import prose


def features(words):
    owner, feature = zip(*T.word_features(words))
    return np.concatenate(owner), np.concatenate(feature)


def test_word_score_is_the_sum_of_its_features():
    words = [b"scum", b"a", "été".encode()]
    owner, feature = features(words)
    alone = [features([w])[1] for w in words]
    for i in range(len(words)):
        assert sorted(feature[owner == i]) == sorted(alone[i])
    model = T.Ordinal(np.arange(1 << T.BITS, dtype=float), np.array([0.0, 1.0, 2.0]))
    assert np.allclose(model.word_scores(words), [x.sum() for x in alone])


def test_long_words_have_all_their_features(monkeypatch):
    words = [b"banana" * 40, b"ab", b"scumbag" * 30, b"a"]
    model = T.Ordinal(np.random.default_rng(3).normal(size=1 << T.BITS), np.zeros(3))
    whole, found = model.word_scores(words), sorted(zip(*(x.tolist() for x in features(words))))
    assert len(found) == sum(max(0, len(w) + 2 - n + 1) for w in words for n in T.SIZES) + 4
    for run in (1, 5, 64):
        monkeypatch.setattr(T, "RUN", run)
        assert np.allclose(model.word_scores(words), whole)
        assert sorted(zip(*(x.tolist() for x in features(words)))) == found


def likelihood(s, cuts, grades, balance):
    """The weighted negative log-likelihood, grade by grade."""
    edges = np.concatenate([[-np.inf], cuts, [np.inf]])
    passed = 1 / (1 + np.exp(edges[None, :] - s[:, None]))
    n = np.arange(len(s))
    return -(balance * np.log(passed[n, grades] - passed[n, grades + 1])).sum()


def test_gradient_is_the_numeric_one():
    rng = np.random.default_rng(0)
    s, cuts, grades = rng.normal(size=40), np.array([-0.4, 0.3, 1.1]), np.arange(40) % T.GRADES
    balance = rng.uniform(0.5, 2.0, 40)
    by_score, by_cut = T.gradient(s, cuts, grades, balance)
    step = 1e-6
    for got, at in ((by_score, s), (by_cut, cuts)):
        for i in range(len(at)):
            at[i] += step
            up = likelihood(s, cuts, grades, balance)
            at[i] -= 2 * step
            down = likelihood(s, cuts, grades, balance)
            at[i] += step
            assert abs((up - down) / (2 * step) - got[i]) < 1e-6


def test_fit_comes_near_the_best_likelihood():
    """One word for each grade: the fit reaches what plain descent on four scores reaches."""
    grades = np.repeat(np.arange(T.GRADES), 60)
    words = [[b"wordzero", b"both"], [b"kindone", b"both"], [b"sorttwo"], [b"typethree"]]
    sample = T.Sample.of([words[g] for g in grades])
    model = T.fit_ordinal(sample, grades)
    mine = np.array([sum(model.word_scores(words[g])) for g in range(T.GRADES)])[grades]
    high = grades > 0
    balance = np.where(high, 0.5 / high.mean(), 0.5 / (~high).mean()) / len(grades)
    scores, cuts = np.zeros(T.GRADES), np.array([-1.0, 0.0, 1.0])
    for _ in range(3000):
        by_score, by_cut = T.gradient(scores[grades], cuts, grades, balance)
        scores = np.clip(scores - np.bincount(grades, by_score), -6, 6)
        cuts = np.maximum.accumulate(cuts - by_cut)
    assert (np.diff([mine[grades == g][0] for g in range(T.GRADES)]) > 0).all()
    assert likelihood(mine, model.cuts, grades, balance) < likelihood(
        scores[grades], cuts, grades, balance) + 0.05


def test_sample_draws_each_label(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "cast(id AS string) AS text")
    labels = spark.range(3000).selectExpr("id AS doc_id", "int(id % 20 = 0) AS toxic")
    learn = labels.where(~held_out("doc_id"))
    rare = learn.where("toxic = 1").count()

    def drawn(rows):
        got = sample(docs, labels, "toxic", [], lambda: lambda t: [], rows, most_of={True: rows // 2})
        return sorted(int(r["good"]) for r in got.collect())

    assert drawn(60) == [0] * 30 + [1] * 30
    assert drawn(1000) == [0] * (1000 - rare) + [1] * rare
    assert drawn(5000) == sorted(r["toxic"] for r in learn.collect())


def test_words_are_distinct_and_bare():
    assert T.words_of(b"Scum, scum! (SCUM) ok ok") == [b"ok", b"scum"]
    assert T.words_of(None) == T.words_of(b" !! ") == []


def test_thresholds_are_ordered_and_severity_rises(spark):
    rows, labels = [], []
    for i in range(1200):
        insults = i % 10 if i % 10 < 4 else 0
        words = prose(i, 40).split() + [f"grub{'abcdefghijkl'[k]}" for k in range(insults)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(insults > 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = T.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert (np.diff(model.cuts) >= 0).all()
    out = {r["doc_id"]: r for r in T.predict(docs, model).collect()}
    assert all(out[i]["toxic"] == bool(t) for i, t in labels)
    mean = [np.mean([out[i]["severity"] for i in range(1200)
                     if (i % 10 if i % 10 < 4 else 0) == k]) for k in range(4)]
    assert mean == sorted(mean) and mean[3] > mean[1] + 0.3


def test_query_on_held_out_documents(spark):
    label = {r["doc_id"]: r["toxic"] for r in
             spark.read.parquet(f"{SF_MID}/labels.parquet").collect()}
    out = op4_toxicity(spark, SF_MID).collect()
    clean = [r["toxic"] for r in out if label.get(r["doc_id"]) == 0]
    toxic = [r["toxic"] for r in out if label.get(r["doc_id"]) == 1]
    assert len({r["doc_id"] for r in out}) == len(out)
    # 300 labelled rows teach most insults; see the README for larger samples
    assert sum(clean) <= 0.01 * len(clean) and sum(toxic) >= 0.7 * len(toxic)
