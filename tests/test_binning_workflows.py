import math
import random

import pytest
from pyspark.sql import functions as F

from lumenreg import config as C
from lumenreg.operators import evaluate as E
from lumenreg.operators import models as M
from lumenreg.operators import binning as B
from lumenreg.operators.binning import quantile_bins
from lumenreg.operators.prepare import prepare_features
from lumenreg.operators.split import hash_split, rename_label
from lumenreg.plans import workflows as W
from lumenreg.sources.fixture import tpch_sales
from tests.conftest import SF_MID, SF_SMALL


def test_exact_binning_is_plain_mllib_at_any_max_bins(spark):
    """No size of data or bins switches to another algorithm."""
    rows = tpch_sales(spark, SF_MID)
    res = W.tree_cv(spark, rows, max_bins=512, max_depth=6, k=2)
    train, test = hash_split(prepare_features(rows, extra=["h"]))
    model = M.pipeline(M.tree(max_bins=512, max_depth=6)).fit(train)
    plain = E.rmse_frame(model.transform(rename_label(test))).first()["rmse"]
    assert res.test_rmse == pytest.approx(plain, rel=1e-9)
    res.release()


def test_quantile_bins_are_equal_frequency_and_monotone(spark):
    f = prepare_features(tpch_sales(spark, SF_SMALL)).cache()
    out = quantile_bins(f, list(C.FEATURE_COLS), 32).transform(f)
    for c in C.FEATURE_COLS:
        n = out.select(F.countDistinct(f"{c}_bin")).first()[0]
        assert 1 < n <= 32
        if f.select(c).distinct().count() > 32 * 4:
            assert out.groupBy(f"{c}_bin").count().agg(F.max("count")).first()[0] < 4 * f.count() / 32
        pairs = out.select(c, f"{c}_bin").distinct().orderBy(c).collect()
        assert all(a[1] <= b[1] for a, b in zip(pairs, pairs[1:]))
    with pytest.raises(ValueError):
        quantile_bins(f, ["Pack"], 1)


@pytest.mark.parametrize("ranges, drawn", [(2, 5), (16, 200), (2048, 50_000)])
def test_rank_values_are_exact(spark, monkeypatch, ranges, drawn):
    """Whatever the ranges and sample (that only steer): spikes, nulls, infinities, one value."""
    monkeypatch.setattr(B, "RANK_RANGES", ranges)
    monkeypatch.setattr(B, "RANK_ROWS", drawn)
    r = random.Random(ranges)
    rows = [(r.gauss(0, 1), r.choice([1.0, 1.0, 1.0, 2.0, -7.5, None]), 3.0, None,
             r.choice([float("inf"), float("-inf"), 0.0, -0.0, 5e-324])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(5)
    shares = [i / 32 for i in range(1, 32)] + [1.0]
    got = B.rank_values(df, list("abcde"), shares, 3000)
    for i, values in enumerate(got):
        have = sorted(row[i] for row in rows if row[i] is not None)
        assert values == [have[math.ceil(s * len(have)) - 1] for s in shares if have]


def test_quantile_cuts_are_exact_beyond_the_accuracy(spark):
    """A sketch of so few entries would be off by hundreds of ranks."""
    df = spark.range(0, 100_000, 1, 4).selectExpr("double((id * 7919) % 100003) AS v")
    values = sorted((i * 7919) % 100003 for i in range(100_000))
    splits = quantile_bins(df, ["v"], 32, accuracy=10).getSplitsArray()[0]
    assert splits[1:-1] == [values[math.ceil(i / 32 * 100_000) - 1] for i in range(1, 32)]


def test_tree_workflow_with_quantile_binning_scores_all_test_rows(spark):
    rows = tpch_sales(spark, SF_SMALL)
    mllib = W.tree_cv(spark, rows, max_bins=16, max_depth=3, k=3, binning="quantile", bins=16)
    assert mllib.model.transform(prepare_features(rows)).count() == mllib.n_train + mllib.n_test
    res = W.tree_cv(spark, rows, max_depth=3, k=3, binning="quantile", bins=16)
    # the same trees: all folds and the refit from one counting pass a level, and three more
    assert res.tuning.extra["passes"] == 3 + 2
    assert res.tuning.metrics == pytest.approx(mllib.tuning.metrics, rel=1e-9)
    assert res.test_rmse == pytest.approx(mllib.test_rmse, rel=1e-9)
    assert res.predictions.count() == res.n_test and math.isfinite(res.test_rmse)
    # the published model scores raw sales rows
    again = res.model.transform(prepare_features(rows)).count()
    assert again == res.n_train + res.n_test
    with pytest.raises(ValueError):
        W.tree_cv(spark, rows, binning="auto")


def test_random_split_mode(spark):
    rows = tpch_sales(spark, SF_SMALL)
    a = W.linear_cv(spark, rows, split="random", seed=3, k=3)
    b = W.linear_cv(spark, rows, split="random", seed=3, k=3)
    assert a.n_train + a.n_test == prepare_features(rows).count()
    assert a.test_rmse == pytest.approx(b.test_rmse, rel=1e-12)
    direct = a.predictions.selectExpr(
        "sqrt(avg(power(trueLabel - prediction, 2))) AS r").first()["r"]
    assert a.test_rmse == pytest.approx(direct, rel=1e-9)
    t = W.tree_cv(spark, rows, split="random", split_seed=3, k=3, max_depth=2, max_bins=64)
    assert t.n_train + t.n_test == a.n_train + a.n_test
    with pytest.raises(ValueError):
        W.linear_cv(spark, rows, split="bogus")


def test_combined_linear_workflows_equal_separate_runs(spark):
    rows = tpch_sales(spark, SF_SMALL)
    cv, tvs = W.linear_cv_tvs(spark, rows)
    cv1, tvs1 = W.linear_cv(spark, rows), W.linear_tvs(spark, rows)
    for a, b in ((cv, cv1), (tvs, tvs1)):
        assert a.tuning.best == b.tuning.best
        assert a.tuning.metrics == pytest.approx(b.tuning.metrics, rel=1e-10)
        assert a.test_rmse == pytest.approx(b.test_rmse, rel=1e-10)
        assert (a.n_train, a.n_test) == (b.n_train, b.n_test)


def test_checkpoint_storage_gives_the_same_tree_results(spark):
    rows = tpch_sales(spark, SF_SMALL)
    a = W.tree_cv(spark, rows, k=3, max_depth=3, max_bins=256)
    b = W.tree_cv(spark, rows, k=3, max_depth=3, max_bins=256, storage="checkpoint")
    assert a.tuning.metrics == b.tuning.metrics
    assert a.test_rmse == b.test_rmse and a.n_train == b.n_train
    with pytest.raises(ValueError):
        W.tree_cv(spark, rows, storage="disk")
