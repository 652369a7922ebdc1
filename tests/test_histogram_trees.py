"""Trees from histograms next to MLlib and to a plain search."""

import random

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from lumenreg import config as C
from lumenreg.operators import histogram_trees as H
from lumenreg.operators import models as M
from lumenreg.operators import tuning as T
from lumenreg.operators.binning import plain_bins, quantile_bins
from lumenreg.operators.split import with_folds, with_holdout
from lumenreg.operators.trees import Tree, TreeEnsemble, from_mllib, route
from lumenreg.plans import workflows as W
from lumenreg.sources.fixture import tpch_sales
from tests.conftest import SF_SMALL

FEATS = list(C.FEATURE_COLS)
TREE = {"maxDepth": 5, "minInfoGain": 0.0, "maxIter": 1, "stepSize": 1.0}


@pytest.fixture(scope="module")
def feats(spark):
    f = with_folds(W.feature_rows(tpch_sales(spark, SF_SMALL)), 3, fold_col="fold").cache()
    f.count()
    return f


def plain_tree(x, y, depth):
    """(feature, last value on the left) of each node by trying every split; ties by order."""
    def best(at):
        n, total, found = len(at), y[at].sum(), []
        for f in range(x.shape[1]):
            values = np.unique(x[at, f])
            for v in values[:-1]:
                left = y[at][x[at, f] <= v]
                score = left.sum() ** 2 / len(left) + (total - left.sum()) ** 2 / (n - len(left))
                found.append((score - total ** 2 / n, f, v))
        top = max((g for g, _, _ in found), default=0.0)
        if top <= 1e-9:
            return None
        return min((f, v) for g, f, v in found if g >= top * (1 - 1e-9))

    def build(at, level):
        split = best(at) if level < depth and len(at) > 1 else None
        if split is None:
            return float(y[at].mean())
        goes = x[at, split[0]] <= split[1]
        return (*split, build(at[goes], level + 1), build(at[~goes], level + 1))

    return build(np.arange(len(y)), 0)


def as_nested(tree, x, node=0):
    """A grown tree in the form of :func:`plain_tree` (thresholds as values to their left)."""
    if tree.feature[node] < 0:
        return pytest.approx(tree.value[node], rel=1e-9, abs=1e-9)
    f = tree.feature[node]
    v = x[x[:, f] <= tree.threshold[node], f].max()
    return (f, v, as_nested(tree, x, tree.left[node]), as_nested(tree, x, tree.right[node]))


def subset_nested(tree, x, at, node=0):
    if tree.feature[node] < 0:
        return pytest.approx(tree.value[node], rel=1e-9, abs=1e-9)
    f = tree.feature[node]
    goes = x[at, f] <= tree.threshold[node]
    return (f, x[at, f][goes].max(), subset_nested(tree, x, at[goes], tree.left[node]),
            subset_nested(tree, x, at[~goes], tree.right[node]))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("ranges", [2, 5, 64])
def test_exact_trees_equal_a_plain_search(spark, seed, ranges, monkeypatch):
    """Whatever the ranges (that only steer), with every fold left out and none."""
    r = random.Random(seed)
    rows = [(r.choice([0.0, 1.0, 2.5, 7.0]), round(r.gauss(0, 3), 1), r.random(), r.randrange(3))
            for _ in range(150)]
    rows = [(a, b, c, f, a * b + (5.0 if c > 0.7 else 0.0) + r.choice([0, 0, 40])) for a, b, c, f in rows]
    df = spark.createDataFrame(rows, "a double, b double, c double, fold int, label double").repartition(3)
    monkeypatch.setattr(H, "SAMPLE_ROWS", 60)
    kept = H.kept_rows(df, ["a", "b", "c"], "label", "fold", ranges, exact=True)
    models = [H.Model(f, 4) for f in (0, 1, 2, None)]
    H.grow(kept, models, exact=True)
    x = np.array([row[:3] for row in rows])
    y = np.array([row[4] for row in rows], float)
    fold = np.array([row[3] for row in rows])
    for m in models:
        keep = np.flatnonzero(fold != m.left_out) if m.left_out is not None else np.arange(len(y))
        at = subset_nested(m.tree, x[keep], np.arange(len(keep)))
        assert at == plain_tree(x[keep], y[keep], 4)


def test_fold_complement_equals_separate_mllib_fits_on_bins(spark, feats):
    rows = H.kept_rows(feats, FEATS, C.LABEL_COL, "fold", 32, accuracy=10 ** 7)
    rmse, refits = H.tune(rows, [TREE], [0, 1, 2], exact=False, boosted=False, features=FEATS)
    assert rows.passes == 5 + 2  # ranges, five levels, errors: not six times five
    cutter = quantile_bins(feats, FEATS, 32, accuracy=10 ** 7)
    data = M.assembler(cutter.getOutputCols()).transform(plain_bins(cutter.transform(feats), cutter)).cache()
    est, ev = M.tree(max_bins=32), RegressionEvaluator()
    want = [ev.evaluate(est.fit(data.filter(f"fold <> {f}")).transform(data.filter(f"fold = {f}")))
            for f in range(3)]
    np.testing.assert_allclose(rmse[0], want, rtol=1e-9)
    scored = refits[0].transform(est.fit(data).transform(data).withColumnRenamed("prediction", "p"))
    assert scored.filter("abs(p - prediction) > 1e-6 * abs(p)").count() == 0


@pytest.mark.parametrize("binning", ["exact", "quantile"])
def test_candidates_equal_separate_boosted_fits(spark, feats, binning):
    """Depths, gains, steps and iterations in one growth; passes don't grow with the grid."""
    data = with_holdout(feats, 0.8, col="v").withColumn("v", F.col("v").cast("int"))
    grid = [{"maxDepth": d, "minInfoGain": g, "stepSize": s}
            for d in (1, 2) for g in (0.0, 3e5) for s in (0.1, 0.4)]
    few, res = [T.tune_trees(data, maps, TREE | {"maxIter": 3}, split_col="v", folds=[1], boosted=True,
                             binning=binning, bins=32, accuracy=10 ** 7) for maps in (grid[-1:], grid)]
    if binning == "quantile":
        assert res.extra["passes"] == few.extra["passes"]
        cutter = quantile_bins(data, FEATS, 32, accuracy=10 ** 7)
        data, inputs = plain_bins(cutter.transform(data), cutter), cutter.getOutputCols()
        bins = 32
    else:
        assert res.extra["passes"] <= 2 * (3 * 2 + 3) + 2
        inputs, bins = FEATS, C.TREE_MAX_BINS
    rows = M.assembler(inputs).transform(data).cache()
    ev = RegressionEvaluator()
    for i in (0, 3, 5, 6):
        est = M.boosted(max_bins=bins, max_iter=3, **grid[i])
        want = ev.evaluate(est.fit(rows.filter("v = 0")).transform(rows.filter("v = 1")))
        assert res.metrics[i] == pytest.approx(want, rel=1e-9)


def test_many_nodes_take_several_passes(feats, monkeypatch):
    rows = H.kept_rows(feats, FEATS, C.LABEL_COL, "fold", 16, accuracy=10 ** 7)
    want, _ = H.tune(rows, [TREE], [0, 1, 2], exact=False, boosted=False, features=FEATS)
    passes = rows.passes
    monkeypatch.setattr(H, "MOST_CELLS", 3 * 6 * 16 * 4)  # four nodes at once
    got, _ = H.tune(rows, [TREE], [0, 1, 2], exact=False, boosted=False, features=FEATS)
    np.testing.assert_allclose(got, want, rtol=1e-12)
    assert rows.passes - passes > passes


def test_no_task_sees_all_values_of_a_feature(spark, monkeypatch):
    """The values that are sorted are those of ranges that may hold the best split."""
    df = spark.range(0, 20_000, 1, 4).selectExpr(
        "cast(id as double) AS a", "0 AS fold", "CASE WHEN id < 7777 THEN 1.0 ELSE 5.0 END + pmod(id, 3) AS label")
    rows = H.kept_rows(df, ["a"], "label", "fold", 100, exact=True)
    looked = []
    inside = H._look_inside
    monkeypatch.setattr(H, "_look_inside", lambda *a: (looked.append(len(a[2])), inside(*a)))
    model = H.Model(None, 1)
    H.grow(rows, [model], exact=True)
    assert model.tree.threshold[0] == 7776.5 and looked and max(looked) <= 2


@pytest.mark.parametrize("label", ["0.0", "7.5", "a"])
def test_constant_labels_and_features(spark, label):
    df = spark.range(50).selectExpr("1.0D AS a", "cast(id as double) AS b", "cast(pmod(id, 2) as int) AS fold",
                                    f"cast({label} as double) AS label")
    rows = H.kept_rows(df, ["a", "b"], "label", "fold", exact=True)
    rmse, refits = H.tune(rows, [TREE], [0, 1], exact=True, boosted=False, features=["a", "b"])
    assert rmse == [[0.0, 0.0]] and refits[0].trees[0].feature == [-1]
    one = H.kept_rows(df.limit(1), ["a", "b"], "label", "fold", exact=True)
    with pytest.raises(ValueError, match="no training rows"):
        H.tune(one, [TREE], [0], exact=True, boosted=False, features=["a", "b"])
    with pytest.raises(ValueError, match="no rows"):
        H.tune(rows, [TREE], [5], exact=True, boosted=False, features=["a", "b"])
    with pytest.raises(ValueError, match="no training rows"):
        H.kept_rows(df.limit(0), ["a"], "label", "fold")
    with pytest.raises(ValueError, match="NaN.*b"):
        H.kept_rows(df.withColumn("b", F.expr("if(id = 3, double('NaN'), b)") if "id" in df.columns
                                  else F.expr("if(b = 3, double('NaN'), b)")), ["a", "b"], "label", "fold")


def test_adjacent_doubles_are_kept_apart(spark):
    a, b = 986.754, np.nextafter(986.754, 1000)
    df = spark.createDataFrame([(float(v), 0, float(y)) for v, y in [(a, 1), (a, 1), (b, 9), (b, 9)]],
                               "a double, fold int, label double")
    model = H.Model(None, 1)
    H.grow(H.kept_rows(df, ["a"], "label", "fold", exact=True), [model], exact=True)
    assert (model.tree.threshold[0], model.tree.value[1:]) == (a, [1.0, 9.0])


def test_engines_agree_on_the_workflows(spark):
    rows = tpch_sales(spark, SF_SMALL)
    for run in (W.tree_cv, W.gbt_tvs):
        ours, theirs = run(spark, rows), run(spark, rows, engine="mllib")
        assert ours.tuning.metrics == pytest.approx(theirs.tuning.metrics, rel=1e-9)
        assert (ours.tuning.best, ours.n_train, ours.n_test) == (theirs.tuning.best, theirs.n_train, theirs.n_test)
        assert ours.test_rmse == pytest.approx(theirs.test_rmse, rel=1e-9)
        for res in (ours, theirs):
            res.release()
    with pytest.raises(ValueError, match="max_bins"):
        W.tree_cv(spark, rows, engine="histogram", max_bins=64)
    with pytest.raises(ValueError, match="engine"):
        W.tree_cv(spark, rows, engine="other")
    with pytest.raises(ValueError, match="minInstancesPerNode"):
        W.tree_cv(spark, rows, grid={"minInstancesPerNode": [2]})


# ---------------------------------------------------------------- expressions
def test_mllib_models_as_expressions(spark, feats):
    data = M.assembler().transform(feats)
    for est in (M.tree(max_bins=64, max_depth=4), M.boosted(max_bins=64, maxDepth=3, stepSize=0.3)):
        fitted = est.fit(data)
        model = from_mllib(fitted)
        both = model.transform(fitted.transform(data).withColumnRenamed("prediction", "p"))
        assert both.filter("abs(p - prediction) > 1e-9 * abs(p)").count() == 0
        feats.createOrReplaceTempView("raw_sales_rows")
        by_sql = spark.sql(f"SELECT sum({model.sql()}) AS s FROM raw_sales_rows").first()["s"]
        assert by_sql == pytest.approx(both.agg(F.sum("p")).first()[0], rel=1e-12)
        scored = model.transform(feats)
        scored.collect()
        plan = scored._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        line = [x for x in plan.splitlines() if "CASE WHEN" in x][0]
        assert line.lstrip(" :+-").startswith("*(") and "UDF" not in plan  # in generated code


def test_cut_trees_and_routes():
    tree = Tree()
    tree.add(5.0, 0)
    left, right = tree.split(0, 0, 1.5, 3.0, 2.0, 8.0)
    tree.split(right, 1, 0.5, 0.25, 7.0, 9.0)
    x = np.array([[1.0, 0.0], [1.5, 9.0], [2.0, 0.5], [2.0, 0.6]])
    values = lambda t: t.arrays()[4][route(t.arrays(), x)].tolist()
    assert values(tree) == [2.0, 2.0, 7.0, 9.0]
    assert values(tree.cut(1)) == values(tree.cut(2, 0.3)) == [2.0, 2.0, 8.0, 8.0]
    assert values(tree.cut(0)) == values(tree.cut(9, 4.0)) == [5.0] * 4
    assert tree.cut(9, 0.25).key() == tree.key() and TreeEnsemble([tree], [1.0]).smallest_gain() == 0.25


def test_passes_read_packed_rows(spark):
    """A counting pass gets arrays of many rows each, all rows once, and leaves the session as it was."""
    r = random.Random(3)
    rows = [(r.random(), r.choice([1.0, 2.0]), r.randrange(2), r.random()) for _ in range(700)]
    df = spark.createDataFrame(rows, "a double, b double, fold int, label double").repartition(2)
    kept = H.kept_rows(df, ["a", "b"], "label", "fold", 8, exact=True)
    assert kept.df.columns == ["x", "y", "fold", "at"] and kept.df.count() <= 4
    got = [part for x, y, fold, at in H._unpacked(kept.df.toArrow().to_batches(), kept.cuts)
           for part in zip(x[:, 0].tolist(), x[:, 1].tolist(), fold.tolist(), y.tolist())]
    assert sorted(got) == sorted(rows)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    H.grow(kept, [H.Model(None, 2)], exact=True)
    assert spark.conf.get(name, None) == before
    kept.release()
