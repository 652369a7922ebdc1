"""Every registered query against its DuckDB oracle (sf0.001), plus the workflows."""

import math

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lumenreg.plans import workflows as W
from lumenreg.plans.queries import QUERIES
from lumenreg.sources.fixture import tpch_sales
from tests.conftest import SF_SMALL



def _canon(rows):
    out = []
    for r in rows:
        out.append(tuple("NULL" if v is None else repr(float(v)) if isinstance(v, float) else str(v)
                         for v in r))
    return sorted(out)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    spark_rows = [tuple(r[c] for c in cols) for r in df.collect()]
    rel = duck(SF_SMALL).execute(oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    oracle_rows = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert len(spark_rows) == len(oracle_rows)
    assert _canon(spark_rows) == _canon(oracle_rows)


def test_every_query_registered_has_callable():
    q = queries()
    assert set(oracle_sql()) <= set(q)
    assert set(QUERIES) <= set(oracle_sql())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["trueLabel", "prediction"]
    assert df.count() > 0


def test_workflows_end_to_end(spark):
    rows = tpch_sales(spark, SF_SMALL)
    w1 = W.linear_cv(spark, rows)
    w2 = W.linear_tvs(spark, rows)
    w3 = W.tree_cv(spark, rows, max_bins=256)
    w4 = W.gbt_tvs(spark, rows, max_bins=256,
                   grid={"maxDepth": [2], "stepSize": [0.1, 0.4]})
    for res in (w1, w2, w3, w4):
        assert res.n_train > 0 and res.n_test > 0 and math.isfinite(res.test_rmse)
        scatter = spark.sql(f"SELECT trueLabel, prediction FROM {res.view}")
        assert scatter.count() == res.n_test
    # each workflow keeps its own view: W3's predictions survive W4's run
    views = {res.view for res in (w1, w2, w3, w4)}
    assert len(views) == 4 and all(spark.catalog.tableExists(v) for v in views)
    w3_rmse = spark.sql(f"SELECT sqrt(avg(power(trueLabel - prediction, 2))) AS r FROM {w3.view}").first()["r"]
    assert w3_rmse == pytest.approx(w3.test_rmse, rel=1e-12)
    assert len(w1.tuning.param_maps) == 6 and w1.tuning.best % 2 == 0  # maxIter tie -> first
    # test RMSE from moments equals the scored predictions
    direct = w1.predictions.selectExpr(
        "sqrt(avg(power(trueLabel - prediction, 2))) AS r").first()["r"]
    assert w1.test_rmse == pytest.approx(direct, rel=1e-9)
    assert w1.report(spark).count() == 1


def test_load_sales_writes_compressed_files_and_joins_once(spark, monkeypatch):
    """All columns of three files as plain text are many times the tables."""
    from lumenreg.plans import queries as Q
    from lumenreg.session import remove_scratch

    paths, make = [], Q.scratch_dir
    monkeypatch.setattr(Q, "scratch_dir", lambda s, name: paths.append(make(s, name)) or paths[-1])
    rows = Q.q_load_sales(spark, SF_SMALL)
    files = [f for path in paths for f in spark.read.text(path).inputFiles()]
    assert len(paths) == 3 and all(f.endswith(".csv.gz") for f in files)
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert {r["source"]: r["count"] for r in rows.groupBy("source").count().collect()} == {
        name: lines for name in ("cleaned", "raw", "reordered", "inferred", "table")}
    for path in paths:
        remove_scratch(spark, path)
