"""Physical-plan properties that matter at scale."""

import os

import pytest
from pyspark.sql import functions as F

from lumenreg import config as C
from lumenreg.functions.keys import fold_of
from lumenreg.operators import evaluate as E
from lumenreg.operators import histogram_trees as H
from lumenreg.operators import ridge as R
from lumenreg.operators.partitioning import MERGE_PARTITIONS, SMALL_PARTITIONS, keep, merged
from lumenreg.operators.split import with_folds
from lumenreg.plans import workflows as W
from lumenreg.session import ensure_codegen_fields
from lumenreg.sources.fixture import tpch_sales
from tests.conftest import SF_SMALL, sql_conf


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df) -> str:
    """Executed adaptive plan (after the run), without the initial-plan section."""
    df.collect()
    return _plan(df).split("== Initial Plan ==")[0]


def test_moments_pass_is_one_codegen_partial_aggregation(spark):
    feats = W.feature_rows(tpch_sales(spark, SF_SMALL))
    cols = list(C.FEATURE_COLS) + [C.LABEL_COL]
    agg = feats.groupBy(fold_of(10, "h").alias("g")).agg(*R.moment_aggregates(cols))
    ensure_codegen_fields(spark, R.codegen_fields(len(cols)))
    assert int(spark.conf.get("spark.sql.codegen.maxFields")) >= R.codegen_fields(len(cols))
    ensure_codegen_fields(spark, 10)  # never lowered: workflows may run side by side
    assert int(spark.conf.get("spark.sql.codegen.maxFields")) >= R.codegen_fields(len(cols))
    plan = _final_plan(agg)
    # partial aggregation before the exchange, final after it
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange hashpartitioning") == 1
    # both aggregations inside whole-stage codegen (no interpreted fallback)
    assert plan.count("HashAggregate(keys=") == 2
    assert all(line.lstrip(" :+-").startswith("*(")
               for line in plan.splitlines() if "HashAggregate" in line)


def test_scan_prunes_columns_and_pushes_null_filters(spark):
    feats = W.feature_rows(tpch_sales(spark, SF_SMALL))
    plan = _plan(feats)
    li_scan = [line for line in plan.splitlines() if "lineitem" in line][0]
    assert "PushedFilters: [IsNotNull(" in li_scan
    for unused in ("l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"):
        assert unused not in li_scan


def test_join_is_not_forced_to_broadcast(spark):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(tpch_sales(spark, SF_SMALL))
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_kept_rows_keep_the_partitions_of_the_scan(spark):
    """Nothing is merged before rows are kept; only tables of few partitions are spread."""
    many = spark.range(0, 1000).repartition(200)
    kept, n = keep(many)
    assert n == 1000 and kept.rdd.getNumPartitions() == 200
    assert merged(kept, n).rdd.getNumPartitions() == MERGE_PARTITIONS
    assert merged(kept, 10 ** 9).rdd.getNumPartitions() == 200
    kept.unpersist()
    one = spark.range(0, 400_000, 1, 1)
    kept, n = keep(one)
    assert n == 400_000 and kept.rdd.getNumPartitions() == 8  # follows the rows
    assert kept.agg(F.sum("id")).first()[0] == sum(range(400_000))
    kept.unpersist()
    kept, _ = keep(many, partitions=3)
    assert kept.rdd.getNumPartitions() == 3
    kept.unpersist()
    assert SMALL_PARTITIONS < MERGE_PARTITIONS
    with pytest.raises(ValueError):
        keep(many, storage="disk")


def test_histogram_bytes_do_not_grow_with_partitions(spark):
    """As many tasks send cells, whatever number of small partitions is kept."""
    feats = with_folds(W.feature_rows(tpch_sales(spark, SF_SMALL)), 3, fold_col="fold")
    for n in (100, 300):
        rows = H.kept_rows(feats.repartition(n), list(C.FEATURE_COLS), C.LABEL_COL, "fold", exact=True)
        assert rows.merged().rdd.getNumPartitions() == MERGE_PARTITIONS


def test_published_predictions_outlive_caches(spark):
    """The view reads files: no source scan and no cache behind it, for every workflow."""
    rows = tpch_sales(spark, SF_SMALL)
    for run in (lambda: W.tree_cv(spark, rows, k=2, max_depth=2),
                lambda: W.tree_cv(spark, rows, k=2, max_depth=2, max_bins=64),
                lambda: W.gbt_tvs(spark, rows, grid={"maxDepth": [1], "stepSize": [0.1]}),
                lambda: W.linear_cv(spark, rows, k=2), lambda: W.linear_tvs(spark, rows)):
        res = run()
        spark.catalog.clearCache()
        view = spark.table(res.view)
        plan = view._jdf.queryExecution().executedPlan().toString()
        assert "InMemory" not in plan.replace("InMemoryFileIndex", "") and "lineitem" not in plan
        assert all(res.path.split("/")[-1] in f for f in view.inputFiles()) and view.count() == res.n_test
        direct = view.selectExpr("sqrt(avg(power(trueLabel - prediction, 2))) AS r").first()["r"]
        assert direct == pytest.approx(res.test_rmse, rel=1e-12)
        assert set(view.columns) == {C.FEATURES_COL, C.PREDICTION_COL, C.TRUE_LABEL_COL}
        path = res.path
        res.release()
        assert not spark.catalog.tableExists(res.view) and not os.path.exists(path.removeprefix("file:"))


def test_view_changes_only_when_all_is_written(spark):
    rows = tpch_sales(spark, SF_SMALL)
    res = W.linear_cv(spark, rows, k=2)
    bad = spark.table(res.view).withColumn(C.PREDICTION_COL, F.expr("raise_error('no')").cast("double"))
    with pytest.raises(Exception, match="no"):
        E.publish_durable(bad, res.view)
    assert spark.table(res.view).count() == res.n_test
    res.release()


def test_hot_part_key_is_split_by_the_skew_join(spark):
    from lumenreg.sources.fixture import read_table

    li = read_table(spark, SF_SMALL, "lineitem")
    pa = read_table(spark, SF_SMALL, "part")
    hot_key = pa.agg(F.min("p_partkey")).first()[0]
    # derived from the given table: a third of the lines point at one part; spread
    # over several map tasks as any large input is (AQE splits along map outputs)
    hot = li.repartition(8).withColumn(
        "l_partkey", F.when(F.pmod("l_orderkey", F.lit(3)) == 0, F.lit(hot_key))
        .otherwise(F.col("l_partkey")))
    def joined():
        return hot.join(pa, hot.l_partkey == pa.p_partkey).agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("l_extendedprice") * F.col("p_retailprice")).alias("v"))

    # thresholds scaled down to the fixture size (sizes are compressed shuffle bytes)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.enabled": "true",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    with sql_conf(spark, settings):
        skewed = joined()
        plan = _final_plan(skewed)
        got = skewed.first()
    assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    want = joined().first()  # default settings: broadcast join of the small part table
    assert got["n"] == want["n"] == li.count()  # nothing dropped
    assert got["v"] == pytest.approx(want["v"], rel=1e-12)
