"""Registered queries: one per operator group of the sales workflows.

Each query takes ``(spark, sf_dir)``, reads the driver tables (sales rows are
``lineitem`` joined to ``part``, see ``sources.fixture``) and returns a
DataFrame. ``oracle_queries.ORACLES`` holds the matching DuckDB SQL for every
query whose result has a closed SQL form; column names and types agree.
Floating results that two engines sum in different orders are rounded to
significant digits by the same IEEE steps on both sides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenreg import config as C
from lumenreg.functions.keys import fold_of
from lumenreg.functions.numeric import sig_round
from lumenreg.operators import evaluate as E
from lumenreg.operators import histogram_trees as H
from lumenreg.operators import models as M
from lumenreg.operators import ridge as R
from lumenreg.operators import tuning as T
from lumenreg.operators.prepare import drop_incomplete, prepare_features, to_feature_rows
from lumenreg.operators.binning import plain_bins, quantile_bins
from lumenreg.operators.partitioning import keep
from lumenreg.operators.trees import from_mllib
from lumenreg.operators.split import (TEST_FLAG, hash_split, rename_label, with_folds,
                                      with_holdout, with_random_flag, with_test_flag)
from lumenreg.plans import workflows as W
from lumenreg.session import scratch_dir
from lumenreg.sources.catalog import load_sales, read_sales_table, register_view
from lumenreg.sources.csv import (normalize_header, raw_projection_sql, read_sales_csv,
                                  read_sales_with_rejects, write_sales_csv)
from lumenreg.sources.fixture import tpch_sales
from lumenreg.sources.schema import SALES_SCHEMA

FEATS = list(C.FEATURE_COLS)


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_features(tpch_sales(spark, sf_dir), extra=["h"])


def _split(spark, sf_dir):
    train, test = hash_split(_features(spark, sf_dir))
    return train, rename_label(test)


def _released(result: W.WorkflowResult) -> W.WorkflowResult:
    """A result whose predictions aren't read."""
    result.release()
    return result


def _leaf_report(scored: DataFrame) -> DataFrame:
    """Per distinct prediction: rounded value, test rows, RMSE within the leaf."""
    return (scored.groupBy(C.PREDICTION_COL)
            .agg(F.count(F.lit(1)).alias("n_rows"), E.rmse_expr().alias("rmse"))
            .select(sig_round(C.PREDICTION_COL).alias("prediction"), "n_rows",
                    sig_round("rmse").alias("rmse")))


# ---------------------------------------------------------------- sources
def q_project_features(spark, sf_dir):
    """S4 + P1/P4/P5: catalog-table scan -> select -> cast -> label."""
    register_view(tpch_sales(spark, sf_dir, with_hash=False, typed=True), "sales_rows")
    return prepare_features(read_sales_table(spark, "sales_rows"))


def q_sql_alias_projection(spark, sf_dir):
    """S6 + P2: raw-header rows as a view, SQL projection with quoted aliases."""
    raw = tpch_sales(spark, sf_dir, with_hash=False, typed=True)
    clean_to_raw = {v: k for k, v in C.RAW_TO_CLEAN.items()}
    raw = raw.select(*[F.col(c).alias(clean_to_raw.get(c, c)) for c in raw.columns])
    register_view(raw, "temp_raw_sales")
    return spark.sql(raw_projection_sql("temp_raw_sales"))


def q_not_null_filter(spark, sf_dir):
    """P3: rows with a NULL in any used column are dropped (7 tests, one filter)."""
    s = tpch_sales(spark, sf_dir, with_hash=False)
    holey = s.select(
        F.when(F.col("BottleVolumeInMl") == 7, None).otherwise(F.col("Pack")).alias("Pack"),
        "BottleVolumeInMl",
        F.when(F.col("Pack") == 1, None).otherwise(F.col("StateBottleCost")).alias("StateBottleCost"),
        "StateBottleRetail",
        F.when(F.col("BottlesSold") == 50, None).otherwise(F.col("BottlesSold")).alias("BottlesSold"),
        F.when(F.col("Pack") == 50, None).otherwise(F.col("SaleInDollars")).alias("SaleInDollars"),
        "VolumeSoldInLitres",
    )
    return to_feature_rows(drop_incomplete(holey))


def q_csv_roundtrip(spark, sf_dir):
    """S1/S2/S3: write raw-header CSV to shared scratch, read back two ways."""
    path = scratch_dir(spark, "csv-roundtrip")
    write_sales_csv(tpch_sales(spark, sf_dir, with_hash=False, typed=True), path, raw_header=True)
    inferred = normalize_header(read_sales_csv(spark, path, infer=True))
    declared = normalize_header(read_sales_csv(spark, path))
    return (prepare_features(inferred).withColumn("mode", F.lit("inferred"))
            .unionByName(prepare_features(declared).withColumn("mode", F.lit("declared"))))


def q_load_sales(spark, sf_dir):
    """S3 + S5: the 24-column layout through ``load_sales`` from five sources.

    The rows are joined once for the three files, which are compressed: all their columns
    as plain text are many times the tables.
    """
    rows = tpch_sales(spark, sf_dir, with_hash=False, typed=True).persist()
    filler = {"string": F.lit("text, \"quoted\""), "int": F.lit(7), "double": F.lit(0.25)}
    full = rows.select(*[F.col(f.name) if f.name in rows.columns
                         else filler[f.dataType.simpleString()].alias(f.name)
                         for f in SALES_SCHEMA.fields])
    paths = {name: scratch_dir(spark, f"load-{name}") for name in ("cleaned", "raw", "reordered")}
    write_sales_csv(full, paths["cleaned"], compression="gzip")
    write_sales_csv(full, paths["raw"], raw_header=True, compression="gzip")
    write_sales_csv(full.select(*reversed(full.columns)), paths["reordered"], compression="gzip")
    rows.unpersist()
    register_view(full, "sales_rows_full")
    loaded = {"inferred": load_sales(spark, path=paths["raw"], infer=True),
              "table": load_sales(spark, table="sales_rows_full"),
              **{name: load_sales(spark, path=path) for name, path in paths.items()}}
    return reduce(DataFrame.unionByName, [
        prepare_features(df).withColumn("source", F.lit(name)) for name, df in loaded.items()])


def q_mixed_headers(spark, sf_dir):
    """S1 + S2 + S5: one folder with cleaned, raw and reordered files, each third of the rows
    in files of another header."""
    rows = tpch_sales(spark, sf_dir, typed=True).withColumn("part", F.pmod("h", F.lit(3))).cache()
    path = scratch_dir(spark, "mixed-headers")
    used = rows.drop("h", "part").columns
    for i, columns in enumerate((used, used, [*reversed(used), "h"])):
        write_sales_csv(rows.where(F.col("part") == i).select(columns), f"{path}/{i}", raw_header=i == 1)
    rows.unpersist()
    return prepare_features(load_sales(spark, path=path))


def q_csv_rejects(spark, sf_dir):
    """S3 + P3: cells that don't parse go to a result of their own, the other rows are kept."""
    rows = tpch_sales(spark, sf_dir, typed=True)
    part = F.pmod("h", F.lit(10))
    text = rows.select(*[F.col(c).cast("string").alias(c) for c in rows.columns if c != "h"], part.alias("part"))
    spoilt = (text.withColumn("StateBottleCost", F.when(F.col("part") == 3, F.concat(F.lit("$"), "StateBottleCost"))
                              .otherwise(F.col("StateBottleCost")))
              .withColumn("Pack", F.when(F.col("part").isin(3, 4), "6.5").otherwise(F.col("Pack"))))
    path = scratch_dir(spark, "rejects")
    write_sales_csv(spoilt.drop("part"), path, raw_header=True)
    kept, rejected = read_sales_with_rejects(spark, path)
    return (prepare_features(kept).withColumn("reason", F.lit(None).cast("string"))
            .unionByName(rejected.select("reason"), allowMissingColumns=True))


# ---------------------------------------------------------------- splits
def q_split_counts(spark, sf_dir):
    """R1 (hash form) + P6 + A1: rows in each part."""
    f = with_test_flag(_features(spark, sf_dir))
    part = F.when(F.col(TEST_FLAG), F.lit("test")).otherwise(F.lit("train"))
    return f.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n_rows"))


def q_random_split_invariants(spark, sf_dir):
    """R1 (seeded random split): the parts hold the input's rows, in the asked shares, again
    and again for a seed.

    Counts and order-independent sums of row hashes, of the input and of two
    evaluations of the split: map-side aggregates, no row is shuffled.
    """
    f = _features(spark, sf_dir)
    digest = [F.count(F.lit(1)).alias("n"),
              F.sum(F.xxhash64(*f.columns).cast("decimal(38,0)")).alias("rows_sum")]

    def parts():
        return with_random_flag(f, C.TRAIN_TEST_WEIGHTS[0], seed=42).groupBy(TEST_FLAG).agg(*digest)

    runs = (f.agg(*digest).select(F.lit("input").alias("run"), F.lit(False).alias(TEST_FLAG), "n",
                                  "rows_sum")
            .unionByName(parts().withColumn("run", F.lit("first")))
            .unionByName(parts().withColumn("run", F.lit("second"))))
    of = lambda run, col: F.sum(F.when(F.col("run") == run, F.col(col)))
    share = F.sum(F.when((F.col("run") == "first") & ~F.col(TEST_FLAG), F.col("n"))) / of("first", "n")
    train = lambda run: F.sum(F.when((F.col("run") == run) & ~F.col(TEST_FLAG),
                                     F.col("rows_sum")))
    return runs.agg(
        of("input", "n").cast("bigint").alias("n_rows"),
        of("first", "n").cast("bigint").alias("n_parts_rows"),
        (of("input", "rows_sum") == of("first", "rows_sum")).alias("same_rows"),
        (F.abs(share - C.TRAIN_TEST_WEIGHTS[0]) < 0.03).alias("share_as_asked"),
        (train("first") == train("second")).alias("seed_repeats"))


def q_kfold_counts(spark, sf_dir):
    """R2/R3: fold sizes (k=10, k=5) and the 80/20 validation cut, one pass."""
    train, _ = hash_split(_features(spark, sf_dir))
    tagged = with_folds(with_folds(train, 10, fold_col="f10"), 5, fold_col="f5")
    tagged = with_holdout(tagged, C.TVS_TRAIN_RATIO, col="tv").withColumn("tv", F.col("tv").cast("int"))
    long = tagged.selectExpr("stack(3, 'cv10', f10, 'cv5', f5, 'tvs', tv) AS (scheme, fold)")
    return long.groupBy("scheme", "fold").agg(F.count(F.lit(1)).alias("n_rows"))


# ---------------------------------------------------------------- linear
def _mllib_ridge(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    model = M.pipeline(M.linear(C.LR_REG_PARAM, C.LR_MAX_ITER)).fit(train)
    return model, test


def q_lr_coefficients(spark, sf_dir):
    """M1-M3: MLlib ridge (regParam 0.3) on the train part; coefficients + intercept."""
    model, _ = _mllib_ridge(spark, sf_dir)
    lr = model.stages[-1]
    rows = [(c, float(w)) for c, w in zip(FEATS, lr.coefficients)]
    rows.append(("intercept", float(lr.intercept)))
    df = spark.createDataFrame(rows, "term string, value double")
    return df.select("term", sig_round("value").alias("value"))


def q_lr_rmse(spark, sf_dir):
    """M6 + P7 + A2: score the test part, RMSE against trueLabel."""
    model, test = _mllib_ridge(spark, sf_dir)
    return E.rmse_frame(E.score(model, test)).select("n_rows", sig_round("rmse").alias("rmse"))


def q_lr_predictions(spark, sf_dir):
    """M6 + P7 (W1/W2 scoring path): closed-form ridge (regParam 0.3) fitted on the
    train part from one moments pass, every test row scored by a JVM expression."""
    train, test = _split(spark, sf_dir)
    fit = R.fit_ridge(R.grouped_moments(train, None)[None], C.LR_REG_PARAM)
    return fit.transform(test).select(
        C.TRUE_LABEL_COL, sig_round(C.PREDICTION_COL).alias(C.PREDICTION_COL))


def _grid_frame(spark, result: T.TuningResult):
    return result.candidates(spark).select(
        "candidate", "regParam", "maxIter", sig_round("rmse").alias("rmse"), "is_best")


def q_lr_cv_grid(spark, sf_dir):
    """T1 + T4 + A3/A4: 10-fold CV over regParam x maxIter, one moments pass."""
    res = _released(W.linear_cv(spark, tpch_sales(spark, sf_dir)))
    return _grid_frame(spark, res.tuning)


def q_lr_tvs_grid(spark, sf_dir):
    """T1 + T6: train/validation (80/20 cut) over the same grid, one moments pass."""
    res = _released(W.linear_tvs(spark, tpch_sales(spark, sf_dir)))
    return _grid_frame(spark, res.tuning)


def q_lr_cv_tvs_combined(spark, sf_dir):
    """W1 + W2 as the combined notebook runs them, from one scan: both grids."""
    cv, tvs = map(_released, W.linear_cv_tvs(spark, tpch_sales(spark, sf_dir)))
    return (_grid_frame(spark, cv.tuning).withColumn("workflow", F.lit("linear_cv"))
            .unionByName(_grid_frame(spark, tvs.tuning).withColumn("workflow", F.lit("linear_tvs"))))


def q_lr_workflow_report(spark, sf_dir):
    """W1 end to end: row counts, best candidate, tuning and test RMSE."""
    rep = _released(W.linear_cv(spark, tpch_sales(spark, sf_dir))).report(spark)
    return rep.select("workflow", "n_train", "n_test", "best_params",
                      sig_round("tuning_rmse").alias("tuning_rmse"),
                      sig_round("test_rmse").alias("test_rmse"))


def q_lr_tvs_workflow_report(spark, sf_dir):
    """W2 end to end: row counts, best candidate, validation and test RMSE."""
    rep = _released(W.linear_tvs(spark, tpch_sales(spark, sf_dir))).report(spark)
    return rep.select("workflow", "n_train", "n_test", "best_params",
                      sig_round("tuning_rmse").alias("tuning_rmse"),
                      sig_round("test_rmse").alias("test_rmse"))


# ---------------------------------------------------------------- trees
def _stump(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    model = M.pipeline(M.tree(max_depth=1)).fit(train)
    return model, test


def q_dt_stump(spark, sf_dir):
    """M4: depth-1 MLlib tree (maxBins 77582); per-leaf test rows and RMSE."""
    model, test = _stump(spark, sf_dir)
    return _leaf_report(E.score(model, test))


def q_dt_rmse(spark, sf_dir):
    """M4 + A2: test RMSE of the depth-1 tree against trueLabel."""
    model, test = _stump(spark, sf_dir)
    return E.rmse_frame(E.score(model, test)).select("n_rows", sig_round("rmse").alias("rmse"))


def q_dt_depth5(spark, sf_dir):
    """M4 as configured in W3 (depth 5, maxBins 77582): per-leaf test rows and RMSE."""
    train, test = _split(spark, sf_dir)
    model = M.pipeline(M.tree()).fit(train)
    return _leaf_report(E.score(model, test))


def q_dt_cv_stump(spark, sf_dir):
    """T2 + T5: empty grid, 5-fold CV of the depth-1 tree; fold RMSEs and mean."""
    train, _ = hash_split(_features(spark, sf_dir))
    assembled = M.assembler().transform(train).withColumn("fold", fold_of(5, "h"))
    est = M.tree(max_depth=1)
    res = T.tune_estimator(est, T.build_grid(est, None), assembled, split_col="fold",
                           splits=T.kfold_splits(5), parallelism=5)
    rows = [(i, float(v)) for i, v in enumerate(res.split_metrics[0])]
    rows.append((-1, float(res.metrics[0])))
    return spark.createDataFrame(rows, "fold int, rmse double").select(
        "fold", sig_round("rmse").alias("rmse"))


def q_gbt_two_stumps(spark, sf_dir):
    """M5: two boosted depth-1 trees, step 0.1; per-prediction test rows and RMSE."""
    train, test = _split(spark, sf_dir)
    model = M.pipeline(M.boosted(maxDepth=1, stepSize=0.1)).fit(train)
    return _leaf_report(E.score(model, test))


def q_prediction_view(spark, sf_dir):
    """S7 + P7 + P8: predictions published as a view, scatter SELECT over it."""
    model, test = _stump(spark, sf_dir)
    pred = E.predictions(E.score(model, test))
    view = C.VIEW_NAMES["dt_cv"]
    E.publish_durable(pred, view)
    return E.scatter(spark, view).select(
        C.TRUE_LABEL_COL, sig_round(C.PREDICTION_COL).alias(C.PREDICTION_COL))


def q_prediction_preview(spark, sf_dir):
    """S8: the first 20 predictions by row key (the preview is the feature)."""
    model, test = _stump(spark, sf_dir)
    first = E.preview(E.score(model, test), 20, ["h", C.TRUE_LABEL_COL, C.PREDICTION_COL])
    return E.predictions(first, keep_features=False).select(
        C.TRUE_LABEL_COL, sig_round(C.PREDICTION_COL).alias(C.PREDICTION_COL))


def q_dt_quantile_bins(spark, sf_dir):
    """M4 with ``binning="quantile"``: a depth-1 tree on 32 bins of each feature, at exact
    cut points."""
    train, test = _split(spark, sf_dir)
    kept, _ = keep(train.select(*FEATS, C.LABEL_COL))
    try:
        bucketizer = quantile_bins(kept, FEATS, 32, accuracy=10_000_000)
        assembler = M.assembler(bucketizer.getOutputCols())
        prepare = lambda df: assembler.transform(plain_bins(bucketizer.transform(df), bucketizer))
        model = M.tree(max_bins=32, max_depth=1).fit(prepare(kept))
    finally:
        kept.unpersist()
    return _leaf_report(E.score(model, prepare(test)))


def q_dt_cv_workflow(spark, sf_dir):
    """W3 end to end (depth 5, 5-fold CV, empty grid, refit, test RMSE): report row."""
    rep = _released(W.tree_cv(spark, tpch_sales(spark, sf_dir))).report(spark)
    return rep.select("workflow", "n_train", "n_test", "best_params",
                      sig_round("tuning_rmse").alias("tuning_rmse"),
                      sig_round("test_rmse").alias("test_rmse"))


def q_gbt_workflow_report(spark, sf_dir):
    """W4 end to end: tuning on the 80/20 cut, refit of the best on all training
    rows, test RMSE; report row."""
    rep = _released(W.gbt_tvs(spark, tpch_sales(spark, sf_dir))).report(spark)
    return rep.select("workflow", "n_train", "n_test", "best_params",
                      sig_round("tuning_rmse").alias("tuning_rmse"),
                      sig_round("test_rmse").alias("test_rmse"))


def q_gbt_tvs_grid(spark, sf_dir):
    """W4 end to end (maxIter 2, 32 candidates, 80/20 cut): candidates table."""
    res = _released(W.gbt_tvs(spark, tpch_sales(spark, sf_dir)))
    return res.tuning.candidates(spark).select(
        "candidate", "maxDepth", "minInfoGain", "stepSize",
        sig_round("rmse").alias("rmse"), "is_best")


def _report(result: W.WorkflowResult, spark) -> DataFrame:
    return _released(result).report(spark).select(
        "workflow", "n_train", "n_test", "best_params", sig_round("tuning_rmse").alias("tuning_rmse"),
        sig_round("test_rmse").alias("test_rmse"))


def q_dt_quantile_workflow(spark, sf_dir):
    """W3 with ``binning="quantile"``, 32 ranges at exact cut points: all five folds and the
    refit in one counting pass a level."""
    return _report(W.tree_cv(spark, tpch_sales(spark, sf_dir), binning="quantile", bins=32,
                             accuracy=10_000_000), spark)


def q_gbt_quantile_grid(spark, sf_dir):
    """W4 with ``binning="quantile"``: the 32 candidates on 32 ranges of each feature."""
    res = _released(W.gbt_tvs(spark, tpch_sales(spark, sf_dir), binning="quantile", bins=32,
                              accuracy=10_000_000))
    return res.tuning.candidates(spark).select(
        "candidate", "maxDepth", "minInfoGain", "stepSize", sig_round("rmse").alias("rmse"), "is_best")


def q_dt_random_workflow(spark, sf_dir):
    """R1 + W3 with the random split (seed 42), which every reader can draw again."""
    return _report(W.tree_cv(spark, tpch_sales(spark, sf_dir), split="random", split_seed=42), spark)


def q_lr_random_report(spark, sf_dir):
    """R1 + W1 with the random split (seed 42)."""
    return _report(W.linear_cv(spark, tpch_sales(spark, sf_dir), split="random", seed=42), spark)


def _ranges_tree(spark, sf_dir, depth):
    """A tree over all training rows from histograms, split between any two values."""
    train, test = _split(spark, sf_dir)
    rows = H.kept_rows(train.withColumn("_one", F.lit(0)), FEATS, C.LABEL_COL, "_one", exact=True)
    model = H.Model(None, depth)
    try:
        H.grow(rows, [model], exact=True)
    finally:
        rows.release()
    return H.TreeEnsemble([model.tree], [1.0], FEATS), test


def q_dt_stump_ranges(spark, sf_dir):
    """M4, exact split search without a task that sees all values of a feature: depth 1."""
    model, test = _ranges_tree(spark, sf_dir, 1)
    return _leaf_report(model.transform(test))


def q_dt_depth5_ranges(spark, sf_dir):
    """M4, exact split search without a task that sees all values of a feature: depth 5."""
    model, test = _ranges_tree(spark, sf_dir, 5)
    return _leaf_report(model.transform(test))


def q_dt_expression(spark, sf_dir):
    """M6: MLlib's depth-5 tree read into a nested CASE; scores raw columns."""
    train, test = _split(spark, sf_dir)
    model = from_mllib(M.pipeline(M.tree()).fit(train).stages[-1])
    return _leaf_report(model.transform(test))


def q_gbt_expression_sql(spark, sf_dir):
    """M6: MLlib's two boosted stumps as SQL text over a view of raw columns."""
    train, test = _split(spark, sf_dir)
    model = from_mllib(M.pipeline(M.boosted(maxDepth=1, stepSize=0.1)).fit(train).stages[-1])
    register_view(test, "sales_to_score")
    return _leaf_report(spark.sql(
        f"SELECT {C.TRUE_LABEL_COL}, {model.sql()} AS {C.PREDICTION_COL} FROM sales_to_score"))


QUERIES = {
    "project_features": q_project_features,
    "sql_alias_projection": q_sql_alias_projection,
    "not_null_filter": q_not_null_filter,
    "csv_roundtrip": q_csv_roundtrip,
    "load_sales": q_load_sales,
    "mixed_headers": q_mixed_headers,
    "csv_rejects": q_csv_rejects,
    "split_counts": q_split_counts,
    "random_split_invariants": q_random_split_invariants,
    "kfold_counts": q_kfold_counts,
    "lr_coefficients": q_lr_coefficients,
    "lr_rmse": q_lr_rmse,
    "lr_predictions": q_lr_predictions,
    "lr_cv_grid": q_lr_cv_grid,
    "lr_tvs_grid": q_lr_tvs_grid,
    "lr_cv_tvs_combined": q_lr_cv_tvs_combined,
    "lr_workflow_report": q_lr_workflow_report,
    "lr_tvs_workflow_report": q_lr_tvs_workflow_report,
    "dt_stump": q_dt_stump,
    "dt_rmse": q_dt_rmse,
    "dt_depth5": q_dt_depth5,
    "dt_cv_stump": q_dt_cv_stump,
    "dt_quantile_bins": q_dt_quantile_bins,
    "gbt_two_stumps": q_gbt_two_stumps,
    "prediction_view": q_prediction_view,
    "prediction_preview": q_prediction_preview,
    "dt_cv_workflow": q_dt_cv_workflow,
    "gbt_tvs_grid": q_gbt_tvs_grid,
    "gbt_workflow_report": q_gbt_workflow_report,
    "dt_quantile_workflow": q_dt_quantile_workflow,
    "gbt_quantile_grid": q_gbt_quantile_grid,
    "dt_random_workflow": q_dt_random_workflow,
    "lr_random_report": q_lr_random_report,
    "dt_stump_ranges": q_dt_stump_ranges,
    "dt_depth5_ranges": q_dt_depth5_ranges,
    "dt_expression": q_dt_expression,
    "gbt_expression_sql": q_gbt_expression_sql,
}
