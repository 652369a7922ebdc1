"""Scoring, prediction views and metric reports (all as DataFrames)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lumenreg.config import (FEATURES_COL, PREDICTION_COL, TRUE_LABEL_COL)
from lumenreg.session import scratch_dir


def score(model, test: DataFrame) -> DataFrame:
    """Batch scoring: lazy ``transform`` (JVM expressions, no Python per row)."""
    return model.transform(test)


def predictions(scored: DataFrame, keep_features: bool = True) -> DataFrame:
    cols = ([FEATURES_COL] if keep_features and FEATURES_COL in scored.columns else [])
    return scored.select(*cols, PREDICTION_COL, TRUE_LABEL_COL)


def publish(pred: DataFrame, view: str) -> str:
    """Expose predictions to SQL under a per-workflow view name."""
    pred.createOrReplaceTempView(view)
    return view


def publish_durable(pred: DataFrame, view: str, path: str | None = None) -> tuple:
    """Write the predictions once, and publish the written rows: (rows, path, count, RMSE).

    The view changes only after the whole table is written, and reads the files: no
    cache and no source stands behind it. ``path`` defaults to a folder of its own in
    the shared scratch. Count and squared error are observed while the rows are
    written, so the report is of the very rows that are served, and costs no job.
    """
    spark = pred.sparkSession
    path = path or scratch_dir(spark, f"predictions-{view}")
    seen = Observation()
    error = F.col(TRUE_LABEL_COL) - F.col(PREDICTION_COL)
    pred.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(error * error).alias("sse")).write.parquet(path)
    written = spark.read.schema(pred.schema).parquet(path)
    publish(written, view)
    n, sse = seen.get["n"], seen.get["sse"]
    return written, path, n, (sse / n) ** 0.5 if n else float("nan")


def scatter(spark: SparkSession, view: str) -> DataFrame:
    """The truth-vs-prediction scatter data, as SQL over the view."""
    return spark.sql(f"SELECT {TRUE_LABEL_COL}, {PREDICTION_COL} FROM {view}")


def rmse_expr(label: str = TRUE_LABEL_COL, prediction: str = PREDICTION_COL):
    return F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2)))


def rmse_frame(scored: DataFrame, label: str = TRUE_LABEL_COL,
               prediction: str = PREDICTION_COL) -> DataFrame:
    """One-row (n_rows, rmse) report — one aggregation job, partial agg map-side."""
    return scored.agg(F.count(F.lit(1)).alias("n_rows"),
                      rmse_expr(label, prediction).alias("rmse"))


def preview(df: DataFrame, n: int = 20, order_by: list | None = None) -> DataFrame:
    """The first ``n`` rows as a DataFrame (``show`` is for people).

    With ``order_by`` they are the same on every run; Spark keeps the ``n`` best of
    each partition, it doesn't sort the whole.
    """
    return (df.orderBy(*order_by) if order_by else df).limit(n)
