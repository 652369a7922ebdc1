import math

from pyspark.sql import functions as F

from lumenreg.cli import parse_args, run
from lumenreg.sources.fixture import tpch_sales
from tests.conftest import SF_SMALL


def _write_sales_csv(spark, path):
    rows = tpch_sales(spark, SF_SMALL, with_hash=False, typed=True)
    rows = rows.withColumn("Invoice/Item Number",
                           F.concat(F.lit("INV-"), F.monotonically_increasing_id().cast("string")))
    rows.coalesce(1).write.option("header", True).csv(path)
    return rows.count()


def test_cli_csv_hash_split(spark, tmpdir_path):
    path = f"{tmpdir_path}/sales"
    n = _write_sales_csv(spark, path)
    _, res = run(parse_args(["--workflow", "linear_cv", "--csv", path, "--infer"]), spark)
    assert res.n_train + res.n_test == n
    assert math.isfinite(res.test_rmse)
    assert spark.sql(f"SELECT count(*) FROM {res.view}").first()[0] == res.n_test


def test_cli_random_split_tree(spark, tmpdir_path):
    path = f"{tmpdir_path}/sales"
    n = _write_sales_csv(spark, path)
    _, res = run(parse_args(["--workflow", "tree_cv", "--csv", path, "--infer",
                             "--split", "random", "--seed", "5"]), spark)
    assert res.n_train + res.n_test == n


def test_cli_tpch(spark):
    _, res = run(parse_args(["--workflow", "linear_tvs", "--tpch", SF_SMALL]), spark)
    assert res.n_train > res.n_test > 0


def test_cli_declared_schema_on_full_layout(spark, tmpdir_path):
    from lumenreg.sources.schema import SALES_SCHEMA

    rows = tpch_sales(spark, SF_SMALL, with_hash=False, typed=True)
    # the 24-column cleaned layout, unused columns filled with text/nulls
    full = rows.select(*[
        (F.concat(F.lit("INV-"), F.monotonically_increasing_id().cast("string"))
         if f.name == "Invoice/Item Number" else
         F.col(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in SALES_SCHEMA.fields])
    path = f"{tmpdir_path}/full"
    full.coalesce(1).write.option("header", True).csv(path)
    _, res = run(parse_args(["--workflow", "linear_tvs", "--csv", path]), spark)
    assert res.n_train + res.n_test == rows.count()
