"""Write PLANS.md: executed physical plans of the key operators.

Usage: python tools/dump_plans.py [sf_dir]
"""
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from lumenreg import config as C  # noqa: E402
from lumenreg.functions.keys import fold_of, split_digit  # noqa: E402
from lumenreg.operators import ridge as R  # noqa: E402
from lumenreg.operators import histogram_trees as H  # noqa: E402
from lumenreg.operators.partitioning import keep  # noqa: E402
from lumenreg.operators.split import TEST_FLAG, with_folds  # noqa: E402
from lumenreg.plans import workflows as W  # noqa: E402
from lumenreg.session import ensure_codegen_fields, get_session  # noqa: E402
from lumenreg.sources.fixture import tpch_sales  # noqa: E402


def executed(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0].rstrip()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Executed physical plans", "",
           f"Generated by `tools/dump_plans.py` on `{sf_dir}` (local[8], AQE on). "
           "`*(n)` marks whole-stage-codegen spans.", ""]

    feats = W.feature_rows(tpch_sales(spark, sf_dir))
    grp = F.when(split_digit("h") >= 7, F.lit(-1)).otherwise(fold_of(10, "h"))
    cols = list(C.FEATURE_COLS) + [C.LABEL_COL]
    moments = feats.groupBy(grp.alias("_grp")).agg(*R.moment_aggregates(cols))
    ensure_codegen_fields(spark, R.codegen_fields(len(cols)))
    moments_plan = executed(moments)
    out += ["## W1/W2: the whole grid search + test error as one aggregation", "",
            "Scan (pruned, `IsNotNull` pushed) -> join -> project (casts, md5 key hash) -> "
            "partial HashAggregate (count, 7 means, 28 `covar_pop` per fold/test group) -> "
            "exchange of at most 11 rows per partition -> final HashAggregate.", "", "```",
            moments_plan, "```", ""]

    rows = tpch_sales(spark, sf_dir)
    scan = [ln.strip() for ln in rows._jdf.queryExecution().executedPlan().toString().splitlines()
            if "FileScan" in ln or "Scan parquet" in ln]
    out += ["## Scans", "", "```"] + scan + ["```", ""]

    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    big = W.feature_rows(tpch_sales(spark, sf_dir)).agg(F.sum("label"))
    out += ["## The sales join when `part` is not small",
            "", "With the broadcast threshold off (as for a large `part`), the same plan is a "
            "sort-merge join; AQE's skew-join handling splits a hot part key.", "", "```",
            executed(big), "```", ""]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)

    flagged = W.flag_test_rows(with_folds(feats, 5, fold_col="fold"), 0.7, "h")
    kept, _ = keep(flagged.select(*C.FEATURE_COLS, C.LABEL_COL, "fold", TEST_FLAG))
    train = kept.filter(~F.col(TEST_FLAG))
    out += ["## W3/W4: one scan, training and test rows kept together", "",
            "The workflows' own kept frame; below, the read of it that a counting pass makes.", "", "```",
            executed(H.kept_rows(train, list(C.FEATURE_COLS), C.LABEL_COL, "fold", exact=True).merged()
                     .groupBy("fold").agg(F.count(F.lit(1)))), "```", ""]

    with open(os.path.join(ROOT, "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    print("wrote PLANS.md")


if __name__ == "__main__":
    main()
