"""Run one sales-regression workflow from the command line.

    spark-submit lumenreg/cli.py --workflow tree_cv --csv sales.csv
    python -m lumenreg.cli --workflow linear_cv --table sales_rows
    python -m lumenreg.cli --workflow gbt_tvs --tpch /root/testdata/sf0.1

Sources: a headed CSV in the 24-column sales layout (cleaned or raw header;
the declared schema by default, or inferred types with ``--infer``), a catalog
table, or the
TPC-H-like driver tables. Splits hash the ``--key`` column(s) (default
``Invoice/Item Number``) or use a seeded ``randomSplit`` (``--split random``).
Prints the report row, the candidates table and a preview of the predictions;
the predictions stay registered as a SQL view for the session.
"""

from __future__ import annotations

import argparse
import sys

from lumenreg.operators.split import with_key_hash
from lumenreg.plans import workflows as W
from lumenreg.session import get_session
from lumenreg.sources.catalog import load_sales
from lumenreg.sources.fixture import tpch_sales

WORKFLOWS = {"linear_cv": W.linear_cv, "linear_tvs": W.linear_tvs,
             "tree_cv": W.tree_cv, "gbt_tvs": W.gbt_tvs}


def parse_args(argv=None):
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--workflow", choices=sorted(WORKFLOWS), required=True)
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="headed sales CSV file or folder")
    src.add_argument("--table", help="catalog table or view with sales rows")
    src.add_argument("--tpch", help="folder with lineitem/part parquet tables")
    p.add_argument("--infer", action="store_true",
                   help="infer column types (an extra pass) instead of the declared schema")
    p.add_argument("--key", action="append", default=None,
                   help="row key column(s) for the hash split (repeatable)")
    p.add_argument("--split", choices=["hash", "random"], default="hash")
    p.add_argument("--hash", dest="hash_method", choices=["md5", "xxhash64"], default="md5",
                   help="row-key hash for the split (xxhash64 is cheaper per row)")
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--master", default=None)
    p.add_argument("--preview", type=int, default=20)
    return p.parse_args(argv)


def run(args, spark=None):
    spark = spark or get_session(args.master)
    if args.tpch:
        rows, key_cols = tpch_sales(spark, args.tpch, hash_method=args.hash_method), None
    else:
        rows = load_sales(spark, path=args.csv, table=args.table, infer=args.infer)
        key_cols = args.key or ["Invoice/Item Number"]
        if all(k in rows.columns for k in key_cols):
            rows = with_key_hash(rows, key_cols, "h", args.hash_method)
        if args.split == "hash" and any(k not in rows.columns for k in key_cols):
            raise SystemExit(f"key column(s) {key_cols} not in the data; pass --key or --split random")
        if args.split == "random":
            key_cols = key_cols if all(k in rows.columns for k in key_cols) else rows.columns
    fn = WORKFLOWS[args.workflow]
    kw = {"split": args.split}
    kw["seed" if args.workflow.startswith("linear") else "split_seed"] = args.seed
    result = fn(spark, rows, key_cols=key_cols, **kw)
    return spark, result


def main(argv=None) -> int:
    args = parse_args(argv)
    spark, result = run(args)
    result.report(spark).show(truncate=False)
    result.tuning.candidates(spark).show(truncate=False)
    spark.sql(f"SELECT trueLabel, prediction FROM {result.view}").show(args.preview)
    return 0


if __name__ == "__main__":
    sys.exit(main())
