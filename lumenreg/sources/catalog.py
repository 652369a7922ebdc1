"""Catalog sources and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_sales_table(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table or view by name (same plan as ``SELECT *``)."""
    return spark.table(name)


def register_view(df: DataFrame, name: str) -> str:
    """Register a DataFrame as a session temp view and return the name."""
    df.createOrReplaceTempView(name)
    return name


def load_sales(spark: SparkSession, *, path: str | None = None,
               table: str | None = None, fmt: str = "csv",
               infer: bool = False) -> DataFrame:
    """Load sales rows from a file path or a catalog table.

    Exactly one of ``path`` / ``table`` must be given. Raw headers are
    normalised to the cleaned column names. CSV columns are bound by name, file by
    file: a folder may hold files of different headers, see
    ``sources.csv.read_sales_files``.
    """
    from lumenreg.sources.csv import normalize_header, read_sales_csv, read_sales_files

    if (path is None) == (table is None):
        raise ValueError("give exactly one of path= or table=")
    if table is not None:
        df = read_sales_table(spark, table)
    elif fmt == "csv" and infer:
        df = read_sales_csv(spark, path, infer=True)
    elif fmt == "csv":
        df = read_sales_files(spark, path)
    else:
        df = spark.read.format(fmt).load(path)
    return normalize_header(df)
