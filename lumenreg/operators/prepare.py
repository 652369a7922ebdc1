"""Project, clean and type the sales rows into feature rows.

select(7 columns) -> drop rows with a NULL in any of them -> cast the integer
columns to double, rename the target to ``label``. Catalyst merges the null
tests into one filter and pushes ``IsNotNull`` into the scan; the casts stay in
one whole-stage-codegen projection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenreg.config import (CAST_TO_DOUBLE, FEATURE_COLS, LABEL_COL,
                             SELECTED_COLS, TARGET_COL)

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def select_used(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Keep the seven used columns (plus ``extra`` pass-through columns)."""
    missing = [c for c in SELECTED_COLS if c not in df.columns]
    if missing:
        raise ValueError(f"sales rows lack columns {missing}; have {df.columns}")
    return df.select(*SELECTED_COLS, *(extra or []))


def drop_incomplete(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows with a NULL in any of ``cols`` (NaN is kept, as isNotNull does)."""
    cols = cols or SELECTED_COLS
    cond = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    return df.filter(cond)


def check_numeric(df: DataFrame, cols: list[str]) -> None:
    """Fail early, naming the column, when a feature column is not numeric."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    bad = [(c, types[c].simpleString()) for c in cols
           if not isinstance(types[c], _NUMERIC)]
    if bad:
        detail = ", ".join(f"{c} ({t})" for c, t in bad)
        raise TypeError(
            f"feature columns must be numeric, found {detail}; clean the values "
            "(e.g. strip currency signs) before the workflow")


def to_feature_rows(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Cast the integer columns to double and alias the target as ``label``."""
    check_numeric(df, SELECTED_COLS)
    cols = []
    for c in FEATURE_COLS:
        cols.append(F.col(c).cast("double").alias(c) if c in CAST_TO_DOUBLE else F.col(c))
    cols.append(F.col(TARGET_COL).cast("double").alias(LABEL_COL))
    return df.select(*cols, *(extra or []))


def prepare_features(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """select -> not-null filter -> cast/label, in one lazy plan."""
    return to_feature_rows(drop_incomplete(select_used(df, extra)), extra)
