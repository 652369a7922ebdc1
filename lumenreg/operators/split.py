"""Train/test splits, folds and the held-out validation cut.

Two families:

* ``with_random_flag`` / ``random_split`` — one seeded random number for each
  row, drawn from a counter-based generator whose counter is the row itself (its key
  columns, by default all columns). It does not depend on partitions, on the order of
  rows or on when it is computed, so a part that is computed again after a lost
  executor has the same rows. Rows equal in the key columns fall into the same part.
* ``with_test_flag`` / ``hash_split`` / ``with_folds`` / ``with_holdout`` —
  derived from a 32-bit hash of each row's key. Same rows on every run, every engine and after
  task retries; needs no shuffle and no extra pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenreg.config import LABEL_COL, TRUE_LABEL_COL
from lumenreg.functions.keys import fold_of, holdout_slot, row_hash, split_slot

TEST_FLAG = "_is_test"


def with_random_flag(df: DataFrame, train_fraction: float = 0.7, seed: int = 42,
                     flag: str = TEST_FLAG, key_cols: list[str] | None = None) -> DataFrame:
    """Flag test rows by one seeded random number each (the workflows' random split)."""
    if not 0 < train_fraction < 1:
        raise ValueError(f"train fraction must lie between 0 and 1, got {train_fraction}")
    draw = row_hash(F.lit(seed), *[F.col(f"`{c}`") for c in key_cols or df.columns])
    return df.withColumn(flag, draw / F.lit(2.0 ** 32) >= F.lit(float(train_fraction)))


def random_split(df: DataFrame, weights=(0.7, 0.3), seed: int = 42):
    """Seeded random (train, test); the weights need not add up to 1."""
    flagged = with_random_flag(df, weights[0] / sum(weights), seed)
    return (flagged.filter(~F.col(TEST_FLAG)).drop(TEST_FLAG),
            flagged.filter(TEST_FLAG).drop(TEST_FLAG))


def with_key_hash(df: DataFrame, key_cols: list[str], h: str = "h",
                  method: str = "md5") -> DataFrame:
    """Add the row-key hash column ``h`` unless it is already there.

    A row whose key columns are all NULL is hashed by all its columns, so that
    such rows don't share one split, fold and cut.
    """
    if h in df.columns:
        return df
    keyless = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNull() for c in key_cols])
    every = [F.col(f"`{c}`").cast("string") for c in df.columns]
    keys = [F.col(f"`{c}`") for c in key_cols]
    return df.withColumn(h, F.when(keyless, row_hash(*every, method=method))
                         .otherwise(row_hash(*keys, method=method)))


def train_cut(fraction: float) -> int:
    """The split slot (of 10000) at which test rows begin; refuses what it can't honour."""
    cut = round(fraction * 10_000)
    if abs(cut - fraction * 10_000) > 1e-6 or not 0 < cut < 10_000:
        raise ValueError("the train fraction must lie between 0 and 1, in steps of 0.0001, "
                         f"got {fraction}")
    return cut


def with_test_flag(df: DataFrame, train_fraction: float = 0.7, h: str = "h",
                   flag: str = TEST_FLAG) -> DataFrame:
    """Flag test rows by the key hash."""
    return df.withColumn(flag, split_slot(h) >= train_cut(train_fraction))


def hash_split(df: DataFrame, train_fraction: float = 0.7, h: str = "h"):
    """Deterministic (train, test) split on the key hash."""
    flagged = with_test_flag(df, train_fraction, h)
    return (flagged.filter(~F.col(TEST_FLAG)).drop(TEST_FLAG),
            flagged.filter(TEST_FLAG).drop(TEST_FLAG))


def with_folds(df: DataFrame, k: int, h: str = "h", fold_col: str = "fold") -> DataFrame:
    """Add an integer fold column 0..k-1 (independent of the split digit)."""
    if k < 2:
        raise ValueError("need at least 2 folds")
    return df.withColumn(fold_col, fold_of(k, h))


def with_holdout(df: DataFrame, train_ratio: float = 0.8, h: str = "h",
                 col: str = "is_validation") -> DataFrame:
    """Flag the validation rows of a train/validation cut (ratio in 1/1000)."""
    cut = round(train_ratio * 1000)
    if abs(cut - train_ratio * 1000) > 1e-6 or not 0 < cut < 1000:
        raise ValueError("the train ratio must lie between 0 and 1, in steps of 0.001, "
                         f"got {train_ratio}")
    return df.withColumn(col, holdout_slot(h) >= cut)


def rename_label(test: DataFrame) -> DataFrame:
    """Test rows carry their truth as ``trueLabel``."""
    return test.withColumnRenamed(LABEL_COL, TRUE_LABEL_COL)

