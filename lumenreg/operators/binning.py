"""Quantile binning ahead of MLlib tree training, on request.

MLlib's exact split search counts a feature's distinct values in one task. For
features with billions of them, ``binning="quantile"`` replaces every feature by
its equal-frequency bin number: cut points are values at equal steps of rank of the
training rows (see :func:`rank_values`; at most ``bins - 1`` of each feature reach the
driver), and the same ``Bucketizer`` is part of the scoring pipeline. The default,
``"exact"``, leaves features as they are, whatever the data's size.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# tasks get these functions by value: executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINNING = ("exact", "quantile")
BINS = 256
#: Ranges of a column that ranks are first looked up in, and rows, about, they are drawn from.
#: They steer the search; its values don't depend on them.
RANK_RANGES, RANK_ROWS = 2048, 50_000


def rank_values(df: DataFrame, columns: list[str], shares: list[float], rows: int) -> list[list]:
    """Of each column, the values at ranks ceil(share * n) of its n values; nulls don't count.

    The ranks are exact whatever the number of rows (``rows``, about, for the sample). Tasks
    count the rows in ranges whose ends come from a sample, and only the ranges that hold a
    rank are read by value: they are a small part of the rows, and a value that is most of
    a column is one range. No task holds a column, no driver or sketch its values.
    """
    data = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    drawn = data.sample(min(1.0, RANK_ROWS / max(rows, 1)), 1).toArrow()
    ends = []
    for column in drawn.columns:
        values = np.sort(column.drop_null().to_numpy())
        steps = np.arange(1, RANK_RANGES) * len(values) // RANK_RANGES
        ends.append(np.unique(values[steps] if len(values) else np.zeros(1)))

    def places(batch):
        for i, end in enumerate(ends):
            values = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
            yield i, values, np.searchsorted(end, values, side="right")

    def count(batches):
        shape = (len(ends), RANK_RANGES)
        n, low, high = np.zeros(shape, np.int64), np.full(shape, np.inf), np.full(shape, -np.inf)
        for batch in batches:
            for i, values, at in places(batch):
                n[i] += np.bincount(at, minlength=RANK_RANGES)
                np.minimum.at(low[i], at, values)
                np.maximum.at(high[i], at, values)
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met, pa.int64()), *(pa.array(a.ravel()[met]) for a in (n, low, high))],
            names=["place", "n", "low", "high"])

    counted = data.mapInArrow(count, "place long, n long, low double, high double").groupBy("place").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).collect()
    ranges = {r["place"]: r for r in counted}
    wanted: dict = {}  # (column, share) -> value, or (place, rank in it)
    for i in range(len(columns)):
        mine = sorted(p for p in ranges if p // RANK_RANGES == i)
        until = np.cumsum([ranges[p]["n"] for p in mine])
        for share in shares if mine else []:
            rank = min(max(int(np.ceil(share * int(until[-1]))), 1), int(until[-1]))
            k = int(np.searchsorted(until, rank))
            r = ranges[mine[k]]
            wanted[i, share] = r["low"] if r["low"] == r["high"] else (mine[k], rank - int(until[k] - r["n"]))
    open_ = np.unique([w[0] for w in wanted.values() if isinstance(w, tuple)]).astype(np.int64)
    if len(open_):
        hit = np.zeros(len(columns) * RANK_RANGES, bool)
        hit[open_] = True

        def pick(batches):
            for batch in batches:
                for i, values, at in places(batch):
                    at = at + i * RANK_RANGES
                    mine = hit[at]
                    yield pa.RecordBatch.from_arrays([pa.array(at[mine], pa.int64()), pa.array(values[mine])],
                                                     names=["place", "value"])

        running = Window.partitionBy("place").orderBy("value")
        sought = df.sparkSession.createDataFrame(
            sorted({w for w in wanted.values() if isinstance(w, tuple)}), "place long, rank long")
        found = (data.mapInArrow(pick, "place long, value double").groupBy("place", "value")
                 .agg(F.count(F.lit(1)).alias("n")).withColumn("until", F.sum("n").over(running))
                 .join(F.broadcast(sought), "place").where("rank <= until AND rank > until - n")
                 .select("place", "rank", "value").collect())
        at = {(r["place"], r["rank"]): r["value"] for r in found}
        wanted = {k: at[w] if isinstance(w, tuple) else w for k, w in wanted.items()}
    return [[wanted[i, share] for share in shares if (i, share) in wanted] for i in range(len(columns))]


def quantile_bins(df: DataFrame, features: list[str], bins: int = BINS,
                  accuracy: int | None = None) -> Bucketizer:
    """A Bucketizer from each feature to its bin number, column ``<feature>_bin``.

    A cut point is the value at rank ceil(i / bins * n); values equal to a cut go above
    it. Ranks are exact, so within n / ``accuracy`` ranks whatever accuracy is asked for.
    """
    if bins < 2:
        raise ValueError(f"need at least 2 bins, got {bins}")
    shares = [i / bins for i in range(1, bins)]
    found = rank_values(df, features, shares, df.count())
    splits = [[float("-inf"), *sorted({float(v) for v in values}), float("inf")] for values in found]
    splits = [s if len(s) > 2 else [float("-inf"), 0.0, float("inf")] for s in splits]
    return Bucketizer(splitsArray=splits, inputCols=list(features),
                      outputCols=[f"{c}_bin" for c in features], handleInvalid="error")


def plain_bins(binned: DataFrame, bucketizer: Bucketizer) -> DataFrame:
    """Binned rows whose bin numbers are plain numbers.

    A Bucketizer marks its output as nominal, and MLlib's trees would then take bins as
    categories to be put in any order, not as ranges of a value.
    """
    for c in bucketizer.getOutputCols():
        binned = binned.withMetadata(c, {})
    return binned
