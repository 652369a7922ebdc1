"""Arrow helpers: run a step over the texts of a DataFrame, a bounded slice at a time.

A *step* takes the texts of one slice as ``bytes`` (UTF-8) or ``None`` and
returns one value list (or Arrow array) for each output field. A slice holds
at most ``SLICE_BYTES`` of text, or a single longer text, so the memory of a
task does not depend on the partition's size.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

SLICE_BYTES = 4 << 20
SLICE_ROWS = 2000
MEMO_STEP = 10_000
MEMO_BYTES = 64 << 20
Step = Callable[[list], list]


_shipped: set = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    import lumenreg

    top = os.path.dirname(os.path.abspath(lumenreg.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="lumenreg-code-"), "lumenreg_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("lumenreg", os.path.relpath(path, top)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def map_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with this package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, length) of row runs whose texts stay within the slice bounds."""
    sizes = np.nan_to_num(pc.binary_length(texts).to_numpy(zero_copy_only=False), nan=0.0)
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and (held + n > SLICE_BYTES or i - start >= SLICE_ROWS):
            yield start, i - start
            start, held = i, 0
        held += int(n)
    if len(sizes) > start:
        yield start, len(sizes) - start


def with_text_columns(df: DataFrame, key_cols: list[str], text_col: str,
                      make: Callable[[], Step], fields: list[StructField]) -> DataFrame:
    """``key_cols`` of every row plus the step's ``fields`` computed from ``text_col``.

    ``make`` builds the step once per task, on the executor. Other columns of
    ``df`` are not read, whatever their names.
    """
    narrow = df.select(*[F.col(c).alias(f"key_{i}") for i, c in enumerate(key_cols)],
                       F.col(text_col).cast("binary").alias("text"))
    schema = StructType([StructField(c, f.dataType) for c, f in zip(key_cols, narrow.schema)]
                        + fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        step = make()
        for batch in batches:
            texts = batch.column(len(key_cols))
            for start, n in slices(batch, texts):
                part = batch.slice(start, n)
                new = step(part.column(len(key_cols)).to_pylist())
                columns = [*part.columns[:-1], *new]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                     for c, f in zip(columns, arrow)], schema=arrow)

    return map_arrow(narrow, run, schema)


def keep_rows(df: DataFrame, text_col: str, make: Callable[[], Step],
              also: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``df``, all columns unchanged, for which the step says ``True``.

    The step also gets the values of the ``also`` columns, a list for each.
    """
    at = [df.columns.index(c) for c in (text_col, *also)]
    arrow = to_arrow_schema(df.schema)

    def run(batches):
        step = make()
        for batch in batches:
            texts = batch.column(at[0]).cast(pa.binary())
            for start, n in slices(batch, texts):
                part = batch.slice(start, n)
                keep = step(texts.slice(start, n).to_pylist(),
                            *[part.column(i).to_pylist() for i in at[1:]])
                yield pa.RecordBatch.from_arrays(
                    part.filter(pa.array(keep, pa.bool_())).columns, schema=arrow)

    return map_arrow(df, run, df.schema)


class Memo(dict):
    """Token -> value, computed for new tokens of a slice together, ``MEMO_STEP`` at a time.

    It holds at most ``limit`` tokens of at most ``limit_bytes`` together, beside those
    of the current slice: beyond that it starts anew. Values never depend on what it holds.
    """

    def __init__(self, compute: Callable[[list], list], limit: int = 300_000,
                 limit_bytes: int = MEMO_BYTES):
        super().__init__()
        self.compute, self.limit, self.limit_bytes = compute, limit, limit_bytes
        self.held_bytes = 0

    def add(self, tokens: set) -> None:
        """Make sure that every token of the set has its value."""
        new = [t for t in tokens if t not in self]
        size = sum(map(len, new))
        if len(self) + len(new) > self.limit or self.held_bytes + size > self.limit_bytes:
            self.clear()
            new, size, self.held_bytes = tokens, sum(map(len, tokens)), 0
        self.held_bytes += size
        new = sorted(new)
        for start in range(0, len(new), MEMO_STEP):
            step = new[start:start + MEMO_STEP]
            self.update(zip(step, self.compute(step)))


def flat(lists: list[list]) -> tuple[list, np.ndarray]:
    """All items of the lists in order, and each list's start (plus the end)."""
    starts = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(x) for x in lists], out=starts[1:])
    return [y for x in lists for y in x], starts


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` along axis 0 between consecutive starts; empty runs give 0."""
    out = np.zeros((len(starts) - 1, *values.shape[1:]), np.float64)
    full = np.flatnonzero(starts[1:] > starts[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, starts[full], axis=0)
    return out
