"""Keeping rows that are read many times."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenreg.session import checkpointed

#: A table with fewer partitions than this is dealt anew, at so many rows a partition at least.
SMALL_PARTITIONS, SMALL_ROWS = 32, 50_000
#: Fits and counting passes read partitions of fewer rows together, once there are this many.
MERGE_PARTITIONS, MERGE_ROWS = 64, 2_000_000


def keep(df: DataFrame, partitions: int | None = None,
         level: StorageLevel = StorageLevel.MEMORY_AND_DISK, storage: str = "cache"):
    """Persist ``df``, fill the cache once and return ``(kept, rows)``.

    ``storage="checkpoint"`` writes the rows once to the shared checkpoint directory
    instead (``DataFrame.checkpoint``): lineage is cut, and a lost executor costs a
    re-read of those files rather than a recomputation.

    The scan keeps its partitions: nothing is merged before the rows are kept, so the
    source is read by as many tasks as it has, and a lost partition is a small one. Only
    a table of few partitions (a single row group) is spread by a round-robin
    repartition, which is deterministic on retry, as Spark sorts before it. The numbers
    follow from the rows and partitions, not from the cores that are there just now.
    ``partitions`` asks for a count.
    """
    if storage not in ("cache", "checkpoint"):
        raise ValueError(f"storage must be 'cache' or 'checkpoint', got {storage!r}")
    put = checkpointed if storage == "checkpoint" else lambda d: d.persist(level)
    kept = put(df)
    rows = kept.agg(F.count(F.lit(1))).first()[0]
    have = kept.rdd.getNumPartitions()
    want = partitions or min(SMALL_PARTITIONS, -(-rows // SMALL_ROWS))
    if have >= want and not partitions:
        return kept, rows
    if have == want:
        return kept, rows
    spread = kept.repartition(want).persist(level)
    spread.agg(F.count(F.lit(1))).first()
    kept.unpersist()
    return spread, rows


def merged(df: DataFrame, rows: int) -> DataFrame:
    """Kept rows for a pass that sends a summary of each task: small partitions are read
    together (no shuffle), so that what is sent follows the rows, not the partitions."""
    return df.coalesce(max(MERGE_PARTITIONS, -(-rows // MERGE_ROWS)))
