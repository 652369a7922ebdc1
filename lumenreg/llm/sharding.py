"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

The places 0 .. n-1 of the shuffled table are cut into shards whose sizes differ by one
at most, and shards into blocks of a bounded number of rows. How many rows of input
partition p go to block b is entry (p, b) of a matrix with the partitions' row counts and
the blocks' sizes as its margins, drawn from the hypergeometric law that a uniform
shuffle has. No one holds the matrix: every task draws its own row, down a binary tree
over the partitions, whose nodes all tasks draw alike from the seed and the node. Then:

1. permute locally: a partition's rows in the order of a keyed hash of their content;
2. exchange: the first rows go to the first block that gets some, and so on;
3. permute again: a block's rows in the order of a second keyed hash; a row's place in
   its shard (``slot``) follows from the block's first place and its rank.

Orders depend on content, never on arrival, so a task that is run again gives the same
rows the same places. Partition p must hold the same set of rows whenever the input is
computed, as in file scans; ``pin=True`` writes the input to the checkpoint folder first.
Row counts that changed in between fail the job where rows exceed the matrix.

Null and empty texts, null and repeated ids are rows like others; rows equal in all
columns are dealt as separate rows. Columns of a map type are left out of the hashes.
An empty table gives no rows. With fewer rows than shards, the last shards stay empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from lumenreg.llm.batches import ship
from lumenreg.session import checkpointed

SHARDS, SEED = 40, 13
#: Rows of a block, unless that would make more blocks than MOST_BLOCKS (a task's row of the matrix).
BLOCK_ROWS, MOST_BLOCKS = 2_000, 100_000
#: numpy draws exactly below this population.
LIBRARY_LIMIT = 1_000_000_000
RANK_BITS = 33  # of monotonically_increasing_id


def far_hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """One hypergeometric number of a large population, by inversion around the mean.

    The window of 40 standard deviations leaves out less than the law's rounding.
    """
    total = good + bad
    low, high = max(0, draws - bad), min(draws, good)
    mean = draws * (good / total)
    sd = np.sqrt(mean * (bad / total) * ((total - draws) / max(total - 1, 1)))
    low, high = max(low, int(mean - 40 * sd - 40)), min(high, int(mean + 40 * sd + 40))
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log((good - k) * (draws - k)) - np.log((k + 1) * (bad - draws + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def hypergeometric(rng: np.random.Generator, good: np.ndarray, bad: np.ndarray,
                   draws: np.ndarray) -> np.ndarray:
    """Good ones among ``draws`` of ``good + bad``, elementwise."""
    far = (good >= LIBRARY_LIMIT) | (bad >= LIBRARY_LIMIT)
    out = rng.hypergeometric(np.where(far, 0, good), np.where(far, 0, bad), np.where(far, 0, draws))
    for i in np.flatnonzero(far):
        out[i] = far_hypergeometric(rng, int(good[i]), int(bad[i]), int(draws[i]))
    return out


def deal(rng: np.random.Generator, places: np.ndarray, draws: int) -> np.ndarray:
    """Multivariate hypergeometric: how many of ``draws`` fall on each kind of place.

    By halves: how many fall on the left half of the kinds, and so on within both.
    """
    size = 1 << max(0, len(places) - 1).bit_length()
    levels = [np.concatenate([places, np.zeros(size - len(places), np.int64)])]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].reshape(-1, 2).sum(1))
    take = np.array([draws], np.int64)
    for level in levels[-2::-1]:
        pairs = level.reshape(-1, 2)
        left = hypergeometric(rng, pairs[:, 0], pairs[:, 1], take)
        take = np.stack([left, take - left], 1).reshape(-1)
    return take[:len(places)]


def matrix_row(starts: np.ndarray, places: np.ndarray, part: int, seed: int) -> np.ndarray:
    """Row ``part`` of the communication matrix.

    ``starts`` are the partitions' first row numbers (and the total), ``places`` the
    blocks' sizes. Each node of the tree is drawn from its own seed, alike in all tasks.
    """
    low, high, left = 0, len(starts) - 1, places
    while high - low > 1:
        middle = (low + high) // 2
        rng = np.random.Generator(np.random.Philox(key=[seed, (low << 32) + high]))
        take = deal(rng, left, int(starts[middle] - starts[low]))
        if part < middle:
            high, left = middle, take
        else:
            low, left = middle, left - take
    return left


def block_plan(n: int, shards: int, block_rows: int = BLOCK_ROWS) -> tuple[int, np.ndarray]:
    """(blocks in a shard, first place of every block within its shard and shard sizes)."""
    rows = max(block_rows, -(-n // MOST_BLOCKS))
    each = max(1, -(-n // (shards * rows)))
    sizes = n // shards + (np.arange(shards) < n % shards)
    edges = sizes[:, None] * np.arange(each + 1) // each
    return each, edges


def content_key(df: DataFrame, seed: int, salt: str) -> list[Column]:
    """Two 64-bit hashes of a row's columns: an order that depends on nothing else."""
    columns = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, MapType)]
    return [F.xxhash64(F.lit(f"{salt} {seed} {i}"), *columns) for i in (0, 1)]


def shuffle(df: DataFrame, shards: int = SHARDS, seed: int = SEED, pin: bool = False,
            block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` and ``slot`` (gapless from 0 in a shard)."""
    if shards < 1:
        raise ValueError(f"need at least one shard, got {shards}")
    clash = {"shard", "slot"} & {c.lower() for c in df.columns}
    if clash:
        raise ValueError(f"rename the column(s) {', '.join(sorted(clash))} first")
    spark = df.sparkSession
    ship(spark)
    df = checkpointed(df) if pin else df
    counted = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    counts = {r["p"]: r["n"] for r in counted.collect()}  # a number for each partition
    starts = np.zeros(max(counts, default=-1) + 2, np.int64)
    np.cumsum([counts.get(p, 0) for p in range(len(starts) - 1)], out=starts[1:])
    each, edges = block_plan(int(starts[-1]), shards, block_rows)
    shared = spark.sparkContext.broadcast((starts, np.diff(edges, axis=1).reshape(-1)))

    @F.pandas_udf("int")
    def block_of(ids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        part, ends = None, None
        for batch in ids:
            at = batch.to_numpy(np.int64)
            if len(at) and part != at[0] >> RANK_BITS:
                part = int(at[0] >> RANK_BITS)
                first, places = shared.value
                if part >= len(first) - 1:
                    raise RuntimeError("the input's partitions changed between two reads; pass pin=True")
                ends = np.cumsum(matrix_row(first, places, part, seed))
            rank = at & ((1 << RANK_BITS) - 1)
            if len(at) and rank.max() >= ends[-1]:
                raise RuntimeError("the input's partitions changed between two reads; pass pin=True")
            yield pd.Series(np.searchsorted(ends, rank, side="right") if len(at) else at, dtype="int32")

    names = [F.col(f"`{c}`") for c in df.columns]
    taken = set(df.columns)
    block, order = (next(f"{c}{i}" for i in range(len(taken) + 1) if f"{c}{i}" not in taken)
                    for c in ("_block", "_order"))
    local = df.sortWithinPartitions(*content_key(df, seed, "local"))
    dealt = local.withColumn(order, F.monotonically_increasing_id()).select(
        *names, block_of(order).alias(block))
    rank = F.row_number().over(Window.partitionBy(block).orderBy(*content_key(df, seed, "again"))) - 1
    whole = lambda a, b: F.call_function("div", a, b)
    shard = whole(F.col(block), F.lit(each)).cast("int")
    # first place of a block in its shard, as in block_plan
    n = int(starts[-1])
    size = F.lit(n // shards).cast("long") + F.when(shard < n % shards, 1).otherwise(0)
    first = whole(size * (F.col(block) % F.lit(each)), F.lit(each))
    return dealt.withColumn(order, rank).select(
        *names, shard.alias("shard"), (first + F.col(order)).cast("long").alias("slot"))


def write_shards(df: DataFrame, path: str, **options) -> None:
    """The shuffled rows as Parquet files in a folder for each shard."""
    shuffle(df, **options).write.partitionBy("shard").parquet(path)
