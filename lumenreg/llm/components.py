"""Connected components of a link table by alternating star contraction.

Each round joins every node's neighbours to its smallest one, first the larger
neighbours, then the smaller ones; rounds end when the links no longer change.
Rounds are written to the shared checkpoint folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenreg.session import checkpointed


def _larger_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b"), F.col("a"))).toDF("u", "v")
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return (both.join(low, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b"))
            .where("a <> b").distinct())


def _smaller_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return moved.union(low.select("m", "u")).where("a <> b").distinct()


def _state(links: DataFrame):
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                           F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node; ``links`` has long columns a, b.

    The root is the smallest node that can be reached. Rounds are told apart by
    the count and two digests of the links.
    """
    links = links.select("a", "b").where("a <> b").distinct()
    links = checkpointed(links)
    state = _state(links)
    while state[0]:
        links = checkpointed(_smaller_star(_larger_star(links)))
        new = _state(links)
        if new == state:
            break
        state = new
    return links.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        links.select("a", "a").distinct().toDF("node", "root"))
