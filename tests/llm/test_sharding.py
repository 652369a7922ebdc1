import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenreg.llm import sharding as S
from tests.llm.cases import no_documents, odd_documents, odd_rows, prose


def matrix(starts, places, seed):
    return np.array([S.matrix_row(starts, places, p, seed) for p in range(len(starts) - 1)])


def test_matrix_has_its_margins_and_law():
    counts, places = np.array([5, 0, 7, 8, 1]), np.array([9, 0, 7, 5])
    starts = np.concatenate([[0], np.cumsum(counts)])
    runs = np.array([matrix(starts, places, s) for s in range(4000)])
    assert (runs.sum(2) == counts).all() and (runs.sum(1) == places).all()
    n = counts.sum()
    mean = np.outer(counts, places) / n
    spread = mean * (1 - places / n) * ((n - counts) / (n - 1))[:, None]
    assert np.abs(runs.mean(0) - mean).max() < 0.1
    assert np.abs(runs.var(0) - spread).max() < 0.1
    assert (matrix(starts, places, 1) == matrix(starts, places, 1)).all()


def test_far_draws_follow_the_library():
    rng = np.random.default_rng(2)
    far = [S.far_hypergeometric(rng, 300, 500, 200) for _ in range(20_000)]
    near = rng.hypergeometric(300, 500, 200, 20_000)
    assert np.mean(far) == pytest.approx(near.mean(), abs=0.2)
    assert np.var(far) == pytest.approx(near.var(), rel=0.05)
    assert (S.far_hypergeometric(rng, 0, 9, 4), S.far_hypergeometric(rng, 9, 0, 4),
            S.far_hypergeometric(rng, 4, 6, 10), S.far_hypergeometric(rng, 4, 6, 0)) == (0, 4, 4, 0)
    k = S.far_hypergeometric(rng, 10 ** 10, 3 * 10 ** 10, 2 * 10 ** 10)
    assert abs(k - 5 * 10 ** 9) < 10 * np.sqrt(2e10 * 0.25 * 0.75 * 0.5)
    big = S.deal(rng, np.array([3 * 10 ** 9, 5, 2 * 10 ** 9]), 10 ** 9)
    assert big.sum() == 10 ** 9 and big[1] <= 5


def check(rows, n, shards):
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    sizes = [len(by.get(s, [])) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1 and set(by) <= set(range(shards))


@pytest.mark.parametrize("n,shards,block", [(1000, 40, 2000), (1000, 7, 10), (3, 40, 2000), (100, 1, 9), (0, 5, 2)])
def test_shards_are_exact(spark, n, shards, block):
    df = spark.range(n).withColumn("text", F.concat(F.lit("t"), F.col("id") % 3)).repartition(6)
    rows = S.shuffle(df, shards, block_rows=block).collect()
    check(rows, n, shards)
    assert sorted(r["id"] for r in rows) == list(range(n))


def test_places_are_uniform_and_repeatable(spark):
    df = spark.range(0, 2000, 1, 5)
    seen = np.zeros((2, 10))
    for seed in range(6):
        rows = S.shuffle(df, 10, seed, block_rows=50).collect()
        for r in rows:
            seen[int(r["id"] >= 1000), r["shard"]] += 1
        half = [r["slot"] for r in rows if r["id"] < 1000]
        assert abs(np.mean(half) - 99.5) < 8
    assert np.abs(seen - 600).max() < 90  # sd 17
    one = {tuple(r) for r in S.shuffle(df, 10, 3).collect()}
    assert one == {tuple(r) for r in S.shuffle(df, 10, 3).collect()}
    assert one != {tuple(r) for r in S.shuffle(df, 10, 4).collect()}


def test_places_do_not_depend_on_arrival(spark):
    """The same sets of rows in other orders within their partitions get the same places."""
    df = spark.range(0, 900, 1, 4).withColumn("p", F.spark_partition_id())
    there = {r["id"]: (r["shard"], r["slot"]) for r in S.shuffle(df, 6).collect()}
    back = {r["id"]: (r["shard"], r["slot"])
            for r in S.shuffle(df.sortWithinPartitions(F.desc("id")), 6).collect()}
    assert there == back


def test_partitions_that_change_are_noticed(spark):
    df = spark.range(0, 400, 1, 4)
    starts = np.array([0, 1, 2, 3, 4])
    assert S.matrix_row(starts, np.array([4]), 2, 1).sum() == 1
    pinned = S.shuffle(df.repartition(3), 4, pin=True).collect()
    check(pinned, 400, 4)


def test_copies_and_long_texts(spark):
    rows = [(i, "same" if i % 3 else prose(i, 20)) for i in range(300)] + [(1, "same")] * 50
    rows += [(1000, "z" * 3_000_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = S.shuffle(df, 8).select("doc_id", F.length("text").alias("n"), "shard", "slot").collect()
    check(out, len(rows), 8)
    assert sorted((r["doc_id"], r["n"]) for r in out) == sorted((i, len(t)) for i, t in rows)


def test_odd_rows_and_columns(spark):
    docs = odd_documents(spark).withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    out = S.shuffle(docs, 5).collect()
    check(out, len(odd_rows()), 5)
    assert set(out[0].asDict()) == {*docs.columns, "shard", "slot"}
    assert S.shuffle(no_documents(spark), 5).collect() == []
    with pytest.raises(ValueError, match="slot"):
        S.shuffle(docs.withColumn("Slot", F.lit(1)), 5)


def test_shard_files(spark, tmp_path):
    S.write_shards(spark.range(100).toDF("id"), str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    check(back.collect(), 100, 4)
