import math

import pytest
from pyspark.sql import functions as F

from lumenreg.config import FEATURE_COLS
from lumenreg.operators.prepare import drop_incomplete, prepare_features
from lumenreg.operators.split import (hash_split, random_split, rename_label, with_folds,
                                      with_holdout, with_key_hash)
from lumenreg.sources.fixture import tpch_sales
from tests.conftest import SF_SMALL


def _rows(spark):
    return spark.createDataFrame(
        [(6, 750, 4.5, 6.75, 12, 81.0, 9.0),
         (None, 750, 4.5, 6.75, 12, 81.0, 9.0),
         (6, 750, None, 6.75, 12, 81.0, 9.0),
         (6, 750, float("nan"), 6.75, 12, 81.0, 9.0),
         (6, 750, 4.5, 6.75, 12, None, 9.0)],
        "Pack int, BottleVolumeInMl int, StateBottleCost double, StateBottleRetail double, "
        "BottlesSold int, SaleInDollars double, VolumeSoldInLitres double")


def test_null_rows_dropped_nan_kept(spark):
    out = prepare_features(_rows(spark)).collect()
    assert len(out) == 2
    assert any(math.isnan(r["StateBottleCost"]) for r in out)
    assert out[0].asDict().keys() == set(FEATURE_COLS) | {"label"}
    assert dict(prepare_features(_rows(spark)).dtypes) == {c: "double" for c in FEATURE_COLS + ["label"]}


def test_nan_fails_assembler(spark):
    from lumenreg.operators.models import assembler

    with pytest.raises(Exception):
        assembler().transform(prepare_features(_rows(spark))).collect()


def test_filters_pushed_and_columns_pruned(spark):
    df = prepare_features(tpch_sales(spark, SF_SMALL))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_discount)" in plan or "IsNotNull" in plan
    assert "l_extendedprice" not in plan.split("ReadSchema")[1]
    assert "l_shipdate" not in plan


def test_hash_split_is_exact_partition(spark):
    f = prepare_features(tpch_sales(spark, SF_SMALL), extra=["h"])
    train, test = hash_split(f)
    n, a, b = f.count(), train.count(), test.count()
    assert a + b == n and 0.6 < a / n < 0.8
    assert train.join(test, "h", "inner").count() == 0
    # repeatable: same rows on a second evaluation
    assert sorted(r.h for r in hash_split(f)[1].select("h").collect()) == \
        sorted(r.h for r in test.select("h").collect())
    assert "trueLabel" in rename_label(test).columns and "label" not in rename_label(test).columns


def test_folds_and_holdout(spark):
    f = prepare_features(tpch_sales(spark, SF_SMALL), extra=["h"])
    sizes = [r["count"] for r in with_folds(f, 5).groupBy("fold").count().collect()]
    assert len(sizes) == 5 and sum(sizes) == f.count() and min(sizes) > 0.15 * f.count()
    share = with_holdout(f, 0.8).agg(F.avg(F.col("is_validation").cast("double"))).first()[0]
    assert 0.15 < share < 0.25
    with pytest.raises(ValueError):
        with_folds(f, 1)
    for bad in (0.0, 1.0, 1.5, 0.12345):
        with pytest.raises(ValueError):
            hash_split(f, bad)
    with pytest.raises(ValueError):
        with_holdout(f, 0.80005)


@pytest.mark.parametrize("fraction", [0.75, 0.04, 0.0301])
def test_any_fraction_is_honoured(spark, fraction):
    ids = spark.range(60_000).select(F.pmod(F.xxhash64("id"), F.lit(1 << 32)).alias("h"))
    train, test = hash_split(ids, fraction)
    share = train.count() / 60_000
    assert abs(share - fraction) < 0.01 and train.count() + test.count() == 60_000
    # the part is independent of folds and of the validation cut
    folds = [r["count"] for r in with_folds(train, 5).groupBy("fold").count().collect()]
    assert len(folds) == 5 and max(folds) < 1.5 * min(folds) + 60
    held = with_holdout(train, 0.8).filter("is_validation").count()
    assert abs(held / train.count() - 0.2) < 0.05


def test_null_keys_are_marked_and_spread(spark):
    rows = spark.createDataFrame([("a", None, 1), (None, "a", 2)]
                                 + [(None, None, i) for i in range(3000)],
                                 "k1 string, k2 string, v int")
    for method in ("md5", "xxhash64"):
        hashed = with_key_hash(rows, ["k1", "k2"], method=method)
        first = hashed.filter("k1 is not null or k2 is not null").select("h").distinct()
        assert first.count() == 2
        sizes = [r["count"] for r in with_folds(hashed.filter("k1 is null and k2 is null"), 5)
                 .groupBy("fold").count().collect()]
        assert len(sizes) == 5 and min(sizes) > 450


def test_random_split_seeded(spark):
    f = prepare_features(tpch_sales(spark, SF_SMALL), extra=["h"])
    a1, b1 = random_split(f, (0.7, 0.3), seed=7)
    a2, _ = random_split(f, (0.7, 0.3), seed=7)
    assert a1.count() + b1.count() == f.count()
    assert sorted(r.h for r in a1.select("h").collect()) == sorted(r.h for r in a2.select("h").collect())
    assert drop_incomplete(f).count() == f.count()


def test_random_parts_survive_loss_and_new_partitions(spark):
    """Parts computed at different times, from other partitions and another order of rows, and
    after their cache is gone, still hold every row once."""
    f = prepare_features(tpch_sales(spark, SF_SMALL), extra=["h"]).cache()
    everything = f.count()
    train, _ = random_split(f, (0.7, 0.3), seed=5)
    kept = {tuple(r) for r in train.collect()}
    f.unpersist()
    _, test = random_split(f.repartition(37).sortWithinPartitions(F.desc("h")), (0.7, 0.3), seed=5)
    rest = {tuple(r) for r in test.collect()}
    assert not kept & rest and len(kept) + len(rest) == everything
    assert 0.66 < len(kept) / everything < 0.74
    other = {tuple(r) for r in random_split(f, (0.7, 0.3), seed=6)[0].collect()}
    assert len(kept & other) < 0.6 * everything  # another seed draws anew


def test_xxhash_key_hash_is_a_32bit_deterministic_split(spark):
    from lumenreg.functions.keys import row_hash

    f = tpch_sales(spark, SF_SMALL, hash_method="xxhash64")
    lo, hi = f.agg(F.min("h"), F.max("h")).first()
    assert 0 <= lo and hi < 2 ** 32
    train, test = hash_split(prepare_features(f, extra=["h"]))
    a, b = train.count(), test.count()
    assert a + b == f.count() and 0.6 < a / (a + b) < 0.8
    assert f.select(F.sum("h")).first()[0] == tpch_sales(
        spark, SF_SMALL, hash_method="xxhash64").select(F.sum("h")).first()[0]
    with pytest.raises(ValueError):
        row_hash("l_orderkey", method="crc")
