"""Sales-shaped rows derived from the TPC-H-like driver tables.

``lineitem`` joined to ``part`` on the part key gives one sales row per line:

* Pack               = p_size (as double)
* BottleVolumeInMl   = l_linenumber (as double)
* StateBottleCost    = p_retailprice
* StateBottleRetail  = p_retailprice * (1 + l_tax)
* BottlesSold        = l_quantity
* VolumeSoldInLitres = l_quantity * (1 - l_discount)
* SaleInDollars      = l_quantity * StateBottleRetail
* h                  = row hash of (l_orderkey, l_linenumber, l_partkey, l_suppkey)

The join is left to the planner: AQE turns it into a broadcast join only when
the measured ``part`` side is under the broadcast threshold, and splits
skewed part keys otherwise. No hint forces a broadcast of a side that grows
with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenreg.functions.keys import row_hash

KEY_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tpch_sales(spark: SparkSession, sf_dir: str, *, with_hash: bool = True,
               typed: bool = False, hash_method: str = "md5") -> DataFrame:
    """Sales rows in the cleaned header layout (plus key hash ``h``).

    ``typed=False`` gives the columns as doubles (feature layout);
    ``typed=True`` keeps the declared integer types of Pack, BottleVolumeInMl
    and BottlesSold, like a file read with the declared schema.
    """
    li = read_table(spark, sf_dir, "lineitem")
    pa = read_table(spark, sf_dir, "part")
    j = li.join(pa, li.l_partkey == pa.p_partkey, "inner")
    retail = F.col("p_retailprice") * (1 + F.col("l_tax"))
    int_t = "int" if typed else "double"
    cols = [
        F.col("p_size").cast(int_t).alias("Pack"),
        F.col("l_linenumber").cast(int_t).alias("BottleVolumeInMl"),
        F.col("p_retailprice").alias("StateBottleCost"),
        retail.alias("StateBottleRetail"),
        F.col("l_quantity").cast(int_t).alias("BottlesSold") if typed
        else F.col("l_quantity").alias("BottlesSold"),
        (F.col("l_quantity") * retail).alias("SaleInDollars"),
        (F.col("l_quantity") * (1 - F.col("l_discount"))).alias("VolumeSoldInLitres"),
    ]
    if with_hash:
        cols.append(row_hash(*KEY_COLS, method=hash_method).alias("h"))
    return j.select(*cols)
