"""Declared schema of the cleaned sales table.

All fields are nullable: incomplete rows are dropped explicitly later, so the
schema must not claim otherwise. Column 18 is spelt ``BottleVolumeInMl``
(the name every query uses).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: cleaned sales header, in file order ----------------------
_SALES_FIELDS = [
    ("Invoice/Item Number", T.StringType()),
    ("Date", T.StringType()),
    ("StoreNumber", T.IntegerType()),
    ("StoreName", T.StringType()),
    ("Address", T.StringType()),
    ("City", T.StringType()),
    ("ZipCode", T.IntegerType()),
    ("StoreLocation", T.StringType()),
    ("CountyNumber", T.IntegerType()),
    ("County", T.StringType()),
    ("Category", T.IntegerType()),
    ("CategoryName", T.StringType()),
    ("VendorNumber", T.IntegerType()),
    ("VendorName", T.StringType()),
    ("ItemNumber", T.IntegerType()),
    ("ItemDescription", T.StringType()),
    ("Pack", T.IntegerType()),
    ("BottleVolumeInMl", T.IntegerType()),
    ("StateBottleCost", T.DoubleType()),
    ("StateBottleRetail", T.DoubleType()),
    ("BottlesSold", T.IntegerType()),
    ("SaleInDollars", T.DoubleType()),
    ("VolumeSoldInLitres", T.DoubleType()),
    ("VolumeSoldInGallons", T.DoubleType()),
]

SALES_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in _SALES_FIELDS])


def sales_schema(raw_header: bool = False) -> T.StructType:
    """The declared schema; with ``raw_header`` the used columns carry raw names."""
    if not raw_header:
        return SALES_SCHEMA
    from lumenreg.config import RAW_TO_CLEAN

    clean_to_raw = {v: k for k, v in RAW_TO_CLEAN.items()}
    return T.StructType([
        T.StructField(clean_to_raw.get(f.name, f.name), f.dataType, True)
        for f in SALES_SCHEMA.fields
    ])

