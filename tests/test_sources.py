import math

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

from lumenreg.sources.catalog import load_sales, read_sales_table, register_view
from lumenreg.sources.csv import (normalize_header, raw_projection_sql, read_sales_csv,
                                  read_sales_with_rejects)
from lumenreg.sources.fixture import tpch_sales
from lumenreg.sources.schema import SALES_SCHEMA, sales_schema
from tests.conftest import SF_SMALL

RAW_HEADER = "Pack,Bottle Volume (ml),State Bottle Cost,State Bottle Retail,Bottles Sold,Sale (Dollars),Volume Sold (Liters),Date"


def _write(path, lines):
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_declared_schema_is_nullable_and_spelt_right():
    names = [f.name for f in SALES_SCHEMA.fields]
    assert len(names) == 24
    assert "BottleVolumeInMl" in names and "BottleVolumeInMl)" not in names
    assert all(f.nullable for f in SALES_SCHEMA.fields)
    raw = [f.name for f in sales_schema(raw_header=True).fields]
    assert "Bottle Volume (ml)" in raw and "Sale (Dollars)" in raw


def test_awkward_cells_inferred(spark, tmpdir_path):
    path = f"{tmpdir_path}/awkward.csv"
    _write(path, [
        RAW_HEADER,
        "6,750,4.50,6.75,12,81.00,9.0,11/30/2014",
        ",750,4.50,6.75,12,81.00,9.0,11/30/2014",
        '6,"",4.50,6.75,12,81.00,9.0,11/30/2014',
        "6,750,NaN,6.75,12,81.00,9.0,11/30/2014",
        "6,750,4.50,6.75,12,1e3,9.0,11/30/2014",
    ])
    df = normalize_header(read_sales_csv(spark, path, infer=True))
    types = dict(df.dtypes)
    assert types["Pack"] == "int" and types["StateBottleCost"] == "double"
    assert types["Date"] == "string"  # slash dates stay text
    rows = df.collect()
    assert rows[1]["Pack"] is None            # empty cell -> NULL
    assert rows[2]["BottleVolumeInMl"] is None  # "" -> NULL
    assert math.isnan(rows[3]["StateBottleCost"])
    assert rows[4]["SaleInDollars"] == 1000.0


def test_currency_column_infers_as_string_and_is_rejected(spark, tmpdir_path):
    from lumenreg.operators.prepare import prepare_features

    path = f"{tmpdir_path}/money.csv"
    _write(path, [RAW_HEADER, "6,750,$4.50,6.75,12,81.00,9.0,2014-11-30"])
    df = normalize_header(read_sales_csv(spark, path, infer=True))
    assert dict(df.dtypes)["StateBottleCost"] == "string"
    assert dict(df.dtypes)["Date"] == "date"  # ISO dates infer as date
    with pytest.raises(TypeError, match="StateBottleCost"):
        prepare_features(df)


def test_raw_header_sql_projection(spark, tmpdir_path):
    path = f"{tmpdir_path}/raw.csv"
    _write(path, [RAW_HEADER, "6,750,4.5,6.75,12,81.0,9.0,11/30/2014"])
    register_view(read_sales_csv(spark, path, infer=True), "temp_raw_test")
    out = spark.sql(raw_projection_sql("temp_raw_test")).collect()[0].asDict()
    assert out == {"Pack": 6, "BottleVolumeInMl": 750, "StateBottleCost": 4.5,
                   "StateBottleRetail": 6.75, "BottlesSold": 12, "SaleInDollars": 81.0,
                   "VolumeSoldInLitres": 9.0}


def test_load_sales_switch(spark, tmpdir_path):
    rows = tpch_sales(spark, SF_SMALL, with_hash=False, typed=True)
    register_view(rows, "sales_switch_test")
    want = sorted(map(tuple, rows.collect()))
    a = load_sales(spark, table="sales_switch_test")
    assert sorted(map(tuple, a.collect())) == want
    path = f"{tmpdir_path}/sales_csv"
    rows.write.option("header", True).csv(path)
    b = load_sales(spark, path=path)  # declared types by name: these seven columns are enough
    assert b.schema["Pack"].dataType == T.IntegerType()
    assert sorted(map(tuple, b.collect())) == want
    with pytest.raises(ValueError):
        load_sales(spark)
    with pytest.raises(ValueError):
        load_sales(spark, path=path, table="x")
    assert read_sales_table(spark, "sales_switch_test").columns == rows.columns


GOOD = "6,750,4.50,6.75,12,81.00,9.0,11/30/2014"


def test_columns_are_bound_by_name(spark, tmpdir_path):
    path = f"{tmpdir_path}/exchanged.csv"
    _write(path, ["State Bottle Retail,State Bottle Cost,Pack,Bottle Volume (ml),Bottles Sold,"
                  "Sale (Dollars),Volume Sold (Liters),Note", "6.75,4.5,6,750,12,81.0,9.0,x"])
    row = load_sales(spark, path=path).first()
    assert (row["StateBottleCost"], row["StateBottleRetail"], row["Note"]) == (4.5, 6.75, "x")


def test_missing_column_is_an_error(spark, tmpdir_path):
    path = f"{tmpdir_path}/short.csv"
    _write(path, ["Pack,Date", "6,x"])
    with pytest.raises(ValueError, match="lacks columns.*SaleInDollars"):
        load_sales(spark, path=path)


@pytest.mark.parametrize("bad", ["6,750,$4.50,6.75,12,81.00,9.0,x", "6.5,750,4.5,6.75,12,81,9,x"])
def test_cells_that_do_not_parse_fail_the_read(spark, tmpdir_path, bad):
    from lumenreg.operators.prepare import prepare_features

    path = f"{tmpdir_path}/bad.csv"
    _write(path, [RAW_HEADER, GOOD, bad])
    with pytest.raises(Exception, match="MALFORMED|BadRecord|malformed"):
        prepare_features(load_sales(spark, path=path)).collect()


def test_files_of_different_headers_are_read_by_name(spark, tmpdir_path):
    import gzip
    import os

    top = f"{tmpdir_path}/two"
    os.makedirs(f"{top}/below it")
    _write(f"{top}/a.csv", [RAW_HEADER, GOOD])
    names = RAW_HEADER.split(",")
    names[2], names[3] = names[3], names[2]
    _write(f"{top}/b.csv", ["\ufeff" + ",".join(names) + ",Note", GOOD + ",n"])
    clean = ["Pack", "BottleVolumeInMl", "StateBottleCost", "StateBottleRetail", "BottlesSold",
             "SaleInDollars", "VolumeSoldInLitres"]
    with gzip.open(f"{top}/below it/c d.csv.gz", "wt") as fh:
        fh.write(",".join(reversed(clean)) + "\n9.0,81.0,12,6.75,4.5,750,6\n")
    open(f"{top}/empty.csv", "w").close()
    rows = load_sales(spark, path=top).select(*clean, "Date", "Note").collect()
    assert sorted(map(str, rows)) == sorted(map(str, [
        Row(**dict(zip([*clean, "Date", "Note"], v))) for v in (
            (6, 750, 4.5, 6.75, 12, 81.0, 9.0, "11/30/2014", None),
            (6, 750, 6.75, 4.5, 12, 81.0, 9.0, "11/30/2014", "n"),
            (6, 750, 4.5, 6.75, 12, 81.0, 9.0, None, None))]))
    with pytest.raises(Exception, match="header|Header"):  # one reader, one header
        read_sales_csv(spark, top + "/*.csv").collect()
    with pytest.raises(ValueError, match="no file with a header"):
        load_sales(spark, path=f"{top}/empty.csv")
    _write(f"{top}/short.csv", ["Pack,Date", "6,x"])
    with pytest.raises(ValueError, match="lacks columns"):
        load_sales(spark, path=top)


def test_rejected_rows_are_a_result(spark, tmpdir_path):
    path = f"{tmpdir_path}/mixed.csv"
    _write(path, [RAW_HEADER, GOOD, "6,750,$4.50,6.75,12,81.00,9.0,x", "6.5,750,4.5,6.75,many,81,9,x",
                  "6,750,4.5", GOOD + ",extra,more", ",750,NaN,6.75,12,81.00,9.0,x"])
    kept, rejected = read_sales_with_rejects(spark, path)
    assert kept.count() == 2 and kept.filter("Pack is null").count() == 1
    assert kept.select("Date").count() == 2 and rejected.count() == 4  # whatever is selected
    found = {r["line"][:12]: r["reason"] for r in rejected.collect()}
    assert found == {"6,750,$4.50,": "not of the declared type: StateBottleCost",
                     "6.5,750,4.5,": "not of the declared type: Pack, BottlesSold",
                     "6,750,4.5": "another number of cells", GOOD[:12]: "another number of cells"}
    assert {r["file"].endswith("mixed.csv") for r in rejected.select("file").collect()} == {True}


def test_empty_cells_are_null_and_nan_is_kept(spark, tmpdir_path):
    path = f"{tmpdir_path}/holes.csv"
    _write(path, [RAW_HEADER, GOOD, ",750,NaN,6.75,12,81.00,9.0,x"])
    row = load_sales(spark, path=path).filter("Pack is null").first()
    assert math.isnan(row["StateBottleCost"]) and row["BottlesSold"] == 12
