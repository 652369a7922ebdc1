"""CSV sources for sales files (cleaned or raw header)."""

from __future__ import annotations

import csv
from functools import reduce
from multiprocessing.pool import ThreadPool
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from lumenreg.config import RAW_TO_CLEAN, SELECTED_COLS
from lumenreg.sources.schema import SALES_SCHEMA


#: Different headers that one folder may hold, and threads that look at first lines.
MOST_HEADERS, HEADER_THREADS = 100, 16
CORRUPT = "_unparsed_line"


def bound_schema(names: list[str], path: str) -> T.StructType:
    """Declared types for a headed CSV, bound by its own column names in its own order.

    Cleaned and raw names are known, others are read as text. The seven used
    columns must be there, by either name, once.
    """
    types = {f.name: f.dataType for f in SALES_SCHEMA.fields}
    clean = [RAW_TO_CLEAN.get(n, n) for n in names]
    missing = [c for c in SELECTED_COLS if c not in clean]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}; its header is {names}")
    return T.StructType([T.StructField(n, types.get(c, T.StringType()), True)
                         for n, c in zip(names, clean)])


def file_schema(spark: SparkSession, path: str) -> T.StructType:
    """The bound schema of a file, or of a folder whose files share a header."""
    return bound_schema(spark.read.option("header", True).csv(path).columns, path)  # reads no rows


def _first_line(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    hadoop, conf = jvm.org.apache.hadoop, spark.sparkContext._jsc.hadoopConfiguration()
    place = hadoop.fs.Path(path)
    codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
    stream = place.getFileSystem(conf).open(place)
    try:
        plain = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def files_by_header(spark: SparkSession, path: str) -> dict:
    """{column names: files} of a file, folder (with all below it) or glob; empty files are left out.

    The driver lists the files, as any scan does, and reads the first line of each.
    """
    listed = spark.read.option("recursiveFileLookup", True).text(path).inputFiles()
    files = [unquote(f) for f in sorted(listed)]
    with ThreadPool(min(HEADER_THREADS, max(1, len(files)))) as pool:
        lines = pool.map(lambda f: _first_line(spark, f), files)
    groups: dict = {}
    for file, line in zip(files, lines):
        if line.strip():
            groups.setdefault(tuple(next(csv.reader([line.removeprefix("\ufeff")]))), []).append(file)
    if not groups:
        raise ValueError(f"{path} holds no file with a header")
    if len(groups) > MOST_HEADERS:
        raise ValueError(f"{path} holds {len(groups)} different headers; at most {MOST_HEADERS}")
    return groups


def read_sales_files(spark: SparkSession, path: str) -> DataFrame:
    """Sales rows, under cleaned names, of files that may have different headers.

    Files with one header (cleaned or raw names, any order, further columns) are read
    together, each group with its own bound schema, and the groups are united by name;
    a column that a group lacks is NULL there. Cells that don't parse fail the read.
    """
    parts = [normalize_header(spark.read.option("header", True).schema(bound_schema(list(names), path))
                              .option("enforceSchema", False).option("mode", "FAILFAST").csv(files))
             for names, files in files_by_header(spark, path).items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_sales_with_rejects(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows that parse, rejected rows): together they are all rows of the files.

    Rejected rows are (file, line, reason): the reason names the columns whose cells
    don't have the declared type, or says that the row has another number of cells.
    """
    kept, rejected = [], []
    for names, files in files_by_header(spark, path).items():
        schema = bound_schema(list(names), path)
        rows = (spark.read.option("header", True).option("enforceSchema", False)
                .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
                .schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])).csv(files))
        # the condition names every column: Spark parses only the cells that a query asks for
        cell = F.coalesce(*[F.col(f"`{n}`").cast("string") for n in names])
        line = F.when(cell.isNull(), F.col(CORRUPT)).otherwise(F.concat(F.col(CORRUPT), F.lit("")))
        kept.append(normalize_header(rows.where(line.isNull()).drop(CORRUPT)))
        text = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(schema) + 1)])
        cells = F.from_csv(F.col(CORRUPT), text.simpleString()[7:-1].replace(":", " "), {"mode": "PERMISSIVE"})
        wrong = [F.when(cells[f"c{i}"].isNotNull() & cells[f"c{i}"].try_cast(f.dataType).isNull(),
                        F.lit(RAW_TO_CLEAN.get(f.name, f.name)))
                 for i, f in enumerate(schema.fields) if not isinstance(f.dataType, T.StringType)]
        named = F.concat_ws(", ", *wrong)
        rejected.append(rows.where(line.isNotNull()).select(
            F.col("_metadata.file_path").alias("file"), F.col(CORRUPT).alias("line"),
            F.when(named != "", F.concat(F.lit("not of the declared type: "), named))
            .otherwise(F.lit("another number of cells")).alias("reason")))
    return (reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kept),
            reduce(DataFrame.unionByName, rejected))


def read_sales_csv(spark: SparkSession, path: str, *, infer: bool = False) -> DataFrame:
    """Read a sales CSV with a header row, cleaned or raw, columns in any order.

    By default the declared types are bound by column name, and a cell that
    doesn't parse, a row of another length or (in a folder) a file with another
    header fails the read: nothing is swapped, turned into NULL or dropped
    unnoticed. ``infer=True`` lets Spark infer types from all rows, which costs an
    extra pass. The result keeps the file's own column names; call
    :func:`normalize_header` to map raw names to the cleaned ones.
    """
    reader = spark.read.option("header", True)
    if infer:
        return reader.option("inferSchema", True).csv(path)
    return (reader.schema(file_schema(spark, path)).option("enforceSchema", False)
            .option("mode", "FAILFAST").csv(path))


def normalize_header(df: DataFrame) -> DataFrame:
    """Rename raw-header columns to the cleaned names (others are kept)."""
    present = set(df.columns)
    cols = []
    for name in df.columns:
        clean = RAW_TO_CLEAN.get(name, name)
        if clean != name and clean in present:
            # both spellings exist: keep the cleaned one only
            continue
        cols.append(F.col(f"`{name}`").alias(clean))
    return df.select(*cols)


def raw_projection_sql(view: str) -> str:
    """SQL that selects the seven used columns from a raw-header view."""
    items = []
    for raw, clean in RAW_TO_CLEAN.items():
        items.append(f"`{raw}` AS {clean}" if raw != clean else raw)
    return f"SELECT {', '.join(items)} FROM {view}"


def write_sales_csv(df: DataFrame, path: str, *, raw_header: bool = False,
                    compression: str = "none") -> None:
    """Write sales rows as a headed CSV folder (used by round-trip checks)."""
    out = df
    if raw_header:
        clean_to_raw = {v: k for k, v in RAW_TO_CLEAN.items()}
        out = df.select(*[F.col(c).alias(clean_to_raw.get(c, c)) for c in df.columns])
    out.write.mode("overwrite").option("header", True).option("compression", compression).csv(path)
