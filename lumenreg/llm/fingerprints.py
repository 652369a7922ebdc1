"""Document fingerprints: quartile bucket digests of hashed byte triplets.

Every window of five bytes gives six triplets that start at its first byte;
each triplet is hashed to one of 256 buckets by XOR of byte tables. A bucket's
code is the quartile of its count among all buckets (0 to 3). The digest holds
a length byte (logarithmic), the two quartile ratios and the codes, as hex.

The difference of two digests adds, over the buckets, 1 to 6 for differing
codes, and bounded shares for length and ratios; likeness is 1 less the
difference over its maximum, so it lies from 0 to 1.

Null texts are empty. Texts under five bytes have no triplet: all codes are 0
and the length byte tells them apart only by length.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from lumenreg.llm.batches import map_arrow, with_text_columns

BUCKETS = 256
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 1, 4), (0, 2, 3), (0, 2, 4), (0, 3, 4))
#: One byte permutation for each triplet kind and place.
TABLES = np.random.default_rng(20240131).permuted(
    np.tile(np.arange(256, dtype=np.uint8), (len(TRIPLETS), 3, 1)), axis=2)
#: Cost of two codes by their distance; a jump of three quartiles counts double.
CODE_COST = np.array([0, 1, 2, 6])
LENGTH_COST, RATIO_COST = 64, 16
CHUNK = 1 << 20


def digest(raw: bytes) -> bytes:
    """Length byte, ratio byte and 64 code bytes of a text."""
    counts = np.zeros(BUCKETS, np.int64)
    data = np.frombuffer(raw, np.uint8)
    for start in range(0, max(0, len(data) - 4), CHUNK):
        part = data[start:start + CHUNK + 4]
        n = len(part) - 4
        for kind, places in enumerate(TRIPLETS):
            a, b, c = (TABLES[kind, k][part[p:p + n]] for k, p in enumerate(places))
            counts += np.bincount(a ^ b ^ c, minlength=BUCKETS)
    ordered = np.sort(counts)
    q1, q2, q3 = (int(ordered[BUCKETS * k // 4 - 1]) for k in (1, 2, 3))
    codes = ((counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)).reshape(-1, 4)
    packed = (codes << np.array([6, 4, 2, 0], np.uint8)).sum(axis=1).astype(np.uint8)
    length = min(255, round(12 * float(np.log1p(len(raw)))))
    ratio = lambda q: (15 * q) // q3 if q3 else 0
    return bytes([length, ratio(q1) << 4 | ratio(q2)]) + packed.tobytes()


def _codes(fingerprint: bytes) -> np.ndarray:
    packed = np.frombuffer(fingerprint, np.uint8)[2:]
    return np.stack([packed >> s & 3 for s in (6, 4, 2, 0)], axis=1).ravel().astype(np.int16)


def likeness(a: bytes, b: bytes) -> float:
    """1 less the bounded difference of two digests; 1.0 for equal ones."""
    cost = int(CODE_COST[np.abs(_codes(a) - _codes(b))].sum())
    cost += min(LENGTH_COST, 4 * abs(a[0] - b[0]))
    cost += min(RATIO_COST, 2 * (abs((a[1] >> 4) - (b[1] >> 4)) + abs((a[1] & 15) - (b[1] & 15))))
    return 1.0 - cost / (BUCKETS * int(CODE_COST[-1]) + LENGTH_COST + RATIO_COST)


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars (code points) and fingerprint of every text."""
    def make():
        return lambda texts: [[len((t or b"").decode()) for t in texts],
                              [digest(t or b"").hex() for t in texts]]

    return with_text_columns(docs, [id_col], text_col, make,
                             [StructField("n_chars", LongType()),
                              StructField("fingerprint", StringType())])


def _ordered_ranges(rows: DataFrame, parts: int) -> DataFrame:
    """``rows`` (doc_id, text) dealt to ranges of falling doc_id, each with the row after it.

    Cut points are approximate quantiles of the ids alone; the highest row of
    each range also goes, marked as ``tail``, to the range before it, and the
    highest of all to the last. So each text is shuffled once, but for one in
    a range. Equal ids are ordered by text, null ids come last.
    """
    ids = rows.select(F.col("doc_id").cast("double").alias("v"))
    shares = [i / parts for i in range(1, parts)]
    cuts = sorted(set(ids.agg(F.percentile_approx("v", shares, 20 * parts).alias("c"))
                      .first()["c"] or []))
    spark = rows.sparkSession
    bounds = F.array(*[F.lit(float(c)) for c in cuts]) if cuts else F.array().cast("array<double>")
    n = len(cuts) + 1
    # range 0 holds the highest ids, range n the null ids
    bucket = F.when(F.col("doc_id").isNull(), F.lit(n)).otherwise(
        F.lit(n - 1) - F.size(F.filter(bounds, lambda c: c < F.col("doc_id").cast("double"))))
    dealt = rows.withColumn("range", bucket)
    # the first row of a range: its highest id, then its smallest text
    tops = {r["range"]: r["top"] for r in
            dealt.groupBy("range").agg(F.max("doc_id").alias("top")).collect()}
    filled = sorted(tops)
    before = {b: filled[i - 1] for i, b in enumerate(filled)}
    lead = spark.createDataFrame([(b, tops[b], before[b]) for b in filled] or None,
                                 "range int, top long, goes_to int") if filled else None
    own = dealt.withColumn("tail", F.lit(False))
    if lead is None:
        return own
    # one row for each range, at most ``parts`` + 1 of them
    firsts = (dealt.join(F.broadcast(lead), "range")
              .where(F.col("doc_id").eqNullSafe(F.col("top")))
              .groupBy("goes_to").agg(F.min(F.struct(F.col("text").isNotNull().alias("some"),
                                                     "text", "doc_id")).alias("r"))
              .select(F.col("r.doc_id").alias("doc_id"), F.col("r.text").alias("text"),
                      F.col("goes_to").alias("range"), F.lit(True).alias("tail")))
    return own.unionByName(firsts)


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    parts: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    Edited: the last half (floor) of a text's code points replaced by the first
    as many of the next document's, in falling id; the first follows the last.
    Rows of equal id follow each other by text (null first), each counting as
    a document; a single row follows itself. Ids are integers.
    """
    spark = docs.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    dealt = _ordered_ranges(rows, parts)
    schema = StructType([rows.schema["doc_id"], StructField("n_chars", LongType()),
                         *[StructField(c, StringType()) for c in
                           ("edited_sha256", "fingerprint", "edited_fingerprint")],
                         *[StructField(c, DoubleType()) for c in ("near_edited", "near_next")]])
    arrow = to_arrow_schema(schema)

    def compare(row, after):
        (doc_id, text, mark), (_, next_text, next_mark) = row, after
        half = len(text) // 2
        edited = (text[:len(text) - half] + next_text[:half]).encode()
        edited_mark = digest(edited)
        return (doc_id, len(text), hashlib.sha256(edited).hexdigest(), mark.hex(),
                edited_mark.hex(), likeness(mark, edited_mark), likeness(mark, next_mark))

    def run(batches):
        last, at = None, None
        for batch in batches:
            out = []
            for doc_id, text, part, tail in zip(*(c.to_pylist() for c in batch.columns)):
                row = (doc_id, text or "", digest((text or "").encode()))
                if last is not None and part == at:
                    out.append(compare(last, row))
                last, at = (None, None) if tail else (row, part)
                if len(out) >= 500:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    ordered = (dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "range")
               .sortWithinPartitions("range", "tail", F.col("doc_id").desc_nulls_last(),
                                     F.col("text").asc_nulls_first()))
    return map_arrow(ordered, run, schema)
