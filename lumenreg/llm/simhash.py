"""SimHash near-duplicates with Golay-code fuzzy keys.

A text's fingerprint is the bitwise majority of its word shingles' XXH64. To
find fingerprints within two bits, the 64 bits are cut into three segments.
Two errors leave some segment free of errors whose successor (in a ring) has
at most one: by cases (2,0,0), (1,1,0), (1,0,0) and their turns. So a key is a
segment's own bits with a Golay (23,12) codeword index of the next segment.
A fingerprint is stored under the codeword nearest to that segment, and looks
under those nearest to it and to each of its one-bit neighbours (one or six
of them), which include the other's. Candidates are verified by bit count.

Equal fingerprints are one node with its smallest doc_id, so copies never
multiply. A key under which more than ``HOT_KEY`` fingerprints are stored is
not expanded into pairs: two fingerprints within two bits share a midpoint
within one bit of both, so the members' 65 midpoints are grouped instead and
each group is linked to its smallest member. This loses no link and grows with
the number of members.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from lumenreg.llm.batches import map_arrow, with_text_columns
from lumenreg.llm.components import components
from lumenreg.session import checkpointed

SEED = 42
HOT_KEY = 64
#: (low bit, width) of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, a generator of the (23,12) Golay code.
GENERATOR = 0xC75
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(raw: bytes | None, shingle: int = 3) -> int:
    """64-bit SimHash of a text's word shingles (as an unsigned integer)."""
    words = (raw or b"").translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= shingle:
        joined = [b" ".join(words)]
    else:
        joined = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in joined], np.uint64)
    # sums of the 64 bit columns, eight at a time in the bytes of a word
    counts = np.zeros(64, np.int64)
    ones = np.uint64(0x0101010101010101)
    for start in range(0, len(hashes), 255):
        part = hashes[start:start + 255]
        for shift in range(8):
            lanes = ((part >> np.uint64(shift)) & ones).sum(dtype=np.uint64)
            counts[shift::8] += np.frombuffer(np.array([lanes], "<u8").tobytes(), np.uint8)
    bits = counts * 2 > len(hashes)
    return int((bits.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


def _remainders() -> np.ndarray:
    """Syndromes of all 23-bit words."""
    single = []
    for bit in range(23):
        word = 1 << bit
        for high in range(22, 10, -1):
            if word >> high & 1:
                word ^= GENERATOR << (high - 11)
        single.append(word)
    out = np.zeros(1 << 23, np.uint16)
    for bit in range(23):
        out[1 << bit:2 << bit] = out[:1 << bit] ^ np.uint16(single[bit])
    return out


@lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, np.ndarray]:
    """(syndromes of the 23-bit words, error pattern of each syndrome)."""
    syndromes = _remainders()
    errors = np.zeros(1 << 11, np.uint32)
    bits = [1 << i for i in range(23)]
    for i in range(23):
        errors[syndromes[bits[i]]] = bits[i]
        for j in range(i):
            two = bits[i] | bits[j]
            errors[syndromes[two]] = two
            for k in range(j):
                three = two | bits[k]
                errors[syndromes[three]] = three
    return syndromes, errors


def nearest(words: np.ndarray) -> np.ndarray:
    """Index (12 bits) of the codeword within three bits of each 23-bit word."""
    syndromes, errors = golay()
    return (words.astype(np.uint32) ^ errors[syndromes[words]]) >> np.uint32(11)


def golay_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(stored keys [n, 3], probed keys [n, 3, 23]) of unsigned fingerprints.

    Probed keys of a row may repeat. A key holds the segment's number, its
    bits and the next segment's codeword index.
    """
    segments = [(prints >> np.uint64(low)) & np.uint64((1 << width) - 1)
                for low, width in SEGMENTS]
    stored, probed = [], []
    for i, own in enumerate(segments):
        after, (_, width) = segments[(i + 1) % 3], SEGMENTS[(i + 1) % 3]
        head = (np.uint64(i) << np.uint64(34)) | (own << np.uint64(12))
        flips = np.array([0] + [1 << b for b in range(width)] + [0] * (22 - width), np.uint64)
        stored.append(head | nearest(after).astype(np.uint64))
        near = nearest((after[:, None] ^ flips[None, :]).ravel()).reshape(len(prints), -1)
        probed.append(head[:, None] | near.astype(np.uint64))
    return np.stack(stored, 1).astype(np.int64), np.stack(probed, 1).astype(np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """doc_id and ``fp`` (signed 64-bit) of every row."""
    def make():
        return lambda texts: [np.array([fingerprint(t, shingle) for t in texts],
                                       np.uint64).astype(np.int64)]
    return with_text_columns(docs, [id_col], text_col, make, [StructField("fp", LongType())])


def _keyed(nodes: DataFrame) -> DataFrame:
    """(fp, key, stored): each node's stored and probed keys."""
    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy()
            for start in range(0, len(fp), 5000):
                own = fp[start:start + 5000]
                stored, probed = golay_keys(own.astype(np.uint64))
                probed = np.sort(probed.reshape(len(own), -1), axis=1)
                new = np.ones(probed.shape, bool)
                new[:, 1:] = probed[:, 1:] != probed[:, :-1]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([np.repeat(own, 3), np.repeat(own, new.sum(1))])),
                    pa.array(np.concatenate([stored.ravel(), probed[new]])),
                    pa.array(np.arange(3 * len(own) + new.sum()) < 3 * len(own))],
                    names=["fp", "key", "stored"])
    return map_arrow(nodes.select("fp"), run, "fp long, key long, stored boolean")


def links(nodes: DataFrame, max_bits: int = 2, hot_key: int = HOT_KEY) -> DataFrame:
    """(a, b) links that join all fingerprints within ``max_bits`` (at most 2).

    ``nodes`` has distinct ``fp``. Links of common keys are given through the
    smallest member of each midpoint; their transitive closure is the same.
    """
    if max_bits not in (0, 1, 2):
        raise ValueError(f"Golay keys find up to 2 differing bits, not {max_bits}")
    keyed = checkpointed(_keyed(nodes))
    stored = keyed.where("stored").select("key", F.col("fp").alias("a"))
    probes = keyed.where("not stored").select("key", F.col("fp").alias("b"))
    sizes = stored.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    hot = sizes.where(F.col("n") > hot_key).select("key")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    cold = sizes.where((F.col("n") <= hot_key)).select("key")
    pairs = (stored.join(cold, "key", "left_semi").join(probes, "key")
             .where((F.col("a") < F.col("b")) & near).select("a", "b"))
    if max_bits == 0:
        return pairs
    members = keyed.join(hot, "key", "left_semi").select("fp").distinct()
    if max_bits == 2:
        flips = F.array(F.lit(0).cast("long"), *[F.shiftleft(F.lit(1).cast("long"), i)
                                                 for i in range(64)])
        points = members.select("fp", F.explode(F.transform(
            flips, lambda e: F.col("fp").bitwiseXOR(e))).alias("point"))
        lowest = points.groupBy("point").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n"))
        crowded = points.join(lowest.where("n > 1"), "point")
        hot_links = crowded.select("a", F.col("fp").alias("b")).where("a <> b").distinct()
    else:
        flips = F.array(*[F.shiftleft(F.lit(1).cast("long"), i) for i in range(64)])
        points = members.select(F.col("fp").alias("b"), F.explode(F.transform(
            flips, lambda e: F.col("fp").bitwiseXOR(e))).alias("a"))
        hot_links = points.join(members.select(F.col("fp").alias("a")), "a").select("a", "b")
    return pairs.union(hot_links)


def _labelled(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int,
              hot_key: int) -> tuple[DataFrame, DataFrame]:
    """(rows with fp and a hash of id and text, (fp, root, component_id) of each fp)."""
    rows = docs.select(F.col(id_col), F.col(text_col),
                       F.xxhash64(F.col(id_col), F.col(text_col)).alias("row_hash"))
    prints = with_text_columns(rows, [id_col, "row_hash"], text_col, lambda: (
        lambda texts: [np.array([fingerprint(t, shingle) for t in texts],
                                np.uint64).astype(np.int64)]),
        [StructField("fp", LongType())])
    prints = checkpointed(prints)
    nodes = checkpointed(prints.groupBy("fp").agg(F.min(id_col).alias("low")))
    roots = components(links(nodes, max_bits, hot_key))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    labels = named.join(lowest, "root").select("fp", "root", "component_id")
    return prints, checkpointed(labels)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 2, hot_key: int = HOT_KEY) -> DataFrame:
    """doc_id, fingerprint (hex), component_id of every row.

    component_id is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits, the row's own included; null ids are passed
    over, and a component of null ids alone has a null id. Null and empty texts
    have fingerprint zero, which links like any other. Repeated rows stay.
    """
    prints, labels = _labelled(docs, id_col, text_col, shingle, max_bits, hot_key)
    return prints.join(labels, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 3, max_bits: int = 2, hot_key: int = HOT_KEY) -> DataFrame:
    """One row of each near-duplicate component, all columns unchanged.

    It is the row of the smallest id (null ids last), of equal ids the one with
    the smaller hash of id and text; of rows equal in both, any one.
    """
    prints, labels = _labelled(docs, id_col, text_col, shingle, max_bits, hot_key)
    kept = (prints.join(labels, "fp").groupBy("root")
            .agg(F.min(F.struct(F.col(id_col).isNull(), id_col, "row_hash")).alias("first"))
            .select(F.concat_ws("/", "first.row_hash", F.col(f"first.{id_col}").cast("string")).alias("row_key")))
    names = [f"column_{i}" for i in range(len(docs.columns))]
    own, text = (names[docs.columns.index(c)] for c in (id_col, text_col))
    # hash and id in one key: rows of different ids are told apart even if their hashes meet
    rows = docs.toDF(*names).withColumn(
        "row_key", F.concat_ws("/", F.xxhash64(own, text), F.col(own).cast("string")))
    return (rows.dropDuplicates(["row_key"]).join(kept, "row_key", "left_semi")
            .select(names).toDF(*docs.columns))
