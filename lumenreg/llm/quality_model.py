"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are grown on binned statistics of a bounded sample of labelled rows
(``SAMPLE_ROWS``, the smallest hashes of doc_id), with logistic loss, and kept
as flat arrays (a complete tree of ``DEPTH`` levels each). Scoring walks all
rows of a slice down all trees with array look-ups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from lumenreg.llm.batches import with_text_columns
from lumenreg.llm.document_stats import NAMES, statistics
from lumenreg.llm.quality_rules import labelled

SAMPLE_ROWS = 20_000
TREES, DEPTH, RATE, BINS, L2, MIN_ROWS = 60, 4, 0.15, 64, 5.0, 20
AT = {name: i for i, name in enumerate(NAMES)}
#: Features: shares and lengths of the statistics.
SHARES = (("n_symbols", "word_chars"), ("n_upper", "word_chars"), ("n_digits", "word_chars"),
          ("n_wide", "word_chars"), ("n_marks", "n_words"), ("n_shouts", "n_words"),
          ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"), ("n_distinct", "n_words"),
          ("n_short", "n_distinct"), ("word_chars", "n_words"), ("n_words", "n_lines"))


def features(texts: list[bytes | None]) -> np.ndarray:
    """[n, features] of whole texts; empty texts have all-zero features."""
    if not texts:
        return np.zeros((0, len(SHARES) + 2))
    raw = np.array([statistics(t) for t in texts], np.float64)
    shares = [raw[:, AT[a]] / np.maximum(raw[:, AT[b]], 1) for a, b in SHARES]
    return np.stack([*shares, np.log1p(raw[:, AT["n_words"]]), np.log1p(raw[:, AT["n_lines"]])],
                    axis=1)


@dataclass
class Forest:
    base: float
    feature: np.ndarray  # [trees, 2^depth - 1]
    cut: np.ndarray  # goes right if the feature is over it; inf: a node that isn't split
    value: np.ndarray  # [trees, 2^depth]

    def score(self, x: np.ndarray) -> np.ndarray:
        rows, total = np.arange(len(x)), np.full(len(x), self.base)
        depth = self.value.shape[1].bit_length() - 1 if len(self.value) else 0
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += value[node - len(feature)]
        return 1.0 / (1.0 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH,
         rate: float = RATE) -> Forest:
    """Boosted trees by level-wise histogram splits; a constant if one class is missing.

    Of splits of equal gain the first feature's lowest cut wins.
    """
    n, width = x.shape
    inner, leaves = 2 ** depth - 1, 2 ** depth
    share = (y.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    if n == 0 or y.min() == y.max():
        return Forest(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)),
                      np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)])
    out_f, out_c, out_v = [], [], []
    margin = np.full(n, base)
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            gain, choice = np.zeros(count), np.zeros((count, 2), np.int64)
            for j in range(width):
                slot = (node - first) * BINS + binned[j]
                g, h, m = (np.bincount(slot, w, count * BINS).reshape(count, BINS).cumsum(1)
                           for w in (grad, hess, None))
                gt, ht, mt = g[:, -1:], h[:, -1:], m[:, -1:]
                better = (g ** 2 / (h + L2) + (gt - g) ** 2 / (ht - h + L2) - gt ** 2 / (ht + L2))
                better[(m < MIN_ROWS) | (mt - m < MIN_ROWS)] = 0
                better[:, len(edges[j]):] = 0
                at = better.argmax(axis=1)
                best = better[np.arange(count), at]
                new = best > gain + 1e-9
                gain[new] = best[new]
                choice[new] = np.stack([np.full(count, j), at], 1)[new]
            for k in np.flatnonzero(gain > 0):
                feature[first + k] = choice[k, 0]
                cut[first + k] = edges[choice[k, 0]][choice[k, 1]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, grad, leaves) / (np.bincount(leaf, hess, leaves) + L2)
        margin += value[leaf]
        out_f.append(feature), out_c.append(cut), out_v.append(value)
    return Forest(base, np.array(out_f), np.array(out_c), np.array(out_v))


def held_out(id_col: str = "doc_id"):
    """True for the documents whose labels are never learned."""
    value = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1
    return F.coalesce(value, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, value_col: str, fields, make, rows: int,
           id_col: str = "doc_id", text_col: str = "text",
           most_of: dict[bool, int] | None = None) -> DataFrame:
    """``good`` and the step's fields of at most ``rows`` labelled documents that may be learned.

    The labelled ids are bounded before they are broadcast, and the rows again
    after the join, where ids repeat. ``most_of`` (label -> ids) draws up to so many ids
    of a label first; the other label has the rest of ``rows``.
    """
    draw = F.xxhash64(F.lit("label sample"), "doc_id")
    known = labelled(labels, id_col, value_col).where(~held_out("doc_id"))
    ids = known.orderBy(draw, "doc_id").limit(rows)
    for label, most in (most_of or {}).items():
        first = known.where(F.col("good") == label).orderBy(draw, "doc_id").limit(most)
        ids = first.union(known.where(F.col("good") != label).orderBy(draw, "doc_id")
                          .limit(rows - first.count()))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(
        F.broadcast(ids), "doc_id")
    return (with_text_columns(texts, ["doc_id", "good"], "text", make, fields)
            .orderBy(F.xxhash64(F.lit("label sample"), "doc_id"), "doc_id").limit(rows))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Trees from a bounded sample of the labelled documents that are not held out."""
    from pyspark.sql.types import ArrayType

    found = sample(docs, labels, "quality", [StructField("x", ArrayType(DoubleType()))],
                   lambda: lambda texts: [features(texts).tolist()], sample_rows, id_col,
                   text_col).select("doc_id", "good", "x").collect()
    width = features([b"a"]).shape[1]
    return grow(np.array([r["x"] for r in found], np.float64).reshape(-1, width),
                np.array([r["good"] for r in found], np.float64))


def predict(docs: DataFrame, forest: Forest, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """id, score (0 to 1) and predicted (1 if the score is 0.5 or more) of every row.

    Null texts are empty; empty texts are scored by their all-zero statistics.
    Repeated rows each give their row.
    """
    def make():
        def step(texts):
            score = forest.score(features(texts))
            return [score, (score >= 0.5).astype(np.int32)]
        return step

    return with_text_columns(docs, [id_col], text_col, make,
                             [StructField("score", DoubleType()),
                              StructField("predicted", IntegerType())])
