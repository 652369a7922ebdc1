"""Toxicity: cumulative-link ordinal regression from sparse text features.

Grades: 0 for documents labelled clean; toxic ones get 1 to 3 by how many
distinct *marked* words they hold (words that toxic sample documents use far
more often), cut at the terciles of the toxic sample. A document's features are
those of its distinct words: the word and its character n-grams, hashed. One
weight vector serves all thresholds: P(grade > k) = sigmoid(s - b_k) with rising
b_k. Features whose use in toxic and clean documents doesn't differ beyond
chance (a likelihood-ratio test) have no weight; the others' are fitted with an L1 penalty by proximal
adaptive gradient steps, on a bounded sample of labelled rows (``SAMPLE_ROWS``, a tenth
of it kept for toxic rows, however rare they are).

The score of a word doesn't depend on its document, so scoring sums the scores
of a text's distinct words. ``severity`` is the expected grade (0 to 3).
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, IntegerType, StringType,
                               StructField)

from lumenreg.llm.batches import Memo, flat, sums, with_text_columns
from lumenreg.llm.language import hash_points
from lumenreg.llm.quality_model import sample

SAMPLE_ROWS = 6_000
#: Clean rows leave this part of the sample to toxic ones, however rare these are.
RARE_SHARE = 10
BITS = 20
SIZES = (3, 4, 5)
GRADES = 4
MARK_ODDS, MARK_ROWS = 3.0, 3
#: Words, and characters of them, whose features are worked out together.
CHUNK, RUN = 20_000, 1 << 19
#: Root of the likelihood-ratio statistic that a feature must reach to be fitted.
CLEAR = 5.0
STEPS, RATE, PENALTY = 400, 0.06, 2e-5
TRIM = b".,;:!?\"'()[]{}#*$%&|<>"


def words_of(raw: bytes | None) -> list[bytes]:
    """Distinct lower-case words of a text without marks around them, sorted."""
    found = {w.strip(TRIM) for w in (raw or b"").decode().lower().encode().split()}
    return sorted(found - {b""})


def word_features(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word numbers, feature numbers): the words' n-grams of ``SIZES`` and themselves.

    Runs of ``RUN`` characters at a time, so that a word may have any length.
    """
    texts = [f"\x02{w.decode()}\x03" for w in words]
    ends = np.cumsum([len(t) for t in texts])
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    number = lambda hashes: (hashes >> np.uint64(64 - BITS)).astype(np.int64)
    for start in range(0, len(points), RUN):
        place = np.arange(start, min(start + RUN, len(points)))
        owner = np.searchsorted(ends, place, "right")
        room = ends[owner] - place
        for size in SIZES:
            fits = room >= size
            at = place[fits]
            grams = np.stack([points[at + k] for k in range(size)], axis=1).astype(np.uint64)
            yield owner[fits], number(hash_points(grams))
    whole = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    yield np.arange(len(words)), number(whole)


@dataclass
class Ordinal:
    weights: np.ndarray
    cuts: np.ndarray  # rising, GRADES - 1 of them

    def word_scores(self, words: list[bytes]) -> list[float]:
        out = np.zeros(len(words))
        for owner, feature in word_features(words):
            if len(owner):
                part = np.bincount(owner - owner[0], self.weights[feature])
                out[owner[0]:owner[0] + len(part)] += part
        return out.tolist()

    def exceed(self, s: np.ndarray) -> np.ndarray:
        """P(grade > k) for k = 0, 1, 2."""
        return 1.0 / (1.0 + np.exp(np.clip(self.cuts[None, :] - s[:, None], -60, 60)))


@dataclass
class Sample:
    """Distinct words of sampled documents, as numbers into a vocabulary."""

    vocabulary: list[bytes]
    word: np.ndarray
    doc: np.ndarray
    rows: int

    @classmethod
    def of(cls, word_lists) -> "Sample":
        number: dict[bytes, int] = {}
        words, sizes = array("i"), []
        for found in word_lists:
            words.extend([number.setdefault(w, len(number)) for w in found])
            sizes.append(len(found))
        return cls(list(number), np.frombuffer(words, np.int32) if words else np.zeros(0, np.int32),
                   np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), len(sizes))

    def features(self):
        """(word numbers, feature numbers), a bounded run of the vocabulary at a time."""
        for start in range(0, len(self.vocabulary), CHUNK):
            for owner, feature in word_features(self.vocabulary[start:start + CHUNK]):
                yield owner + start, feature


def grades_of(sample: Sample, toxic: np.ndarray) -> np.ndarray:
    """Severity grades of the sample, see the module's text."""
    bad = toxic[sample.doc]
    n = len(sample.vocabulary)
    a, b = (np.bincount(sample.word[x], minlength=n) for x in (~bad, bad))
    odds = np.log((b + 0.5) / max(1, toxic.sum())) - np.log((a + 0.5) / max(1, (~toxic).sum()))
    marked = (b >= MARK_ROWS) & (odds >= MARK_ODDS)
    held = np.bincount(sample.doc[marked[sample.word]], minlength=sample.rows)
    cuts = np.quantile(held[toxic], [1 / 3, 2 / 3]) if toxic.any() else [0, 0]
    return np.where(toxic, 1 + (held > cuts[0]) + (held > cuts[1]), 0)


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(v, -60, 60)))


def gradient(s: np.ndarray, cuts: np.ndarray, grades: np.ndarray,
             balance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the weighted negative log-likelihood by the scores and by the thresholds.

    P(grade = g) = sigmoid(s - b_(g-1)) - sigmoid(s - b_g), with ends 1 and 0.
    """
    high, low = grades > 0, grades < GRADES - 1
    above = np.where(high, _sigmoid(s - cuts[np.maximum(grades - 1, 0)]), 1.0)
    below = np.where(low, _sigmoid(s - cuts[np.minimum(grades, GRADES - 2)]), 0.0)
    chance = np.maximum(above - below, 1e-9)
    by_cut = np.zeros(len(cuts))
    np.add.at(by_cut, grades[high] - 1, (balance * above * (1 - above) / chance)[high])
    np.add.at(by_cut, grades[low], -(balance * below * (1 - below) / chance)[low])
    return (above + below - 1.0) * balance, by_cut


def fit_ordinal(sample: Sample, grades: np.ndarray) -> Ordinal:
    """Shared weights and ordered thresholds; without toxic or clean rows only thresholds."""
    share = [np.clip((grades > k).mean() if len(grades) else 0.0, 1e-3, 1 - 1e-3)
             for k in range(GRADES - 1)]
    cuts = np.maximum.accumulate(-np.log(np.array(share) / (1 - np.array(share)))
                                 + 1e-3 * np.arange(GRADES - 1))
    weights = np.zeros(1 << BITS)
    if not len(grades) or grades.min() == grades.max() or not len(sample.word):
        return Ordinal(weights, cuts)
    # screening: features whose share among toxic documents' words stands out
    word, doc, n_words = sample.word, sample.doc, len(sample.vocabulary)
    toxic_word = grades[doc] > 0
    times = [np.bincount(word[x], minlength=n_words) for x in (toxic_word, ~toxic_word)]
    used = [np.zeros(1 << BITS), np.zeros(1 << BITS)]
    for owner, feature in sample.features():
        for u, t in zip(used, times):
            u += np.bincount(feature, t[owner], 1 << BITS)
    share = toxic_word.mean()
    both = used[0] + used[1]
    gain = 2 * sum(np.where(u > 0, u * np.log(np.maximum(u, 1) / np.maximum(both * part, 1e-9)), 0.0)
                   for u, part in zip(used, (share, 1 - share)))
    clear = gain >= CLEAR ** 2
    found = [(owner[clear[feature]], feature[clear[feature]]) for owner, feature in sample.features()]
    owner, feature = (np.concatenate(x) for x in zip(*found))
    holds = np.zeros(n_words, bool)
    holds[owner] = True
    word, doc = word[holds[word]], doc[holds[word]]
    kept, feature = np.unique(feature, return_inverse=True)
    w, seen, seen_cuts = np.zeros(len(kept)), np.full(len(kept), 1e-8), np.full(len(cuts), 1e-8)
    high = grades > 0
    balance = np.where(high, 0.5 / high.mean(), 0.5 / (~high).mean()) / len(grades)
    for _ in range(STEPS):
        s = np.bincount(doc, np.bincount(owner, w[feature], n_words)[word], len(grades))
        slope, g_cuts = gradient(s, cuts, grades, balance)
        g = np.bincount(feature, np.bincount(word, slope[doc], n_words)[owner], len(kept))
        seen += g * g
        step = RATE / np.sqrt(seen)
        w -= step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * PENALTY, 0.0)
        seen_cuts += g_cuts * g_cuts
        cuts = np.maximum.accumulate(cuts - RATE / np.sqrt(seen_cuts) * g_cuts
                                     + 1e-6 * np.arange(len(cuts)))
    weights[kept] = w
    return Ordinal(weights, cuts)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        sample_rows: int = SAMPLE_ROWS) -> Ordinal:
    """A model from a bounded sample of the labelled documents that are not held out."""
    found = sample(docs, labels, "toxic", [StructField("words", ArrayType(StringType()))],
                   lambda: lambda texts: [[[w.decode() for w in words_of(t)] for t in texts]],
                   sample_rows, id_col, text_col, most_of={False: sample_rows - sample_rows // RARE_SHARE}).select("doc_id", "good", "words").toArrow()
    words = Sample.of([w.encode() for w in x.as_py()] for x in found.column("words"))
    toxic = np.array(found.column("good").to_pylist(), bool)
    return fit_ordinal(words, grades_of(words, toxic))


def predict(docs: DataFrame, model: Ordinal, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """id, severity (expected grade), grade (most likely count of thresholds passed), toxic.

    Null, empty and wordless texts get the score of no features. ``toxic`` is
    P(grade > 0) >= 0.5. Labels repeated for an id count by their mean.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2^BITS weights

    def make():
        memo = Memo(shared.value.word_scores)

        def step(texts):
            words, starts = flat([words_of(t) for t in texts])
            memo.add(set(words))
            s = sums(np.fromiter(map(memo.__getitem__, words), np.float64, len(words)), starts)
            passed = shared.value.exceed(s)
            return [passed.sum(axis=1), (passed >= 0.5).sum(axis=1).astype(np.int32),
                    passed[:, 0] >= 0.5]
        return step

    return with_text_columns(docs, [id_col], text_col, make,
                             [StructField("severity", DoubleType()),
                              StructField("grade", IntegerType()),
                              StructField("toxic", BooleanType())])
