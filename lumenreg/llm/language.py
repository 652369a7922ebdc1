"""Language ID: interpolated Kneser-Ney character models in sorted hash arrays.

A model of order 4 is kept for each language over the letters of its words,
with marks at a word's start and end. Counts come from whole texts of a bounded
sample of labelled documents (``SAMPLE_DOCS`` for each language in expectation,
chosen by a hash of doc_id); Spark sums them. Highest-order counts are raw,
lower ones count distinct left neighbours; every order is discounted by
n1 / (n1 + 2 n2) and interpolated with the next lower one, down to a uniform
share. All n-grams lie in one sorted hash array for each order, with a column of
log-probabilities for each language, and contexts with their back-off weights.

A text is given the language of the lowest cross-entropy per character. The
score is a softmax of the negated cross-entropies, whose sharpness is fitted on
held-back sample documents, as are the rejection limits: a document is rejected
if it has no letter, or if its cross-entropy exceeds its language's largest
held-back one by more than ``SLACK`` and ``SIGMAS`` standard errors. Of equal
cross-entropies the first language name wins. Words of any length are scored, in runs
of ``RUN`` letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StringType, StructField

from lumenreg.llm.batches import Memo, flat, keep_rows, map_arrow, sums, with_text_columns

ORDER = 4
#: Sample bound: expected documents of each language, held-back ones included.
SAMPLE_DOCS = 500
HELD_BACK = 4  # one sampled document in so many calibrates
SLACK, SIGMAS = 0.5, 4.0
#: Letters whose probabilities are worked out together.
RUN = 1 << 17
START, END = "\x02", "\x03"
UNKNOWN = "und"
PRIME = np.uint64(0x9E3779B97F4A7C15)
LETTERS = regex.compile(r"\p{L}+")
SHARPNESS = (1.0, 2.0, 5.0, 10.0, 20.0, 50.0)


def bare(word: bytes) -> str:
    """The word's letters, lower case, between word marks; '' if it has none."""
    found = "".join(LETTERS.findall(word.decode())).lower()
    return f"{START}{found}{END}" if found else ""


def grams(word: str) -> Iterator[str]:
    """The longest n-gram (up to ``ORDER``) that ends at each place after the start."""
    return (word[max(0, i - ORDER + 1):i + 1] for i in range(1, len(word)))


def hash_points(points: np.ndarray) -> np.ndarray:
    """Hash of each row of code points (uint64 [n, k])."""
    out = np.zeros(len(points), np.uint64)
    for k in range(points.shape[1]):
        out = (out + points[:, k] + np.uint64(1)) * PRIME
        out ^= out >> np.uint64(29)
    return out


def hash_strings(texts: list[str]) -> np.ndarray:
    """Hashes of strings of equal length."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.uint64)
    return hash_points(points.reshape(len(texts), -1))


@dataclass
class Model:
    languages: list[str]
    #: for each order 1..ORDER: sorted hashes, log-probabilities [n, languages] (nan: unseen)
    hashes: list[np.ndarray]
    logs: list[np.ndarray]
    #: for each order 2..ORDER: sorted context hashes, log back-off weights (0: unseen)
    context_hashes: list[np.ndarray]
    back_offs: list[np.ndarray]
    floor: np.ndarray  # log-probability of a character never seen
    limits: np.ndarray | None = None  # rejection limit of each language
    spread: np.ndarray | None = None  # standard deviation of a character's cross-entropy
    sharpness: float = 10.0

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        """[n, languages + 1]: negative log-probability of each word, and its characters."""
        out = np.zeros((len(words), len(self.languages) + 1))
        texts = [bare(w) for w in words]
        lengths = np.array([len(t) for t in texts], np.int64)
        if not lengths.sum():
            return out
        points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        ends = np.cumsum(lengths)
        for start in range(0, len(points), RUN):
            at = np.arange(start, min(start + RUN, len(points)))
            owner = np.searchsorted(ends, at, "right")
            place = at - (ends - lengths)[owner]
            inner = place > 0  # the start mark is never predicted
            at, owner, place = at[inner], owner[inner], place[inner]
            if not len(at):
                continue
            first = owner[0]
            log = self._logs(points, at, place)
            for k in range(len(self.languages)):
                part = np.bincount(owner - first, -log[:, k])
                out[first:first + len(part), k] += part
            part = np.bincount(owner - first)
            out[first:first + len(part), -1] += part
        return out

    def _logs(self, points: np.ndarray, at: np.ndarray, place: np.ndarray) -> np.ndarray:
        """[n, languages]: log-probabilities of the points ``at``, which stand at ``place``."""
        log = np.tile(self.floor, (len(at), 1))
        for order in range(1, ORDER + 1):
            fits = np.flatnonzero(place >= order - 1)
            here = at[fits]
            window = np.stack([points[here - k] for k in range(order - 1, -1, -1)],
                              axis=1).astype(np.uint64)
            if order > 1:
                row, found = _find(self.context_hashes[order - 2], hash_points(window[:, :-1]))
                log[fits[found]] += self.back_offs[order - 2][row]
            row, found = _find(self.hashes[order - 1], hash_points(window))
            seen = self.logs[order - 1][row]
            log[fits[found]] = np.where(np.isnan(seen), log[fits[found]], seen)
        return log


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows of the keys that the sorted table has, which keys those are)."""
    if not len(table):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    found = np.flatnonzero(table[row] == keys)
    return row[found], found


def kneser_ney(counts: dict[str, int], alphabet: int) -> tuple[list[dict], list[dict], float]:
    """(log-probabilities by order, log back-offs by order, log floor) of one language.

    ``counts`` has the longest n-gram at each place (shorter ones begin with the
    start mark); ``alphabet`` is the number of characters any language has.
    """
    by_order: list[dict[str, int]] = [{} for _ in range(ORDER + 1)]
    for gram, n in counts.items():
        by_order[len(gram)][gram] = n
    for order in range(ORDER, 1, -1):  # each distinct left neighbour counts once
        for gram in by_order[order]:
            lower = by_order[order - 1]
            lower[gram[1:]] = lower.get(gram[1:], 0) + 1
    floor = 1.0 / (alphabet + 1)
    chance: list[dict[str, float]] = [{} for _ in range(ORDER + 1)]
    back: list[dict[str, float]] = [{} for _ in range(ORDER + 1)]
    for order in range(1, ORDER + 1):
        here = by_order[order]
        singles = sum(1 for n in here.values() if n == 1)
        doubles = sum(1 for n in here.values() if n == 2)
        discount = singles / (singles + 2 * doubles) if singles else 0.5
        totals: dict[str, list] = {}
        for gram, n in here.items():
            total = totals.setdefault(gram[:-1], [0, 0])
            total[0] += n
            total[1] += 1
        for context, (total, kinds) in totals.items():
            back[order][context] = discount * kinds / total
        for gram, n in here.items():
            total = totals[gram[:-1]][0]
            lower = chance[order - 1].get(gram[1:], floor) if order > 1 else floor
            chance[order][gram] = (n - discount) / total + back[order][gram[:-1]] * lower
    logs = [{g: float(np.log(p)) for g, p in x.items()} for x in chance[1:]]
    backs = [{g: float(np.log(p)) for g, p in x.items()} for x in back[2:]]
    return logs, backs, float(np.log(floor * back[1].get("", 1.0)))


def build(counts: dict[str, dict[str, int]]) -> Model:
    """A model from each language's n-gram counts."""
    languages = sorted(counts)
    alphabet = len({c for x in counts.values() for g in x for c in g})
    models = [kneser_ney(counts[name], alphabet) for name in languages]

    def table(parts: list[dict[str, float]], default: float):
        names = sorted(set().union(*parts)) if parts else []
        if not names:
            return np.zeros(0, np.uint64), np.zeros((0, len(languages)))
        keys = hash_strings(names)
        values = np.array([[p.get(n, default) for p in parts] for n in names])
        order = np.argsort(keys)
        return keys[order], values[order]

    grams_by_order = [table([m[0][k] for m in models], np.nan) for k in range(ORDER)]
    contexts = [table([m[1][k] for m in models], 0.0) for k in range(ORDER - 1)]
    return Model(languages, [g[0] for g in grams_by_order], [g[1] for g in grams_by_order],
                 [c[0] for c in contexts], [c[1] for c in contexts],
                 np.array([m[2] for m in models]))


class Scorer:
    """Cross-entropies of whole texts by a model, through a memo of words."""

    def __init__(self, model: Model, limit: int = 200_000):
        self.model, self.limit = model, limit
        self.table = np.zeros((1024, len(model.languages) + 1))
        self.memo = Memo(self.compute, limit)

    def compute(self, words: list[bytes]) -> list[int]:
        start = len(self.memo)  # the memo has just been emptied, or holds rows 0..start-1
        if start + len(words) > len(self.table):
            grown = np.zeros((2 * (start + len(words)), self.table.shape[1]))
            grown[:start] = self.table[:start]
            self.table = grown
        self.table[start:start + len(words)] = self.model.word_scores(words)
        return list(range(start, start + len(words)))

    def entropies(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy per character [n, languages], characters [n])."""
        words, starts = flat([(t or b"").split() for t in texts])
        self.memo.add(set(words))
        rows = np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))
        total = sums(self.table[rows], starts)
        return total[:, :-1] / np.maximum(total[:, -1:], 1), total[:, -1]

    def verdicts(self, texts: list[bytes | None]):
        """(language or 'und', score, rejected) lists."""
        model = self.model
        entropy, n = self.entropies(texts)
        best = entropy.argmin(axis=1)
        top = entropy[np.arange(len(best)), best]
        score = 1.0 / np.exp(-model.sharpness * (entropy - top[:, None])).sum(axis=1)
        limit = (model.limits[best] + SLACK
                 + SIGMAS * model.spread[best] / np.sqrt(np.maximum(n, 1)))
        rejected = (n == 0) | (top > limit)
        return ([model.languages[b] if k else UNKNOWN for b, k in zip(best, n)],
                np.where(n > 0, score, 0.0), rejected)


def held_out(id_col: str | Column = "doc_id") -> Column:
    """True for the documents whose labels are never learned."""
    value = F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2
    return F.coalesce(value, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """A model from the documents that are not held out; None if none has letters.

    Rows with null id, text or language are not learned from. One in HELD_BACK of the
    sample calibrates the model, but of a language that would keep no document to learn
    from, none is held back.
    """
    back = F.pmod(F.xxhash64(F.lit("held back"), "id"), F.lit(HELD_BACK)) == 0
    draw = F.pmod(F.xxhash64(F.lit("language sample"), "id"), F.lit(1 << 30)) / float(1 << 30)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.col(lang_col).cast("string").alias("lang")).where(
        F.col("id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull()
        & ~held_out("id"))
    found = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(~back, draw))
                                     .alias("first")).collect()  # one row for each language
    sizes = {r["lang"]: r["n"] for r in found}
    if not sizes:
        return None
    rare = [r["lang"] for r in found if r["first"] is None or r["first"] >= min(1.0, sample_docs / r["n"])]
    share = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items())
                           for x in (lang, min(1.0, sample_docs / n))])
    sample = rows.where(draw < share[F.col("lang")]).withColumn("back", back & ~F.col("lang").isin(rare))

    def count(batches):
        for batch in batches:
            found: dict = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words: dict = {}
                for w in text.split():
                    words[w] = words.get(w, 0) + 1
                for w, n in words.items():
                    for g in grams(bare(w)):
                        found[lang, g] = found.get((lang, g), 0) + n
            yield pa.RecordBatch.from_pydict({"lang": [k[0] for k in found],
                                              "gram": [k[1] for k in found],
                                              "n": list(found.values())},
                                             schema=pa.schema([("lang", pa.string()),
                                                               ("gram", pa.string()),
                                                               ("n", pa.int64())]))

    def collected(part):
        summed = (map_arrow(part.select(F.col("text").cast("binary"), "lang"), count,
                            "lang string, gram string, n long")
                  .groupBy("lang", "gram").agg(F.sum("n").alias("n"))).toArrow()
        out: dict = {}
        for lang, gram, n in zip(*(summed.column(c).to_pylist() for c in ("lang", "gram", "n"))):
            out.setdefault(lang, {})[gram] = n
        return out

    counts = collected(sample.where("not back"))
    if not counts:  # a handful of documents: learn and calibrate on the same ones
        counts, sample = collected(sample), sample.withColumn("back", F.lit(True))
    if not counts:
        return None
    model = build(counts)
    return calibrate(model, sample.where("back"))


def calibrate(model: Model, held_back: DataFrame) -> Model:
    """Rejection limits and sharpness from the held-back documents' cross-entropies."""
    k = len(model.languages)

    def make():
        scorer = Scorer(model)

        def step(texts):
            entropy, n = scorer.entropies(texts)
            return [entropy.tolist(), n]
        return step

    seen = with_text_columns(held_back, ["lang"], "text", make,
                             [StructField("entropy", ArrayType(DoubleType())),
                              StructField("n", DoubleType())]).where("n > 0").collect()
    own = [model.languages.index(r["lang"]) if r["lang"] in model.languages else -1 for r in seen]
    entropy = np.array([r["entropy"] for r in seen]).reshape(len(seen), k)
    n = np.array([r["n"] for r in seen])
    own = np.array(own, np.int64)
    ok = own >= 0
    entropy, n, own = entropy[ok], n[ok], own[ok]
    right = entropy[np.arange(len(own)), own]
    everywhere = float(right.max()) if len(right) else float("inf")
    model.limits = np.full(k, everywhere)
    model.spread = np.full(k, 2.0)
    for i in range(k):
        mine = own == i
        if mine.sum() >= 20:
            level, size = right[mine], n[mine]
            mean = np.average(level, weights=size)
            # a document's deviation from its language's mean, as a character's
            model.spread[i] = float(np.sqrt(np.mean((level - mean) ** 2 * size)))
            z = (level - mean) * np.sqrt(size)
            model.limits[i] = mean + max(0.0, float(np.quantile(z, 0.99)) / np.sqrt(
                float(np.median(size))))
    if len(own):
        loss = [np.mean(-np.log(1e-12 + np.exp(-s * (right - entropy.min(1)))
                                / np.exp(-s * (entropy - entropy.min(1)[:, None])).sum(1)))
                for s in SHARPNESS]
        model.sharpness = SHARPNESS[int(np.argmin(loss))]
    return model


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """id, lang_pred, score, rejected of every row.

    Null, empty and letterless texts are 'und' with score 0, and rejected; so is
    every text where there is no model. Rows repeat as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def make():
        scorer = Scorer(shared.value) if shared.value else None

        def step(texts):
            if scorer is None:
                n = len(texts)
                return [[UNKNOWN] * n, [0.0] * n, [True] * n]
            return list(scorer.verdicts(texts))
        return step

    return with_text_columns(docs, [id_col], text_col, make,
                             [StructField("lang_pred", StringType()),
                              StructField("score", DoubleType()),
                              StructField("rejected", BooleanType())])


def keep_accepted(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows whose language is not rejected, all columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        scorer = Scorer(shared.value) if shared.value else None
        return lambda texts: ([False] * len(texts) if scorer is None
                              else [not x for x in scorer.verdicts(texts)[2]])

    return keep_rows(docs, text_col, make)
