"""Spelling variants by finite-state composition.

A vocabulary V is a minimised acceptor. Composed with the transducer E that makes one
edit (a code point replaced, put in or left out) and with the acceptor again, V o E o V
accepts the pairs of near words. A pair whose words part at place p (their longest common
prefix) runs through the same states up to p, one edit arc, and then states of both
acceptors that read the same rest. So the composition falls apart by the state that it
starts from: Spark deals each word to the *initial states* that it passes or shares:
for the length m of a pair's shorter word, the state behind its first m div 2 code points
(pairs that part there or later), and the state in front of its last m - m div 2 ones
(pairs that part before). Words meet by a hash of that prefix or suffix, so that no task
needs the vocabulary. Each group's words become minimised acceptors, one for each
length, and their composition is enumerated; every pair comes from one group, that of
the place where it parts. Groups of too many letters are dealt anew by longer shared
prefixes and suffixes, halving the places where pairs may part, down to a single place,
where a group has no more words than letters.

A word's *form* is its near word of the largest count (ties: the first in code-point
order), if that is at least twice its own; ``root`` follows forms to the last. Counts at
least double at each step, so chains are short; they are followed by pointer doubling.

Null texts and texts without letters have no words. Null ids take part as ''. Repeated
rows count each. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenreg.llm.batches import map_arrow, slices
from lumenreg.session import checkpointed

RUN = re.compile("[A-Za-zÀ-ÿ]+")
UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
MIN_LETTERS, MIN_COUNT, LEAD = 5, 3, 2
#: One in so many (document, word) pairs loses a letter in the registered query.
DAMAGE = 97
#: Words that a task counts before it hands them on, and letters of a group of words.
HELD_WORDS, GROUP_LETTERS = 200_000, 400_000
PAIRS = 50_000


# ---------------------------------------------------------------- words
def lower(run: str) -> str:
    """Lower case for A-Z only."""
    return run.lower() if run.isascii() else run.translate(UPPER)


def damaged(key: bytes, word: str, every: int) -> str:
    """The word, without one letter if ``every`` divides the crc32 of ``<key>:<word>``."""
    h = zlib.crc32(word.encode(), zlib.crc32(key + b":"))
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                damage: int | None = None, least: int = MIN_LETTERS) -> DataFrame:
    """(word, n) over all whole texts, words of ``least`` code points or more."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary").alias("key"),
                       F.col(text_col).cast("binary").alias("text"))

    def flush(held):
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()),
                                          pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return out

    def run(batches):
        held = Counter()
        for batch in batches:
            for start, n in slices(batch, batch.column(1)):
                part = batch.slice(start, n)
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found = Counter(RUN.findall(text.decode("utf-8", "replace"))) if text else {}
                    for word, times in found.items():
                        word = lower(word)
                        word = damaged(key, word, damage) if damage else word
                        if len(word) >= least:
                            held[word] += times
                    if len(held) > HELD_WORDS:
                        yield flush(held)
        yield flush(held)

    return (map_arrow(rows, run, "word string, n long").groupBy("word")
            .agg(F.sum("n").alias("n")))


# ---------------------------------------------------------------- acceptors and composition
class Acceptor:
    """The minimal acceptor of words of one length, given sorted and distinct.

    State 0 is the start; ``arcs[state]`` maps a letter to the next state. A state is
    frozen once no later word can pass it: an equal one takes its place, if there is one.
    """

    def __init__(self, words: list[str]):
        self.arcs: list[dict] = [{}]
        known: dict = {}
        path, before = [0], ""

        def freeze(depth: int) -> None:
            while len(path) > depth + 1:
                state = path.pop()
                kind = tuple(self.arcs[state].items())
                self.arcs[path[-1]][before[len(path) - 1]] = known.setdefault(kind, state)

        for word in words:
            shared = 0
            while shared < len(before) and before[shared] == word[shared]:
                shared += 1
            freeze(shared)
            for letter in word[shared:]:
                self.arcs.append({})
                self.arcs[path[-1]][letter] = len(self.arcs) - 1
                path.append(len(self.arcs) - 1)
            before = word
        freeze(0)


def agreeing(one: Acceptor, p: int, two: Acceptor, q: int, rest: int,
             dead: set) -> Iterator[str]:
    """Strings of length ``rest`` that lead both acceptors to their ends, from p and from q.

    ``dead`` holds pairs of states known to agree on nothing.
    """
    stack = [(p, q, iter(one.arcs[p]))]
    letters: list[str] = []
    fruit = [False]
    if not rest:
        yield ""
        return
    while stack:
        p, q, todo = stack[-1]
        for letter in todo:
            other = two.arcs[q].get(letter)
            if other is None:
                continue
            if len(letters) + 1 == rest:
                fruit[-1] = True
                yield "".join(letters) + letter
                continue
            state = one.arcs[p][letter]
            if (state, other) not in dead:
                letters.append(letter)
                stack.append((state, other, iter(one.arcs[state])))
                fruit.append(False)
                break
        else:
            stack.pop()
            if fruit.pop():
                if fruit:
                    fruit[-1] = True
            else:
                dead.add((p, q))
            if letters:
                letters.pop()


def near_pairs(words: list[str], m: int, low: int, high: int) -> Iterator[tuple[str, str]]:
    """Pairs of near words whose shorter one has length m and that part at low .. high - 1.

    ``words``, sorted and distinct, have length m or m + 1. What all of them share in
    front, and their last m - high letters, stay out of the acceptors.
    """
    cut = 0
    first, last = words[0], words[-1]
    while cut < min(len(first), len(last), m) and first[cut] == last[cut]:
        cut += 1
    tail = max(m - high, 0)
    same = sorted({w for w in words if len(w) == m})
    ends = {w[len(w) - tail:] for w in words} if tail else {""}
    if len(ends) > 1:  # hashes of different suffixes met
        tail = 0
    longer = sorted({w for w in words if len(w) == m + 1})
    if not same:
        return
    head, end = first[:cut], first[len(first) - tail:] if tail else ""
    inner = m - cut - tail
    low, high = max(low - cut, 0), high - cut
    if high <= 0:  # all of them agree at every place of the range
        return
    one = Acceptor([w[cut:len(w) - tail] for w in same])
    two = Acceptor([w[cut:len(w) - tail] for w in longer]) if longer else None
    dead: set = set()
    dead_longer: set = set()
    # product states before the edit: the same prefix in both, hence one state of each
    stack = [(0, 0 if two else None, "")]
    while stack:
        p, q, prefix = stack.pop()
        depth = len(prefix)
        if low <= depth:
            out = sorted(one.arcs[p].items())
            for i, (a, after_a) in enumerate(out):  # a replaced letter
                for b, after_b in out[i + 1:]:
                    for rest in agreeing(one, after_a, one, after_b, inner - depth - 1, dead):
                        yield head + prefix + a + rest + end, head + prefix + b + rest + end
            if q is not None:
                for b, after_b in two.arcs[q].items():  # a letter put in, unlike the next one
                    if depth == inner:
                        yield head + prefix + end, head + prefix + b + end
                        continue
                    for c, after_c in out:
                        other = two.arcs[after_b].get(c) if c != b else None
                        if other is None:
                            continue
                        for rest in agreeing(one, after_c, two, other, inner - depth - 1, dead_longer):
                            yield head + prefix + c + rest + end, head + prefix + b + c + rest + end
        if depth + 1 < high:
            for letter, state in one.arcs[p].items():
                stack.append((state, None if q is None else two.arcs[q].get(letter), prefix + letter))


# ---------------------------------------------------------------- Spark side
def _dealt(words: DataFrame) -> DataFrame:
    """Words with the hash of what a group with (m, low, high) shares."""
    behind = F.greatest(F.col("m") - F.col("high"), F.lit(0))
    return words.withColumn("state", F.xxhash64(
        F.expr("substring(word, 1, low)"), F.when(behind > 0, F.expr("right(word, greatest(m - high, 0))"))
        .otherwise("")))


def _openings(vocabulary: DataFrame, least: int) -> DataFrame:
    """Each word once for each length m of the shorter word of a pair and half of its places."""
    def halves(m: Column) -> Column:
        middle = F.call_function("div", m, F.lit(2)).cast("int")
        return F.array(*[F.struct(m.alias("m"), low.alias("low"), high.alias("high"))
                         for low, high in ((F.lit(0), middle), (middle, m + 1))])

    size = F.length("word")
    return (vocabulary.select("word", "n", F.explode(F.concat(
        halves(size), F.when(size > least, halves(size - 1))
        .otherwise(F.array().cast("array<struct<m:int,low:int,high:int>>")))).alias("o"))
        .select("word", "n", "o.m", "o.low", "o.high"))


GROUP = ["m", "low", "high", "state"]


def _groups(words: DataFrame, letters: int) -> DataFrame:
    """Groups of at most so many letters; larger ones are dealt anew by halves of their places."""
    done = None
    while True:
        words = _dealt(words)
        large = (words.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("size"))
                 .where((F.col("size") > 1) & (F.col("high") - F.col("low") > 1)
                        & (F.col("size") * (F.col("high") - F.col("low") + 1) > letters))
                 .drop("size"))
        large = checkpointed(large)
        if large.isEmpty():
            return words if done is None else done.unionByName(words)
        small = words.join(large, GROUP, "left_anti")
        done = small if done is None else done.unionByName(small)
        middle = F.expr("(low + high) div 2").cast("int")
        words = (words.join(large, GROUP).select("word", "n", "m", F.explode(F.array(
            F.struct(F.col("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high"))))
            .alias("o")).select("word", "n", "m", "o.low", "o.high"))


def near_words(vocabulary: DataFrame, least: int = MIN_LETTERS,
               letters: int = GROUP_LETTERS) -> DataFrame:
    """(word, near, near_n): every pair of near words, both ways."""
    dealt = (_groups(_openings(vocabulary, least), letters)
             .repartition(*GROUP).sortWithinPartitions(*GROUP, "word")
             .select(*GROUP, "word", "n"))
    names = ["word", "near", "near_n"]

    def groups(batches):
        for batch in batches:
            yield from zip(zip(*(batch.column(i).to_pylist() for i in range(4))),
                           batch.column(4).to_pylist(), batch.column(5).to_pylist())

    def run(batches):
        rows: list = []

        def out():
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int64()))],
                names=names)
            rows.clear()
            return made

        for (m, low, high, _), members in groupby(groups(batches), key=lambda r: r[0]):
            counts = {word: n for _, word, n in members}
            if len(counts) < 2:
                continue
            for a, b in near_pairs(sorted(counts), m, low, high):
                rows += [(a, b, counts[b]), (b, a, counts[a])]
                if len(rows) >= PAIRS:
                    yield out()
        if rows:
            yield out()

    return map_arrow(dealt, run, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last word of the chain of forms, by pointer doubling."""
    chain = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = chain.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = checkpointed(moved)
        chain = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return chain


def variants(vocabulary: DataFrame, least: int = MIN_LETTERS, lead: float = LEAD,
             letters: int = GROUP_LETTERS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row (word, n) of the vocabulary."""
    vocabulary = checkpointed(vocabulary.select("word", "n"))
    best = near_words(vocabulary, least, letters).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form"))).alias("b"))
    found = vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("b.minus") >= lead * F.col("n"), F.col("b")).alias("b"))
    found = checkpointed(found.select("word", F.col("b.form").alias("form"), "n", "n_near",
                                      (-F.col("b.minus")).alias("form_n")))
    return found.join(roots(found.where("form is not null")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      damage: int | None = None, least_count: int = MIN_COUNT) -> DataFrame:
    """The variants of the words of all documents that occur ``least_count`` times or more."""
    counts = word_counts(docs, id_col, text_col, damage)
    return variants(counts.where(F.col("n") >= least_count))
