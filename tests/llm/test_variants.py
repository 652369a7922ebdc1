import random
import zlib
from collections import Counter

import pytest

from lumenreg.llm import variants as V
from tests.llm.cases import no_documents, odd_documents, odd_rows


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(counts):
    """{word: (form, root, n, n_near, form_n)} by comparing all pairs."""
    out = {}
    for w, n in counts.items():
        found = [(-m, v) for v, m in counts.items() if v != w and near(w, v)]
        best = min(found, default=None)
        form = best[1] if best and -best[0] >= 2 * n else None
        out[w] = [form, w, n, len(found), counts[form] if form else None]
    for w, row in out.items():
        while out[row[1]][0]:
            row[1] = out[row[1]][0]
    return {w: tuple(r) for w, r in out.items()}


def table(df):
    return {r["word"]: tuple(r[c] for c in ("form", "root", "n", "n_near", "form_n")) for r in df.collect()}


def test_acceptor_is_minimal_and_exact():
    words = sorted({"".join(random.Random(i).choices("ab", k=6)) for i in range(40)})
    found = V.Acceptor(words)
    dead = set()
    assert sorted(V.agreeing(found, 0, found, 0, 6, dead)) == words
    # as many live states as there are sets of endings
    ends = {tuple(sorted(w[k:] for w in words if w[:k] == p)) for k in range(7)
            for p in {w[:k] for w in words}}
    live, todo = set(), [0]
    while todo:
        state = todo.pop()
        if state not in live:
            live.add(state)
            todo += found.arcs[state].values()
    assert len(live) == len(ends)


@pytest.mark.parametrize("alphabet", ["ab", "abcé", "abcdefghij"])
def test_every_pair_comes_from_one_range(alphabet):
    r = random.Random(len(alphabet))
    for _ in range(60):
        words = sorted({"".join(r.choices(alphabet, k=r.randint(1, 7))) for _ in range(r.randint(2, 60))})
        got = []
        for m in range(1, 9):
            cuts = sorted({0, m + 1, r.randint(0, m + 1), r.randint(0, m + 1)})
            for low, high in zip(cuts, cuts[1:]):
                groups = {}
                for w in words:
                    if len(w) in (m, m + 1):
                        groups.setdefault((w[:low], w[len(w) - max(m - high, 0):] if m > high else ""),
                                          []).append(w)
                for members in groups.values():
                    if len(members) > 1:
                        got += [tuple(sorted(p)) for p in V.near_pairs(members, m, low, high)]
        assert sorted(got) == sorted((a, b) for i, a in enumerate(words) for b in words[i + 1:] if near(a, b))


def test_groups_of_hashes_that_met():
    """Words of different prefixes and suffixes in one group give no false and no double pairs."""
    words = sorted(["abcde", "abxde", "zbcde", "abcdef", "qqqqq", "qqqqr"])
    got = [tuple(sorted(p)) for lo, hi in ((0, 2), (2, 6)) for p in V.near_pairs(words, 5, lo, hi)]
    assert sorted(got) == [("abcde", "abcdef"), ("abcde", "abxde"), ("abcde", "zbcde"), ("qqqqq", "qqqqr")]


@pytest.mark.parametrize("letters", [V.GROUP_LETTERS, 12])
def test_variants_equal_all_pairs(spark, letters):
    """With the production bound, and with one under which groups are dealt anew again and again."""
    r = random.Random(3)
    counts = {}
    for _ in range(400):
        w = "".join(r.choices("abç", k=r.randint(5, 8)))
        counts[w] = 3 * 2 ** r.randint(0, 9)
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert table(V.variants(vocabulary, letters=letters)) == plain(counts)


def test_chains_of_forms(spark):
    chain = {"aaaaaaaa"[:8 - i] + "b" * i: 3 * 2 ** i for i in range(9)}
    got = table(V.variants(spark.createDataFrame(list(chain.items()), "word string, n long")))
    assert got == plain(chain) and {r[1] for r in got.values()} == {"bbbbbbbb"}


def test_words_and_damage(spark):
    docs = [(i, "Étude HOUSES houses ÉTUDE naïveté x×y " * 3 + str(i)) for i in range(300)]
    docs += [(None, "houses"), (7, None), (8, ""), (9, "123 東京"), (0, docs[0][1])]
    counts = Counter()
    for i, text in docs:
        for run in V.RUN.findall(text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 5:
                counts[w] += 1
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert {r["word"]: r["n"] for r in V.word_counts(df, damage=97).collect()} == counts
    assert table(V.spelling_variants(df, damage=97)) == plain({w: n for w, n in counts.items() if n >= 3})


def test_very_long_words(spark):
    long = "ab" * 150_000
    words = [(long, 100), (long[:70_000] + "c" + long[70_000:], 10), (long[:-1] + "d", 10),
             (long[1:], 3), ("abcde", 5)]
    got = {(len(r["word"]), r["word"][-1]): (r["n_near"], r["form_n"])
           for r in V.variants(spark.createDataFrame(words, "word string, n long")).collect()}
    assert got == {(300_000, "b"): (3, None), (300_001, "b"): (1, 100), (300_000, "d"): (1, 100),
                   (299_999, "b"): (1, 100), (5, "e"): (0, None)}


def test_odd_and_empty_tables(spark):
    counts = Counter()
    for row in odd_rows():
        counts.update(V.lower(w) for w in V.RUN.findall(row[1] or "") if len(w) >= 5)
    assert table(V.spelling_variants(odd_documents(spark))) == plain({w: n for w, n in counts.items() if n >= 3})
    assert V.spelling_variants(no_documents(spark), damage=97).collect() == []
