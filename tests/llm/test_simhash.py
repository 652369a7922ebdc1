"""SimHash near-duplicates: fingerprints, Golay keys, components, against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from lumenreg.llm import simhash as S
from lumenreg.llm.components import components
from lumenreg.llm.queries import op6_simhash
from tests.conftest import SF_SMALL
from tests.llm.cases import odd_documents, odd_rows


def plain_print(text, shingle=3):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = ([" ".join(words[k:k + shingle]) for k in range(len(words) - shingle + 1)]
             or ([" ".join(words)] if words else []))
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, bits=2):
    """component id of each (doc_id, fingerprint) row by a union over all pairs."""
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= bits:
                parent[find(i)] = find(j)
    low = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            low[find(i)] = min(low.get(find(i), doc_id), doc_id)
    return [low.get(find(i)) for i in range(len(rows))]


def test_golay_decodes_three_errors():
    draw = random.Random(1)
    codewords = [w for w in range(0, 1 << 23, 997) if S.golay()[0][w] == 0]
    assert S.golay()[0].min() == 0 and (S.golay()[0] == 0).sum() == 1 << 12
    for word in codewords + [0]:
        for errors in range(4):
            noisy = word
            for bit in draw.sample(range(23), errors):
                noisy ^= 1 << bit
            assert S.nearest(np.array([noisy]))[0] == word >> 11


def test_keys_meet_for_all_pairs_within_two_bits():
    base = np.random.default_rng(2).integers(0, 1 << 63, 3, np.uint64)
    for x in base:
        masks = [0] + [1 << i for i in range(64)] + [1 << i | 1 << j for i in range(64)
                                                     for j in range(i)]
        other = x ^ np.array(masks, np.uint64)
        stored, _ = S.golay_keys(other)
        _, probed = S.golay_keys(np.array([x]))
        assert np.isin(stored, probed.ravel()).any(axis=1).all()


def cluster(n, seed, flips):
    """Fingerprints that wander from one another by a few bits, and lone ones."""
    draw, out = random.Random(seed), [random.Random(seed).getrandbits(64)]
    for _ in range(n):
        x = draw.choice(out)
        for bit in draw.sample(range(64), draw.randrange(1, flips + 1)):
            x ^= 1 << bit
        out.append(x)
    return list(dict.fromkeys(out + [draw.getrandbits(64) for _ in range(20)]))


@pytest.mark.parametrize("bits", [0, 1, 2])
@pytest.mark.parametrize("hot_key", [64, 2])
def test_links_against_all_pairs(spark, hot_key, bits):
    prints = cluster(150, 4, 3)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    roots = {r["node"]: r["root"] for r in
             components(S.links(nodes, bits, hot_key)).collect()}
    want = plain_components(list(zip(signed, prints)), bits)
    assert [roots.get(x, x) for x in signed] == want


def test_more_bits_are_refused(spark):
    with pytest.raises(ValueError):
        S.links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert {r["root"] for r in components(chain).collect()} == {0}


def test_odd_rows(spark):
    rows = [(r[0], plain_print(r[1])) for r in odd_rows()]
    want = sorted(((r[0] is None, r[0] or 0, f"{r[1]:016x}", c or -1)
                   for r, c in zip(rows, plain_components(rows))))
    out = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["fingerprint"], r["component_id"] or -1)
                  for r in S.near_duplicates(odd_documents(spark)).collect()))
    assert out == want


def test_keep_one(spark):
    rows = [(r[0], plain_print(r[1])) for r in odd_rows()]
    groups = {}
    for (doc_id, print_), root in zip(rows, plain_components([(i, r[1]) for i, r in
                                                              enumerate(rows)])):
        groups.setdefault(root, []).append(doc_id)
    # a group of null ids alone keeps one of them
    want = [min((x for x in g if x is not None), default=-1) for g in groups.values()]
    kept = S.keep_one(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == sorted(want)


def test_query(spark):
    texts = [(r["doc_id"], r["text"]) for r in
             spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows = [(i, plain_print(t)) for i, t in texts]
    want = {r[0]: (f"{r[1]:016x}", c) for r, c in zip(rows, plain_components(rows))}
    out = {r["doc_id"]: (r["fingerprint"], r["component_id"])
           for r in op6_simhash(spark, SF_SMALL).collect()}
    assert out == want
