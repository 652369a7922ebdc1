"""Packing: exact coverage of every document's ids, padding, order, steps."""

import zlib

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lumenreg.llm import packing as K
from lumenreg.llm.queries import op9_packing
from tests.conftest import SF_SMALL

PATH = P.path("word_bpe_49k.json")


def power(n):
    return n & (n - 1) == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 700), max_size=60), st.sampled_from([1, 4, 16]))
def test_group_holds_every_token_once(lengths, least):
    sequences = K.pack_group(lengths, context=128, least=least, smallest=16)
    pieces = sorted(p for _, s in sequences for p in s)
    at = [0] * len(lengths)
    for doc, start, n in pieces:
        assert n > 0 and start == at[doc]
        at[doc] += n
    assert at == lengths
    for tier, s in sequences:
        total = sum(n for _, _, n in s)
        assert total <= tier <= 128 and power(tier)
        assert total == tier or tier == 128 and 128 - total < least


def test_rests_go_to_the_least_context_that_holds_them():
    """Each tier is packed at its own size, the longest tier first."""
    out = K.pack_tiers([(i, 0, n) for i, n in enumerate([100, 64, 50, 40, 33, 20, 9, 9])], 128, 4, 16)
    assert [(t, s[0][0]) for t, s in out if t == 128] == [(128, 0)]  # only the rest over 64 opens a long window
    for tier, s in out:
        opener = s[0][2]
        assert opener <= tier and (opener > tier // 2 or tier == 16)
        assert sum(n for _, _, n in s) == tier or (tier, s) == out[-1]
    tiers = [t for t, _ in out]
    assert tiers == sorted(tiers, reverse=True) and set(tiers) >= {128, 64}


def test_gaps_of_long_windows_are_filled_from_shorter_tiers():
    out = K.pack_tiers([(0, 0, 100), (1, 0, 20), (2, 0, 28), (3, 0, 30)], 128, 4, 16)
    assert out[0] == (128, [(0, 0, 100), (2, 0, 28)])  # the longest that fits
    cut = K.pack_tiers([(0, 0, 100), (1, 0, 60), (2, 0, 50)], 128, 4, 16)
    assert cut[0] == (128, [(0, 0, 100), (2, 0, 28)]) and cut[1] == (64, [(1, 0, 60), (2, 28, 4)])
    left = K.pack_tiers([(0, 0, 126), (1, 0, 60)], 128, 4, 16)
    assert left[0] == (128, [(0, 0, 126)])  # too small a gap for a cut in the longest tier only


def test_step_groups_are_even():
    sequences = [(2048, [(0, 0, 2048)])] * 40 + [(2048, [(0, 0, 128)] * 16)] * 40 + [(512, [(0, 0, 512)])] * 9
    steps = K.step_groups(sequences, 8)
    cost = np.zeros(12)
    for (_, s), g in zip(sequences, steps):
        cost[g] += sum(n * n for _, _, n in s)
    assert np.bincount(steps).tolist() == [8] * 10 + [5, 4] and cost[:10].max() < 1.1 * cost[:10].min()
    assert all({t for (t, _), g in zip(sequences, steps) if g == step} in ({2048}, {512}) for step in range(12))


def check(rows, texts):
    tokenizer = Tokenizer.from_file(PATH)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, found in by_doc.items():
        ids = np.array(tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids + [1],
                       "<u4")
        at = 0
        for r in sorted(found, key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:at].tobytes())
        assert at == len(ids)
    held = padded = 0
    for found in by_sequence.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        held, padded = held + at, padded + (at if power(at) else 2048)
    return 1 - held / padded


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in
             spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = op9_packing(spark, SF_SMALL).collect()
    assert check(rows, texts) < 0.0025
    assert len({r["tier"] for r in rows}) > 2
    assert all(r["tier"] == r["sequence_tokens"] or r["tier"] == 2048 for r in rows)


def test_words_of_many_scripts_and_marks(spark):
    texts = {1: "It's they'VE ÀÉ é ﬁ Σας x 　 東京", 2: "<|endoftext|> a<|startoftext|>b x<|endoftext|>! <|endoftext|",
             3: "İstanbul ΑΣ 12 3.4 \x1c\x85 !''s", 4: None, 5: "x" * 5000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1)
    rows = K.pack(docs, PATH, with_ids=True).collect()
    check(rows, texts)
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)


def test_small_groups(spark):
    texts = {i: "word " * (i % 37) for i in range(300)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    check(K.pack(docs, PATH, group_tokens=500).collect(), texts)
