"""BPE against the tiktoken library, and the round trip."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from lumenreg.llm import bpe
from lumenreg.llm.queries import op1_bpe
from tests.conftest import SF_SMALL

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(PATH, P.PATTERN)


TEXTS = ["", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \nb", "a\n b", "it's we'll  they've",
         "x" * 129, "ab" * 3000, "aaaa " * 50, "été déjà vu", "a  b", "a 　b c d",
         "\x1c \x1d x", "a \x85b c", "東京 は 夜", "𝔘𝔫𝔦 code 🙂🙂 x", "tab\tin side a word",
         "1234567890 12 3", "<|endoftext|> text", "\r\n\r\n x", "trailing newline\n", " lead in g"]


@pytest.mark.parametrize("text", TEXTS)
def test_ids_equal_library(encoder, library, text):
    raw = encoder.encode([text.encode()])[0]
    assert np.frombuffer(raw, "<u4").tolist() == library.encode_ordinary(text)
    assert encoder.decode(raw) == text.encode()


def test_random_texts(encoder, library):
    draw = random.Random(5)
    alphabet = "abcdeABC  \n\t'.,!1230éßñ 東🙂"
    texts = ["".join(draw.choices(alphabet, k=draw.randrange(1, 120))) for _ in range(400)]
    for text, raw in zip(texts, encoder.encode([t.encode() for t in texts])):
        assert np.frombuffer(raw, "<u4").tolist() == library.encode_ordinary(text), text


def test_matrix_and_heap_merge_alike(encoder):
    draw = random.Random(6)
    pieces = [bytes(draw.choices(b"etaoin shr", k=n)) for n in (2, 5, 17, 64, 128) for _ in range(40)]
    by_matrix = encoder.ranks.encode_pieces(pieces)
    assert by_matrix == [encoder.ranks.merge_long(p).astype("<u4").tobytes() for p in pieces]


def test_memo_limit_changes_nothing(encoder, library):
    small = bpe.Encoder(PATH, P.PATTERN)
    small.units.limit = small.pieces.limit = 3
    for text in ("one two three four five six", "seven two nine one"):
        assert np.frombuffer(small.encode([text.encode()])[0], "<u4").tolist() == \
            library.encode_ordinary(text)


def test_query(spark, library):
    texts = {r["doc_id"]: r["text"] or "" for r in
             spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    out = op1_bpe(spark, SF_SMALL).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = np.array(library.encode_ordinary(texts[r["doc_id"]]), "<u4").tobytes()
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids) // 4, hashlib.sha256(ids).hexdigest(),
            hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest())


def test_words_are_matched_together(library):
    """One call of the pattern for a set of words, also with white space in or around them."""
    own = bpe.Encoder(PATH, P.PATTERN)
    words = ["it's", "a\tb", "a\xa0b", "x1.5", "", "\ta", "b\n", "été", "東京は", "1\n\n2", "--", "it's"]
    calls, pattern = [], own.pattern

    class Counted:
        def findall(self, text):
            calls.append(text)
            return pattern.findall(text)

    own.pattern = Counted()
    got = own.encode_units([w.encode() for w in words])
    assert len(calls) == 1
    for word, ids in zip(words, got):
        if word and word == word.strip():
            assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(" " + word)
        else:
            assert ids is None
