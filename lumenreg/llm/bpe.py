"""Byte-level BPE: encode whole texts by a rank file, and decode ids back to bytes.

The pieces that the pattern finds are encoded on their own. New pieces of a
slice are grouped by byte length and laid out as padded id matrices; in each
round every row merges its leftmost pair of minimum rank, and rows without a
mergeable pair leave the matrix. Pair ranks come from an open-addressing hash
table. A piece beyond the widest bucket (a run of hundreds of letters) goes
through a heap of pairs instead, which merges in the same order.

A text is cut at single spaces between non-space characters: no piece of the
pattern spans such a cut, so a unit (space and word) always has the same ids
and is encoded once while the memo holds it. A text with other runs of white
space around a space is matched as a whole.

Null and empty texts have no ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField

from lumenreg.llm.batches import Memo, with_text_columns

#: Matrix widths; longer pieces take the heap.
WIDTHS = (4, 6, 8, 12, 16, 24, 32, 64, 128)
NONE = np.int64(1 << 40)
#: White space as the rank files' library reads ``\s`` (Unicode White_Space).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class PairTable:
    """Hash table (left id, right id) -> merged id, with vectorised look-up."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(8, int(4 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.values = np.full(size, NONE, np.int64)
        left, slot = np.arange(len(keys)), self.slot(keys)
        while len(left):
            free = self.keys[slot] == -1
            _, first = np.unique(slot, return_index=True)
            put = np.zeros(len(left), bool)
            put[first] = True
            put &= free
            self.keys[slot[put]] = keys[left[put]]
            self.values[slot[put]] = values[left[put]]
            left, slot = left[~put], (slot[~put] + 1) & (size - 1)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids of the pairs, ``NONE`` where a pair doesn't merge or is padding."""
        keys = (left << 20) | right
        slot = self.slot(keys)
        found = np.where(self.keys[slot] == keys, self.values[slot], NONE)
        open_ = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != -1))
        at = slot[open_]
        while len(open_):
            at = (at + 1) & (len(self.keys) - 1)
            there, want = self.keys[at], keys[open_]
            hit = there == want
            found[open_[hit]] = self.values[at[hit]]
            more = ~hit & (there != -1)
            open_, at = open_[more], at[more]
        found[(left < 0) | (right < 0)] = NONE
        return found


class Ranks:
    """A rank file: token bytes by id, and its merges."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        by_bytes = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = [b""] * (max(by_bytes.values()) + 1)
        for token, rank in by_bytes.items():
            self.tokens[rank] = token
        self.byte_ids = np.array([by_bytes[bytes([b])] for b in range(256)], np.int64)
        keys, values = [], []
        for token, rank in by_bytes.items():
            for cut in range(1, len(token)):
                left, right = by_bytes.get(token[:cut]), by_bytes.get(token[cut:])
                if left is not None and right is not None:
                    keys.append((left << 20) | right)
                    values.append(rank)
        self.table = PairTable(np.array(keys, np.int64), np.array(values, np.int64))
        self.by_pair = dict(zip(keys, values))

    def merge_rows(self, ids: np.ndarray) -> list[bytes]:
        """Final ids of every row of a padded (-1) id matrix, as unsigned 32-bit integers."""
        out: list = [None] * len(ids)
        rows = np.arange(len(ids))
        ranks = self.pair_ranks(ids)
        while len(rows):
            if ids.shape[1] < 2:
                live = np.zeros(len(rows), bool)
            else:
                at = ranks.argmin(axis=1)  # the first of equal ranks is the leftmost
                best = ranks[np.arange(len(rows)), at]
                live = best < NONE
            done = ids[~live]
            held = done >= 0
            flat, ends = done[held].astype("<u4").tobytes(), (4 * held.sum(axis=1).cumsum()).tolist()
            for r, begin, end in zip(rows[~live].tolist(), [0, *ends], ends):
                out[r] = flat[begin:end]
            if not live.any():
                break
            if not live.all():
                rows, ids, ranks, at, best = (x[live] for x in (rows, ids, ranks, at, best))
            here = np.arange(len(rows))
            ids[here, at] = best
            column, cut = np.arange(ids.shape[1] - 1)[None, :], at[:, None]
            ids = np.where(column <= cut, ids[:, :-1], ids[:, 1:])
            if ids.shape[1] < 2:
                continue
            ranks = np.where(column[:, :-1] < cut, ranks[:, :-1], ranks[:, 1:])
            right = at < ids.shape[1] - 1
            ranks[here[right], at[right]] = self.table.ranks(
                ids[here[right], at[right]], ids[here[right], at[right] + 1])
            left = at > 0
            ranks[here[left], at[left] - 1] = self.table.ranks(
                ids[here[left], at[left] - 1], ids[here[left], at[left]])
        return out

    def pair_ranks(self, ids: np.ndarray) -> np.ndarray:
        shape = (len(ids), ids.shape[1] - 1)
        return self.table.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(shape)

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges by a heap of (rank, position), for a long piece."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        rank = lambda i, j: self.by_pair.get((ids[i] << 20) | ids[j])
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1)
                if (r := rank(i, i + 1)) is not None]
        heapq.heapify(heap)
        gone = [False] * len(ids)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= len(ids) or ids[i] != a or ids[j] != b:
                continue
            ids[i], gone[j], after[i] = r, True, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
                if (n := rank(i, after[i])) is not None:
                    heapq.heappush(heap, (n, i, ids[i], ids[after[i]]))
            if before[i] >= 0 and (n := rank(before[i], i)) is not None:
                heapq.heappush(heap, (n, before[i], ids[before[i]], ids[i]))
        return np.array([t for t, dead in zip(ids, gone) if not dead], np.int64)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        out: list = [b""] * len(pieces)
        sizes = np.array([len(p) for p in pieces])
        low = 0
        for width in WIDTHS:
            here = np.flatnonzero((sizes > low) & (sizes <= width))
            low = width
            if not len(here):
                continue
            ids = np.full((len(here), width), -1, np.int64)
            filled = np.arange(width)[None, :] < sizes[here][:, None]
            ids[filled] = self.byte_ids[np.frombuffer(b"".join(pieces[i] for i in here), np.uint8)]
            for i, found in zip(here, self.merge_rows(ids)):
                out[i] = found
        for i in np.flatnonzero(sizes > WIDTHS[-1]):
            out[i] = self.merge_long(pieces[i]).astype("<u4").tobytes()
        return out


@lru_cache(maxsize=2)
def load_ranks(path: str) -> Ranks:
    return Ranks(path)


class Encoder:
    """Encodes and decodes texts by a rank file and a splitting pattern."""

    def __init__(self, path: str, pattern: str):
        self.ranks = load_ranks(path)
        self.pattern = regex.compile(pattern.replace(r"[^\s", rf"[^{SPACE}").replace(
            r"\S", rf"[^{SPACE}]").replace(r"\s", rf"[{SPACE}]"))
        self.pieces = Memo(self.ranks.encode_pieces, 100_000)
        self.units = Memo(self.encode_units)

    def split(self, text: str) -> list[bytes]:
        return [p.encode() for p in self.pattern.findall(text)]

    def join(self, pieces: list[bytes]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, pieces))

    def encode_units(self, words: list[bytes]) -> list[bytes | None]:
        """Ids of a space and each word; None where a word doesn't stand alone."""
        texts = [w.decode() for w in words]
        # str.isspace knows all of SPACE and a little more, which only costs time
        alone = [bool(t) and not t[0].isspace() and not t[-1].isspace() for t in texts]
        # the words are matched together: no piece spans their cuts, so one begins at each of
        # them, with the only spaces that there are
        pieces = self.split("".join(" " + t for t, a in zip(texts, alone) if a))
        self.pieces.add(set(pieces))
        ids = list(map(self.pieces.__getitem__, pieces))
        begins = [i for i, p in enumerate(pieces) if p[0] == 32]
        units = (ids[a] if b - a == 1 else b"".join(ids[a:b])
                 for a, b in zip(begins, [*begins[1:], len(pieces)]))
        return [next(units) if a else None for a in alone]

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        words = [(t or b"").split(b" ") for t in texts]
        inner = set()
        for w in words:
            inner.update(w[1:-1])
        self.units.add(inner)
        parts = []  # of each text: pieces, ids, pieces
        for text, w in zip(texts, words):
            middle = None
            if len(w) > 2 and w[0] and not w[0].decode()[-1].isspace() and (
                    w[-1] and not w[-1].decode()[0].isspace()):
                try:
                    middle = b"".join(map(self.units.__getitem__, w[1:-1]))
                except TypeError:  # a None: white space beside a space
                    pass
            if middle is None:
                parts.append((self.split((text or b"").decode()), b"", []))
            else:
                parts.append((self.split(w[0].decode()), middle, self.split(" " + w[-1].decode())))
        self.pieces.add({p for first, _, last in parts for p in (*first, *last)})
        return [self.join(first) + middle + self.join(last) for first, middle, last in parts]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.ranks.tokens.__getitem__, memoryview(ids).cast("I")))


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode and decode every text: token count and digests of ids and decoded bytes.

    ``with_ids`` adds the ids (``ids``, little-endian binary) and ``decoded``. Null and
    empty texts have no ids; repeated rows each give their row.
    """
    fields = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()),
              StructField("decoded_sha256", StringType())]
    if with_ids:
        from pyspark.sql.types import BinaryType

        fields += [StructField("ids", BinaryType()), StructField("decoded", BinaryType())]

    def make():
        encoder = Encoder(path, pattern)

        def step(texts):
            ids = encoder.encode(texts)
            decoded = [encoder.decode(x) for x in ids]
            digest = lambda items: [hashlib.sha256(x).hexdigest() for x in items]
            out = [[len(x) // 4 for x in ids], digest(ids), digest(decoded)]
            return out + [ids, decoded] if with_ids else out
        return step

    return with_text_columns(docs, [id_col], text_col, make, fields)
