"""Packing: documents as token ids in sequences of at most 2048.

Every scan partition packs its documents in groups of bounded token count,
without a shuffle. In a group:

1. a document's whole windows of ``context`` tokens are sequences of their own;
2. each rest is routed to the tier of the least context size that holds it: 2048, 1024,
   512 and so on down to ``smallest``, which takes all shorter ones;
3. each tier is packed at its own size, the longest first: its longest rest opens a
   sequence of the tier's size, and the gap is filled with the longest rests that fit,
   from the tier itself or a shorter one; where none fits, a rest is cut to fill it. Gaps
   below ``least`` tokens are left in sequences of ``context`` only, as others would
   be padded to it if they weren't full;
4. what is left in the last, partly filled sequence of a tier is dealt to sequences of
   powers of two, the shorter context sizes, which need no padding;
5. a tier's sequences are dealt to step groups in turn and back (a snake) by falling
   attention cost (sum of squared piece lengths), so that the groups of a step
   cost about the same; a step has sequences of one tier.

Null texts are empty; an empty text is one piece, the end id. Repeated rows and
equal doc_ids are packed as they are, each row on its own.
"""

from __future__ import annotations

import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from lumenreg.llm.batches import map_arrow, slices

CONTEXT = 2048
#: Gaps below this many tokens are padded, not filled by a cut.
LEAST = 32
#: Tokens of a packing group: bounds a task's memory.
GROUP_TOKENS = 4_000_000
STEP_SEQUENCES = 8
#: The shortest context size of a tier.
SMALLEST = 128
END_ID = 1


@lru_cache(maxsize=1)
def load_tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)  # strings of special tokens in a text are these tokens


#: Latin letters without marks to compose, then ASCII marks: two pieces of the pre-tokenizer.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\\[-`{-~]*)")
MEMO_WORDS = 400_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Visible Latin-1 characters stand for themselves, the others for those from
    U+0100 on, in order.
    """
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


class WordIds(dict):
    """Word (between ASCII white space) -> its ids as little-endian bytes, when asked for.

    The tokenizer drops white space and no token spans it, so a text's ids are
    those of its words in order. A word of Latin letters is one piece, in lower
    case, and marks after it another, so these go to the tokenizer's merges
    directly; other words go through the whole tokenizer. At ``MEMO_WORDS`` words the memo
    starts anew; ids never depend on what it holds.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = load_tokenizer(path)
        self.merge = self.tokenizer.model.tokenize
        self.letters = byte_letters()
        self.pieces: dict[str, bytes] = {}

    def piece(self, text: str) -> bytes:
        found = self.pieces.get(text)
        if found is None:
            letters = text if text.isascii() else "".join([self.letters[b] for b in text.encode()])
            found = array("I", [t.id for t in self.merge(letters)]).tobytes()
            if len(self.pieces) >= MEMO_WORDS:
                self.pieces.clear()
            self.pieces[text] = found
        return found

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        plain = PLAIN.fullmatch(text)
        if plain:
            found = self.piece(plain[1].lower())
            if plain[2]:
                found += self.piece(plain[2])
        else:
            found = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = found
        return found


def pack_tiers(rests: list[tuple[int, int, int]], context: int = CONTEXT, least: int = LEAST,
               smallest: int = SMALLEST) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """(tier, pieces) of sequences; ``rests`` (document, start, length) are shorter than ``context``."""
    held: list[list] = [[] for _ in range(context)]  # by length: the tiers, finely
    present = 0  # bit n: some rest of length n is left

    def take(n: int, want: int) -> tuple[int, int, int]:
        """``want`` tokens of a rest of length n; what is cut off goes to its own tier."""
        nonlocal present
        doc, start = held[n].pop()
        if not held[n]:
            present &= ~(1 << n)
        if want < n:
            held[n - want].append((doc, start + want))
            present |= 1 << (n - want)
        return doc, start, want

    for doc, start, n in rests:
        held[n].append((doc, start))
        present |= 1 << n
    out, tier = [], context
    while present:
        longest = present.bit_length() - 1
        while tier > smallest and longest <= tier // 2:
            tier //= 2
        window, gap = [take(longest, longest)], tier - longest
        while present and gap:
            fit = (present & ((1 << (gap + 1)) - 1)).bit_length() - 1
            if fit > 0:
                n = want = fit
            elif gap >= least or tier < context:  # none fits: cut the shortest of the longer ones
                above = present >> (gap + 1)
                n, want = gap + 1 + ((above & -above).bit_length() - 1), gap
            else:
                break
            window.append(take(n, want))
            gap -= want
        out.append((tier, window))
    return out


def deal_powers(window: list[tuple[int, int, int]], total: int) -> list[list]:
    """The pieces of a partly filled window as sequences of powers of two in length."""
    out, room, size = [], 0, 1 << total.bit_length()
    for doc, start, n in window:
        while n:
            while not room:
                size >>= 1
                if total & size:
                    out.append([])
                    room = size
            take = min(n, room)
            out[-1].append((doc, start, take))
            start, n, room = start + take, n - take, room - take
    return out


def pack_group(lengths: list[int], context: int = CONTEXT, least: int = LEAST,
               smallest: int = SMALLEST) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences (tier, pieces (document, start, length)) that hold every token once."""
    sequences, rests = [], []
    for doc, n in enumerate(lengths):
        whole = n - n % context
        sequences += [(context, [(doc, start, context)]) for start in range(0, whole, context)]
        if n > whole:
            rests.append((doc, whole, n - whole))
    for tier, window in pack_tiers(rests, context, least, min(smallest, context)):
        total = sum(n for _, _, n in window)
        if total == tier or tier == context and context - total < least:
            sequences.append((tier, window))
        else:
            sequences += [(sum(n for _, _, n in part), part) for part in deal_powers(window, total)]
    return sequences


def step_groups(sequences: list[tuple[int, list]], per_step: int = STEP_SEQUENCES) -> list[int]:
    """A step-group number for each sequence: of one tier, and of even attention cost."""
    out, first = [0] * len(sequences), 0
    for tier in sorted({t for t, _ in sequences}, reverse=True):
        order = sorted((i for i, (t, _) in enumerate(sequences) if t == tier),
                       key=lambda i: (-sum(n * n for _, _, n in sequences[i][1]), i))
        groups = -(-len(order) // per_step)
        for rank, i in enumerate(order):
            lap, at = divmod(rank, groups)
            out[i] = first + (at if lap % 2 == 0 else groups - 1 - at)
        first += groups
    return out


OUT_COLUMNS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
               "sequence_tokens", "tier", "step_group"]


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         context: int = CONTEXT, least: int = LEAST, group_tokens: int = GROUP_TOKENS,
         with_ids: bool = False) -> DataFrame:
    """One row per piece; ``with_ids`` adds the piece's token ids (little-endian binary).

    ``sequence_id`` and ``step_group`` carry the partition number in their high
    bits, so they are unique over the table and the same when a task is rerun.
    """
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    names = OUT_COLUMNS + ["ids"] * with_ids
    schema = StructType([narrow.schema["doc_id"]] + [StructField(c, LongType()) for c in OUT_COLUMNS])
    if with_ids:
        schema = schema.add("ids", "binary")
    arrow = to_arrow_schema(schema)

    def flush(keys, buffers, base, group_base):
        sequences = pack_group([len(b) // 4 for b in buffers], context, least)
        steps = step_groups(sequences)
        columns = {c: [] for c in ["doc_id", *names]}
        for number, ((tier, sequence), step) in enumerate(zip(sequences, steps)):
            offset, total = 0, sum(n for _, _, n in sequence)
            for doc, start, n in sequence:
                piece = memoryview(buffers[doc])[4 * start:4 * (start + n)]
                row = [keys[doc], start, n, zlib.crc32(piece), len(buffers[doc]) // 4,
                       base + number, offset, total, tier, group_base + step]
                if with_ids:
                    row.append(bytes(piece))
                for c, v in zip(columns.values(), row):
                    c.append(v)
                offset += n
        step_count = 1 + max(steps, default=-1)
        return (pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow],
                                           schema=arrow), len(sequences), step_count)

    def run(batches):
        memo = WordIds(tokenizer_path)
        end = np.array([END_ID], "<u4").tobytes()
        base = group_base = TaskContext.get().partitionId() << 36
        keys, buffers, held = [], [], 0
        for batch in batches:
            for start, n in slices(batch, batch.column(1)):
                part = batch.slice(start, n)
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    keys.append(key)
                    buffers.append(b"".join(map(memo.__getitem__, (text or b"").split())) + end)
                    held += len(buffers[-1]) // 4
                    if held >= group_tokens:
                        out, used, steps = flush(keys, buffers, base, group_base)
                        yield out
                        base, group_base = base + used, group_base + steps
                        keys, buffers, held = [], [], 0
        if keys:
            yield flush(keys, buffers, base, group_base)[0]

    return map_arrow(narrow, run, schema)
