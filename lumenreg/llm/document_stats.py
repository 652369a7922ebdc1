"""Exact statistics of a whole text: words, symbols, repeated lines and windows."""

from __future__ import annotations

import numpy as np

#: Bytes of ``#*$%&|<>``.
SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
SPACES = np.array([0x20, *range(0x09, 0x0E)])
WINDOW = 5

#: What ``statistics`` returns for a text, in order.
NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
         "n_upper", "n_digits", "n_shouts", "n_distinct", "n_marks", "n_wide", "n_short")
EMPTY = (0,) * len(NAMES)


def repeated_words(ids: np.ndarray, kinds: int, window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more; ``ids`` number the words."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    if kinds ** window < 1 << 62:
        keys = ids[:n].copy()
        for k in range(1, window):
            keys = keys * kinds + ids[k:n + k]
    else:  # number the pairs, then pairs of pairs, so that keys stay exact
        _, pairs = np.unique(ids[:-1] * kinds + ids[1:], return_inverse=True)
        base = int(pairs.max()) + 1
        _, fours = np.unique(pairs[:-2] * base + pairs[2:], return_inverse=True)
        keys = fours[:n] * kinds + ids[window - 1:]
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    twice = np.unique(twice)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    starts = np.flatnonzero(twice[at] == keys)
    change = np.zeros(len(ids) + 1, np.int64)
    change[starts] += 1
    change[starts + window] -= 1
    return int((np.cumsum(change) > 0).sum())


def statistics(raw: bytes | None) -> tuple:
    """The values of ``NAMES`` for a text (null: empty); all zero without a word."""
    words = (raw or b"").split()
    if not words:
        return EMPTY
    number: dict = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    points = len(raw) - int(counts[0x80:0xC0].sum())
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return (len(words), points - int(counts[SPACES].sum()), int(counts[SYMBOLS].sum()),
            len(lines) - len(set(lines)), repeated_words(ids, len(number)), len(lines),
            int(counts[65:91].sum()), int(counts[48:58].sum()), int(counts[33]), len(number),
            int(counts[[44, 46, 58, 59, 63]].sum()), int(counts[0xC0:].sum()),
            sum(1 for w in number if len(w) <= 3))
