"""Features of whole texts that the classifiers share, computed in numpy a text at a time."""

from __future__ import annotations

import re

import numpy as np

from .langid import LAST_LETTER, letters, sliced
from .text import per_process

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")

SHAPE = (
    "log_words",
    "mean_word_length",
    "symbols_per_word",
    "exclaims_per_word",
    "upper_share",
    "digit_share",
    "other_share",
    "distinct_share",
    "adjacent_repeats",
    "repeated_lines",
    "lines_per_word",
    "lone_marks",
)

_SYMBOLS = np.frombuffer(b"#*$%&|<>", dtype=np.uint8)

def _kinds() -> np.ndarray:
    """Kind of each code point: 0 lower-case or uncased letter, 1 upper case, 2 digit, 3 white space, 4 symbol, 5 '!', 6 other."""
    table = np.full(0x110000, 6, dtype=np.uint8)
    characters = [chr(point) for point in range(LAST_LETTER)]
    for kind, test in ((0, str.isalpha), (1, str.isupper), (2, str.isdigit), (3, str.isspace)):
        table[:LAST_LETTER][np.fromiter(map(test, characters), dtype=bool, count=LAST_LETTER)] = kind
    table[_SYMBOLS] = 4
    table[ord("!")] = 5
    return table


def shape(text: str | None) -> np.ndarray:
    """The features named in ``SHAPE``; all zero for a text without words."""
    result = np.zeros(len(SHAPE))
    words = _WORDS.findall(text or "")
    n = len(words)
    if not n:
        return result
    kinds = per_process("kinds", _kinds)
    counts = np.zeros(7, dtype=np.int64)
    for part in sliced(text):
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        counts += np.bincount(kinds[points], minlength=7)
    written = max(1, int(counts.sum() - counts[3]))
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    distinct = len(set(words))
    result[:] = (
        np.log1p(n),
        sum(map(len, words)) / n,
        counts[4] / n,
        counts[5] / n,
        counts[1] / written,
        counts[2] / written,
        counts[6] / written,
        # Longer texts repeat more of their words; against this power of their length prose stays level.
        distinct / n**0.85,
        sum(map(str.__eq__, words, words[1:])) / n,
        (len(lines) - len(set(lines))) / max(1, len(lines)),
        len(lines) / n,
        words.count("|") / n,
    )
    return result


def buckets_of(text: str | None, low: int, high: int, size: int) -> list[np.ndarray]:
    """Buckets of the word beginnings of ``low`` to ``high`` letters, shorter words as a whole, their ends marked."""
    found = []
    shift = np.uint64(64 - (size.bit_length() - 1))
    for part in sliced(text or ""):
        code = letters(part).astype(np.uint64)
        at = np.flatnonzero(code[:-1] == 32)
        hashed = np.zeros(len(at), dtype=np.uint64)
        for k in range(1, high + 1):
            character = code[at + k]
            hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + (character + np.uint64(k)) * np.uint64(0xD6E8FEB86659FD93)
            mixed = (hashed ^ (hashed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            ended = character == 32
            found.append((mixed[ended | (k >= low)] >> shift).astype(np.int64))
            at, hashed = at[~ended], hashed[~ended]
    return found
