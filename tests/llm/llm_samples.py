"""Rows that the tests share."""

import random
import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, score string, host string, row long"


def prose(seed, n, words=None):
    rng = random.Random(seed)
    words = words or "the of and to in is that for it was on are as with cat dog house tree river stone bread".split()
    return " ".join(rng.choice(words) for _ in range(n))


def document(i, text, lang="en", source="a"):
    """A row with further columns that carry names the operators use."""
    return (i, text, lang, source, None, "clash", "clash", "clash", 7)


def crc(value):
    return zlib.crc32(str(value).encode())
