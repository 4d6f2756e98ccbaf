"""Words as every operator here counts them: runs of anything but ASCII white space."""

from __future__ import annotations

import sys
from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The six white-space characters that end a word, and the patterns built from them.
WHITE_SPACE = " \t\n\x0b\x0c\r"
GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """The words of a text in order, as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def word_count(text: Column) -> Column:
    """Number of words, as a long; 0 for null."""
    return F.size(words_of(text)).cast("long")


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of a key written as text, modulo ``modulus``; null keys count as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def per_process(name: str, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, kept as long as the Python process lives.

    Task functions travel by value, so that their module's variables last for one task only; a worker
    process serves many. Only for what depends on nothing but ``name``.
    """
    held = vars(sys).setdefault("_cohortlens_llm", {})
    if name not in held:
        held[name] = make()
    return held[name]


def objects(frame: pd.DataFrame) -> pd.DataFrame:
    """``frame`` with its text columns as Python objects, which Arrow takes in one piece."""
    return frame.astype({c: object for c, kind in frame.dtypes.items() if isinstance(kind, pd.StringDtype)})
