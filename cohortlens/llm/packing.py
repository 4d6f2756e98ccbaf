"""Pattern packing of documents into fixed-length sequences by non-negative least squares.

``pieces`` turns every document into token pieces: its ids and one end id; documents beyond ``capacity`` are cut into
pieces of exactly that length, the first one takes the remainder. ``plan`` works on the histogram of piece
lengths alone: it enumerates patterns of two and three lengths that fill a sequence exactly, fits how
often to repeat each to the histogram by non-negative least squares, rounds the repeats down to
what is available, and packs what the patterns leave by best fit, longest first. ``pack`` then hands every piece its place.

How it scales. Only the histogram reaches the driver, at most ``capacity`` numbers; the plan's size
depends on ``capacity`` too, not on the number of documents, since equal sequences are one entry with a count.
Pieces are numbered within their length without gathering a length in one task: each task numbers its own pieces and
a running sum of the tasks' counts gives the start of each. The n-th piece of a length then finds its
sequence and offset by binary search in the plan, which is broadcast.

Tokenizing is the bulk of the work. The vocabulary file is read by its own library; where a text holds only characters that are
sorted into letters, digits, marks and white space by everyone alike, its ids are made from the same vocabulary by a faster encoder of the same merges,
four times as fast. All other texts go to the library whole.

Defined results: a null text is an empty one: a single piece that holds the end id. Repeated rows
are packed as often as they come, null keys as any other. An empty table gives no rows. Special tokens written out in a text are
ordinary text. Further columns are not read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import Workspace
from .text import objects, per_process

CAPACITY = 2048
END_ID = 0

# Fixed value: how byte-level vocabularies of this family cut a text into units.
UNITS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Triples enumerated per longest length, and steps of the least-squares fit.
TRIPLES = 12
STEPS = 600

# Anything but plain ASCII and the Latin, Greek and Cyrillic letters of the first Unicode versions.
_UNSURE = re.compile("[^\t-\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u0217\u0391-\u03a1\u03a3-\u03c9\u0410-\u044f]")


def byte_signs() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: itself where it is printable, else the next one from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(byte): byte for byte in plain} | {chr(256 + i): byte for i, byte in enumerate(others)}


class TextTokenizer:
    """Ids of whole texts, as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        special = {added.content for added in self.tokenizer.get_added_tokens_decoder().values()}
        signs = byte_signs()
        ranks = {
            bytes(map(signs.__getitem__, token)): i
            for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items()
            if token not in special
        }
        self.encoding = Encoding(f"vocabulary of {path}", pat_str=UNITS, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        if _UNSURE.search(text):
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            found = self.encoding.encode_ordinary(text)
        return np.array(array("I", found), dtype="<u4").tobytes()


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be shorter than the others."""
    first = n % capacity or capacity
    starts = [0, *range(first, n, capacity)]
    return [(s, first if s == 0 else capacity) for s in starts]


def pieces(docs: DataFrame, tokenizer: str, *, capacity: int, key: str, text: str) -> DataFrame:
    """Pieces with their task and their number among the task's pieces of that length."""

    def cut_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = per_process(f"tokenizer {tokenizer}", lambda: TextTokenizer(tokenizer))
        end = np.asarray([END_ID], dtype="<u4").tobytes()
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            row, number, start, length, crc = [], [], [], [], []
            for i, value in enumerate(batch["text"]):
                ids = encoder.ids(value or "") + end
                for k, (first, n) in enumerate(cut(len(ids) // 4, capacity)):
                    row.append(i)
                    number.append(k)
                    start.append(first)
                    length.append(n)
                    crc.append(zlib.crc32(ids[4 * first : 4 * (first + n)]))
            lengths = np.array(length, dtype=np.int64)
            # Numbers within a length go on from batch to batch.
            order = np.argsort(lengths, kind="stable")
            counts = np.bincount(lengths, minlength=capacity + 1)
            rank = np.empty(len(lengths), dtype=np.int64)
            rank[order] = np.arange(len(lengths)) - (np.cumsum(counts) - counts - seen)[lengths[order]]
            seen += counts
            yield pd.DataFrame(
                {
                    "key": batch["key"].to_numpy(dtype=object)[np.array(row, dtype=np.int64)],
                    "piece": np.array(number, dtype=np.int32),
                    "start": np.array(start, dtype=np.int64),
                    "length": lengths,
                    "ids_crc32": np.array(crc, dtype=np.int64),
                    "task": np.full(len(lengths), task, dtype=np.int32),
                    "number": rank,
                }
            )

    # Keys travel as text: a null among numbers would make pandas take them for floats.
    schema = "key string, piece int, start long, length long, ids_crc32 long, task int, number long"
    return docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text")).mapInPandas(cut_all, schema)


@dataclass(frozen=True)
class Plan:
    """Slots sorted by (length, first): pieces ``first``, ``first + 1``, ... of a length go to sequences
    ``sequence``, ``sequence + 1``, ... at ``offset``."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wide = 1 << 44
        at = np.searchsorted(self.length * wide + self.first, length * wide + rank, side="right") - 1
        return self.sequence[at] + rank - self.first[at], self.offset[at]


def patterns(lengths: np.ndarray, capacity: int, triples: int = TRIPLES) -> np.ndarray:
    """Rows of three lengths that add up to ``capacity``, 0 where there are two only.

    All pairs, and for every longest length a spread of triples over the ways to share the rest.
    """
    present = np.zeros(capacity + 1, dtype=bool)
    present[lengths] = True
    rows = []
    for a in map(int, lengths[::-1]):
        rest = capacity - a
        if 0 < rest <= a and present[rest]:
            rows.append((a, rest, 0))
        ways = [b for b in range((rest + 1) // 2, min(a, rest - 1) + 1) if present[b] and present[rest - b]]
        rows += [(a, ways[i], rest - ways[i]) for i in sorted({(len(ways) - 1) * k // triples for k in range(triples)} if ways else ())]
    return np.array(rows, dtype=np.int64).reshape(-1, 3)


def fitted(rows: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeats x >= 0 that minimize the squared misfit of ``sum x * pattern`` to ``counts``.

    Accelerated projected gradient; a row touches three lengths, so a step is a gather and a
    scatter and no matrix is formed. Misfits are weighted by length, as a long piece left over costs more.
    """
    size = len(counts)
    weight = np.sqrt(np.arange(size) / max(size - 1, 1))
    weight[0] = 0.0
    used = rows > 0
    goal = counts * weight

    def fit(x):
        return np.bincount(rows.ravel(), (x[:, None] * used).ravel(), minlength=size) * weight

    def back(r):
        return ((r * weight)[rows] * used).sum(axis=1)

    x = probe = np.zeros(len(rows))
    norm = np.ones(len(rows))
    for _ in range(20):  # largest eigenvalue, for the step's size
        norm = back(fit(norm))
        scale = np.linalg.norm(norm) or 1.0
        norm /= scale
    step, momentum = 1.0 / (1.05 * scale), 1.0
    for _ in range(steps):
        new = np.maximum(probe - step * back(fit(probe) - goal), 0.0)
        following = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        probe = new + (momentum - 1) / following * (new - x)
        x, momentum = new, following
    return x


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, of ``left[length]`` pieces; equal sequences are one entry with a count."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    gaps: list[int] = []
    full = []

    def keep(content: tuple[int, ...], count: int) -> None:
        gap = capacity - sum(content)
        if gap == 0:
            full.append((content, count))
            return
        if gap not in groups:
            gaps.insert(bisect_left(gaps, gap), gap)
            groups[gap] = []
        groups[gap].append((content, count))

    for length in range(capacity, 0, -1):
        count = int(left[length])
        while count:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                fit = capacity // length
                whole, rest = divmod(count, fit)
                if whole:
                    keep((length,) * fit, whole)
                if rest:
                    keep((length,) * rest, 1)
                break
            gap = gaps[at]
            content, free = groups[gap].pop()
            if not groups[gap]:
                del groups[gap]
                gaps.pop(at)
            used = min(count, free)
            # As many copies as fit go in at once: the gap stays the tightest one while it holds one.
            several = min(gap // length, count // used) if used == free else 1
            if used < free:
                keep(content, free - used)
            keep(content + (length,) * several, used)
            count -= used * several
    return full + [entry for group in groups.values() for entry in group]


def plan(counts: np.ndarray, capacity: int = CAPACITY, *, triples: int = TRIPLES, steps: int = STEPS) -> Plan:
    """Where all ``counts[length]`` pieces go."""
    left = counts.astype(np.int64).copy()
    chosen: list[tuple[tuple[int, ...], int]] = []
    if left[capacity]:
        chosen.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    lengths = np.flatnonzero(left)
    rows = patterns(lengths, capacity, triples)
    if len(rows):
        repeats = np.floor(fitted(rows, left.astype(float), steps) + 0.25).astype(np.int64)
        for k in np.argsort(-repeats, kind="stable"):
            content = tuple(int(v) for v in rows[k] if v)
            times = min(int(repeats[k]), *(int(left[v]) // content.count(v) for v in content))
            if times > 0:
                chosen.append((content, times))
                for v in content:
                    left[v] -= times
    chosen += best_fit(left, capacity)
    slots = []
    given = np.zeros(capacity + 1, dtype=np.int64)
    sequence = 0
    for content, times in chosen:
        offset = 0
        for length in content:
            slots.append((length, given[length], sequence, offset))
            given[length] += times
            offset += length
        sequence += times
    table = np.array(sorted(slots), dtype=np.int64).reshape(-1, 4)
    return Plan(table[:, 0], table[:, 1], table[:, 2], table[:, 3], sequence)


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    capacity: int = CAPACITY,
    key: str = "doc_id",
    text: str = "text",
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    workspace = workspace or Workspace(spark)
    cut_up = workspace.write(pieces(docs, tokenizer, capacity=capacity, key=key, text=text), "pieces")
    per_task = workspace.write(cut_up.groupBy("task", "length").count(), "counts")
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for row in per_task.groupBy("length").agg(F.sum("count").alias("count")).collect():
        histogram[row["length"]] = row["count"]
    chosen = plan(histogram, capacity)
    slots = spark.sparkContext.broadcast((chosen.length, chosen.first, chosen.sequence, chosen.offset))
    earlier = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    starts = per_task.select("task", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    ranked = cut_up.join(starts, ["task", "length"]).select(
        "key", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("number")).alias("rank")
    )

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places = Plan(*slots.value, 0)
        for batch in batches:
            sequence, offset = places.place(batch["length"].to_numpy(), batch["rank"].to_numpy())
            yield objects(batch.drop(columns="rank").assign(sequence_id=sequence, offset=offset))

    kind = docs.schema[key].dataType.simpleString()
    schema = "key string, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    found = ranked.mapInPandas(placed, schema)
    return found.select(F.col("key").cast(kind).alias(key), *found.columns[1:])
