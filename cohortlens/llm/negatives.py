"""Hard-negative mining by a vertical scan of vectors stored by dimension.

An anchor's positives are its nearest rows of the same label by inner product; its hard negatives are the nearest rows of
other labels whose score lies in a window below the positive's. Vectors are integers, components scaled and rounded
down, so that scores are exact.

The scan. A shard holds its rows dimension by dimension, with each dimension's least and greatest value. For one
anchor the dimensions are read in the order of the anchor's descending magnitudes. After every few of them a row's score
lies between its partial sum plus the least and plus the greatest that the remaining dimensions can add; rows that can no
longer be among the first, or not in any window, leave the bitmap, and only the others' values are read further. What remains at
the end has its exact score. Limits reached in one shard hold for the next ones that the same task reads. Two scans follow one another: the
first finds all positives, the second, which knows the windows, the negatives. Of an anchor's windows the one of the lowest
positive bounds what any of them needs: rows below its third certain member are in no window's first three.

How it scales. Rows fall into shards of about ``VALUES_PER_SHARD`` components by a hash of id and vector, each one row of a
written table. Anchors are taken in blocks of about ``ANCHORS_PER_BLOCK``, whose vectors (and windows) are broadcast; a block is one
pass of parallel tasks over the table, without shuffle but for the few rows found. A task returns at most ``k`` rows for
each anchor (and positive), however many rows share a label or a vector, and no pairs are made. The anchors being a
share of the rows, the work grows with the product, as a stated query set against all rows does.

Defined results: rows whose id, label or vector is null, or whose vector holds null or non-finite components, take no part. Rows
equal in id, label and vector count once; an id with several vectors or labels is an anchor with each, and never its own
positive or negative. Vectors of different length are not compared; empty ones score 0. Ties go by smaller id. Fewer rows than asked for are all
returned; anchors without positives, and positives without negatives, give no row. Scaled components are cut off at
``2**31 / sqrt(length)``, beyond which scores would not fit a long. An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import Workspace

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
# Bounds of a window, in hundredths of the positive's score.
LEAST, MOST = 50, 95
VALUES_PER_SHARD = 1 << 18
ANCHORS_PER_BLOCK = 4096
# Dimensions read before bounds are looked at again.
STEP = 8
# Whole numbers below are exact in double precision.
EXACT = 2.0**53

SHARD = "dim int, n int, ids binary, labels binary, columns binary"
FOUND = ("anchor", "anchor_id", "number", "positive_id", "negative_id", "positive_score", "negative_score")
RESULT = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def usable(rows: DataFrame, key: str, vector: str, label: Column) -> DataFrame:
    """Distinct ``id``, ``label``, scaled ``vector`` and ``dim`` of the rows that take part."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    valid = rows.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), values.alias("vector")).filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False))
    )
    most = F.least(F.floor(F.sqrt(F.lit(2.0**62) / F.greatest(F.size("vector"), F.lit(1)))), F.lit(2**31 - 1))
    scaled = F.transform("vector", lambda x: F.greatest(F.least(F.floor(x * SCALE), most), -most).cast("int"))
    return valid.select("id", "label", scaled.alias("vector"), F.size("vector").alias("dim")).distinct()


def _pack(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """One shard, its rows by label and id, its values by dimension."""
    rows = rows.sort_values(["label", "id"])
    values = np.zeros((len(rows), keys[0]), dtype=np.int32)
    for i, vector in enumerate(rows["vector"]):
        values[i] = vector
    parts = [rows["id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), np.ascontiguousarray(values.T)]
    return pd.DataFrame([[keys[0], len(rows), *[p.tobytes() for p in parts]]], columns=["dim", "n", "ids", "labels", "columns"])


class Shard:
    """Columns of a shard with their ranges."""

    def __init__(self, dim: int, ids: bytes, labels: bytes, columns: bytes):
        self.ids = np.frombuffer(ids, dtype=np.int64)
        self.labels = np.frombuffer(labels, dtype=np.int64)
        self.columns = np.frombuffer(columns, dtype=np.int32).reshape(dim, len(self.ids))
        self.low = self.columns.min(axis=1).astype(np.int64)
        self.high = self.columns.max(axis=1).astype(np.int64)
        self.widest = float(np.maximum(-self.low, self.high).astype(np.float64).max(initial=0))
        self.kinds = {}

    def of_kind(self, anchor: np.ndarray) -> np.ndarray:
        """Columns as numbers in which sums with ``anchor`` are exact: doubles where they are, as those multiply faster."""
        bound = self.widest * float(np.abs(anchor).astype(np.float64).sum())
        kind = np.float64 if bound < EXACT else np.int64
        if kind not in self.kinds:
            self.kinds[kind] = self.columns.astype(kind)
        return self.kinds[kind]

    def scan(self, anchor: np.ndarray, alive: np.ndarray, needed) -> tuple[np.ndarray, np.ndarray]:
        """Rows of ``alive`` that ``needed(lower, upper)`` never drops, and their scores."""
        columns = self.of_kind(anchor)
        order = np.argsort(-np.abs(anchor), kind="stable")
        weights = anchor[order]
        ends = weights * self.low[order], weights * self.high[order]
        # What the dimensions from a place on can add at least and at most.
        least = np.append(np.cumsum(np.minimum(*ends)[::-1])[::-1], 0).astype(columns.dtype)
        most = np.append(np.cumsum(np.maximum(*ends)[::-1])[::-1], 0).astype(columns.dtype)
        weights = weights.astype(columns.dtype)
        partial = np.zeros(len(alive), dtype=columns.dtype)
        for start in range(0, len(order), STEP):
            dims = order[start : start + STEP]
            block = columns[dims] if len(alive) == columns.shape[1] else columns[dims[:, None], alive]
            partial = partial + weights[start : start + STEP] @ block
            read = start + len(dims)
            keep = needed(partial + least[read], partial + most[read])
            if not keep.all():
                alive, partial = alive[keep], partial[keep]
            if not len(alive):
                break
        return alive, partial.astype(np.int64)


class First:
    """The first ``k`` rows by score, then id."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int64)

    @property
    def limit(self) -> float:
        """Score below which a row is not among them."""
        return self.scores[-1] if len(self.scores) == self.k else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def kth(values: np.ndarray, k: int) -> float:
    """The ``k``-th greatest, or less than anything."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def find_positives(shard: Shard, own: int, label: int, anchor: np.ndarray, first: First) -> None:
    low, high = np.searchsorted(shard.labels, label), np.searchsorted(shard.labels, label, side="right")
    alive = low + np.flatnonzero(shard.ids[low:high] != own)

    def needed(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        return upper >= max(first.limit, kth(lower, first.k))

    if len(alive):
        rows, scores = shard.scan(anchor, alive, needed)
        first.add(scores, shard.ids[rows])


def find_negatives(
    shard: Shard, own: int, label: int, anchor: np.ndarray, low: np.ndarray, high: np.ndarray, firsts: list[First]
) -> None:
    """Windows are ``low`` to ``high``, highest first, not empty."""
    alive = np.flatnonzero((shard.labels != label) & (shard.ids != own))
    lowest, highest, last = low[-1], high[0], firsts[-1]

    def needed(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        certain = lower[(lower >= lowest) & (upper <= high[-1])]
        return (upper >= max(lowest, last.limit, kth(certain, last.k))) & (lower <= highest)

    if len(alive):
        rows, scores = shard.scan(anchor, alive, needed)
        for a, b, first in zip(low, high, firsts, strict=True):
            inside = (scores >= a) & (scores <= b)
            first.add(scores[inside], shard.ids[rows[inside]])


def _shards(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, Shard]]:
    for batch in batches:
        for row in batch.itertuples():
            yield row.dim, Shard(row.dim, row.ids, row.labels, row.columns)


def _positives(broadcast, k: int):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors = broadcast.value
        firsts = [First(k) for _ in anchors]
        for dim, shard in _shards(batches):
            for (own, label, vector), first in zip(anchors, firsts, strict=True):
                if len(vector) == dim:
                    find_positives(shard, own, label, vector, first)
        yield pd.DataFrame(
            {
                "anchor": np.repeat(np.arange(len(firsts)), [len(f.ids) for f in firsts]),
                "id": np.concatenate([f.ids for f in firsts]),
                "score": np.concatenate([f.scores for f in firsts]),
            }
        )

    return search


def _negatives(broadcast, k: int):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors = broadcast.value
        firsts = [[First(k) for _ in low] for *_, low, _ in anchors]
        for dim, shard in _shards(batches):
            for (own, label, vector, _, low, high), found in zip(anchors, firsts, strict=True):
                if len(vector) == dim and len(low):
                    find_negatives(shard, own, label, vector, low, high, found)
        result = []
        for anchor, ((own, *_, positives, _, _), found) in enumerate(zip(anchors, firsts, strict=True)):
            for (number, positive, score), first in zip(positives, found, strict=True):
                for other, value in zip(first.ids.tolist(), first.scores.tolist(), strict=True):
                    result.append((anchor, own, number, positive, other, score, value))
        yield pd.DataFrame(result, columns=list(FOUND))

    return search


def bounds(score: int) -> tuple[int, int]:
    """Least and greatest score in the window of a positive."""
    return -((-LEAST * score) // 100), (MOST * score) // 100


def mine(
    rows: DataFrame,
    anchors: Column,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    values_per_shard: int = VALUES_PER_SHARD,
    anchors_per_block: int = ANCHORS_PER_BLOCK,
    workspace: Workspace | None = None,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores, for rows whose ``id`` meets ``anchors``."""
    spark = rows.sparkSession
    workspace = workspace or Workspace(spark)
    valid = workspace.write(usable(rows, key, vector, F.col("label") if label is None else label), "vectors")
    asks = F.coalesce(anchors, F.lit(False))
    values, asking = valid.agg(F.sum("dim"), F.count_if(asks)).first()
    n_shards = max(1, -(-int(values or 0) // values_per_shard))
    n_blocks = -(-asking // anchors_per_block)
    kept = ", ".join(f"{c} {'int' if c == 'rank' else 'long'}" for c in RESULT)
    if not n_blocks:
        return spark.createDataFrame([], kept)

    def dealt(parts: int) -> Column:
        return F.pmod(F.xxhash64("id", "vector"), F.lit(parts)).cast("int")

    by = ["dim", "shard"]
    packed = valid.withColumn("shard", dealt(n_shards)).repartition(n_shards, *by).groupBy(*by).applyInPandas(_pack, SHARD)
    shards = workspace.write(packed, "shards")
    # Blocks are folders of one table, so that their number does not lengthen any plan.
    path = workspace.path("found")
    every = workspace.path("anchors")
    valid.filter(asks).withColumn("block", dealt(n_blocks)).write.partitionBy("block").parquet(every)

    def first(found: DataFrame, by: list[str], score: str, tie: str, k: int) -> DataFrame:
        order = W.partitionBy(*by).orderBy(F.desc(score), tie)
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    for block in range(n_blocks):
        chosen = spark.read.parquet(every).filter(F.col("block") == block).select("id", "label", "vector").collect()
        asked = [(r["id"], r["label"], np.array(r["vector"], dtype=np.int64)) for r in chosen]
        if not asked:
            continue
        sent = spark.sparkContext.broadcast(asked)
        near = shards.mapInPandas(_positives(sent, positives), "anchor long, id long, score long")
        best = [[] for _ in asked]
        for r in first(near, ["anchor"], "score", "id", positives).orderBy("anchor", "rank").collect():
            # A window can be empty: below zero it always is.
            if bounds(r["score"])[0] <= bounds(r["score"])[1]:
                best[r["anchor"]].append((r["rank"], r["id"], r["score"]))
        windows = [np.array([bounds(s) for *_, s in b], dtype=np.int64).reshape(-1, 2) for b in best]
        tasks = [(*a, b, w[:, 0], w[:, 1]) for a, b, w in zip(asked, best, windows, strict=True)]
        told = spark.sparkContext.broadcast(tasks)
        found = shards.mapInPandas(_negatives(told, negatives), ", ".join(f"{c} long" for c in FOUND))
        hard = first(found, ["anchor", "number"], "negative_score", "negative_id", negatives)
        hard.select(*RESULT).write.parquet(f"{path}/block={block}")
        sent.unpersist()
        told.unpersist()
    return spark.read.schema(kept).parquet(f"{path}/block=*")
