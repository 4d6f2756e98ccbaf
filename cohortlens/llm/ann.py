"""Approximate nearest neighbours by inner product with a hash-prefix forest.

Every tree gives a vector a long hash string, the signs of its projections on ``BITS`` seeded random
directions, and keeps the strings as a sorted array. A query descends each tree to the longest prefix it
shares with any string; then all trees ascend together, one bit at a time, until the vectors below the
reached prefixes, counted over the trees, are ``share`` times as many as are indexed, and enough to hold ``k`` different
ones. Prefixes of one length
are an interval of the sorted array, so both ways are binary searches. All candidates are scored exactly, in
double precision.

Inner product instead of angle: vectors get one more component that brings all to the same length, which a
query has as 0, so that the larger inner product is the smaller angle. Lengths need not be equal.

How it scales. Rows fall into shards of about ``ROWS_PER_SHARD``, by a hash of id and vector, each one row of a written table
that every pass builds a forest from. A stated set of queries is cut into blocks of about ``QUERIES_PER_BLOCK``; a block is broadcast,
and one pass of parallel tasks searches all shards for it: no vector is copied or shuffled for a block. Rows that agree in id and vector are
counted before they are dealt, and equal vectors are indexed once per shard with their smallest ids, as
many as can be among the nearest, so that a vector that a third of all rows share costs no more
than others. A task returns at most ``k`` rows for each query, whatever it reads; the best ``k`` of all tasks follow by
a window that keeps ``k`` rows per query before its shuffle. The index holds every row; nothing is fitted on a sample.

Recall. For vectors without structure, such as the test data, near and far directions differ little and a hash
prefix tells them apart slowly; ``SHARE`` is set for recall above 0.9 on them, with figures in the README. Data
with closer neighbours needs a smaller share.

Defined results: vectors that are null, of zero length, all zeros, or hold null or non-finite components take no part, neither as
queries nor as candidates; rows without id neither. Vectors of different length are not compared. Equal scores go by smaller id. A
repeated row is found as often as it comes, but asks once; an id with several vectors asks with each; a query never finds its own id. Fewer
than ``k`` candidates are all returned. An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import Workspace

TREES = 32
BITS = 48
SEED = 20240607
SHARE = 0.62
ROWS_PER_SHARD = 8192
QUERIES_PER_BLOCK = 4096


def inner(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each row summed in the same order."""
    return (vectors * query).sum(axis=1)


class Forest:
    """Hash-prefix trees over the rows of ``vectors``."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        n, dim = vectors.shape
        self.trees, self.bits = trees, bits
        squares = (vectors**2).sum(axis=1)
        self.scale = np.sqrt(squares.max()) if n else 1.0
        lift = np.sqrt(np.maximum(self.scale**2 - squares, 0.0))
        self.directions = np.random.default_rng([seed, dim]).standard_normal((dim + 1, trees * bits))
        self.vectors = vectors
        strings = self._strings(vectors, lift)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def _strings(self, vectors: np.ndarray, lift: np.ndarray) -> np.ndarray:
        """Hash strings, (tree, row), the first bit being the highest."""
        result = np.zeros((self.trees, len(vectors)), dtype=np.uint64)
        places = np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64)
        for tree in range(self.trees):
            part = self.directions[:, tree * self.bits : (tree + 1) * self.bits]
            signs = vectors @ part[:-1] + np.outer(lift, part[-1]) > 0
            result[tree] = (signs * places).sum(axis=1, dtype=np.uint64)
        return result

    def intervals(self, strings: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Per tree and query the interval below the prefix at which all trees together hold ``wanted``.

        The ascent is synchronous: one depth for all trees. Counts only grow on the way up, so
        a query stops at the first depth that holds enough, the root at last.
        """
        trees, n = strings.shape
        low = np.zeros((trees, n), dtype=np.int64)
        high = np.full((trees, n), len(self.vectors), dtype=np.int64)
        waiting = np.arange(n)
        for depth in range(self.bits, -1, -1):
            if not len(waiting):
                break
            free = np.uint64(self.bits - depth)
            ends = (np.uint64(1) << free) - np.uint64(1)
            first = (strings[:, waiting] >> free) << free
            lows = np.stack([np.searchsorted(a, f) for a, f in zip(self.sorted, first, strict=True)])
            highs = np.stack([np.searchsorted(a, f | ends, side="right") for a, f in zip(self.sorted, first, strict=True)])
            enough = (highs - lows).sum(axis=0) >= wanted
            low[:, waiting[enough]] = lows[:, enough]
            high[:, waiting[enough]] = highs[:, enough]
            waiting = waiting[~enough]
        return low, high

    def search(self, queries: np.ndarray, k: int, share: float = SHARE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions and scores of about the ``k`` best candidates of each query, unsorted."""
        n = len(self.vectors)
        # A vector may be counted once per tree: so many hold at least ``4 * k`` different ones, or all there are.
        wanted = max(int(np.ceil(share * n)), min(n, 4 * k) * self.trees)
        low, high = self.intervals(self._strings(queries, np.zeros(len(queries))), wanted)
        for i, query in enumerate(queries):
            below = np.zeros(n, dtype=bool)
            for tree in range(self.trees):
                below[self.order[tree, low[tree, i] : high[tree, i]]] = True
            found = np.flatnonzero(below)
            rough = self.vectors[found] @ query
            if len(found) > k:
                # All that may equal the k-th: the matrix product rounds in another order than the exact score.
                slack = 1e-12 * self.scale * np.sqrt((query**2).sum()) * len(query)
                found = found[rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - slack]
            yield found, inner(self.vectors[found], query)


def grouped_ids(
    vectors: np.ndarray, ids: np.ndarray, copies: np.ndarray, most: int
) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct vectors, each with its ids in order, an id as often as it has copies, ``most`` at most."""
    vectors, ids = np.repeat(vectors, copies, axis=0), np.repeat(ids, copies)
    distinct, inverse = np.unique(vectors, axis=0, return_inverse=True)
    order = np.lexsort((ids, inverse.ravel()))
    bounds = np.cumsum(np.bincount(inverse.ravel(), minlength=len(distinct)))[:-1]
    return distinct, [part[:most] for part in np.split(ids[order], bounds)]


SHARD = "dim int, n int, ids binary, copies binary, vectors binary"


def _pack(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """A shard as one row."""
    values = np.zeros((len(rows), keys[0]))
    for i, vector in enumerate(rows["vector"]):
        values[i] = vector
    parts = [rows["id"].to_numpy(np.int64), rows["copies"].to_numpy(np.int64), values]
    return pd.DataFrame([[keys[0], len(rows), *[p.tobytes() for p in parts]]], columns=["dim", "n", "ids", "copies", "vectors"])


def _search(broadcast, k: int, trees: int, bits: int, share: float):
    """The best ``k`` of a task's shards for each query of a block, whose place in the block is ``mark``."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked = broadcast.value
        best = [(np.zeros(0, dtype=np.int64), np.zeros(0)) for _ in asked]
        by_dim = {}
        for mark, (_, vector) in enumerate(asked):
            by_dim.setdefault(len(vector), []).append(mark)
        for batch in batches:
            for row in batch.itertuples():
                marks = by_dim.get(row.dim)
                if marks is None:
                    continue
                vectors = np.frombuffer(row.vectors).reshape(row.n, row.dim)
                ids, copies = np.frombuffer(row.ids, dtype=np.int64), np.frombuffer(row.copies, dtype=np.int64)
                # An id has at most k copies of a vector: beside a query's own there are k others, if there are any.
                vectors, ids = grouped_ids(vectors, ids, copies, 2 * k)
                queries = np.stack([asked[m][1] for m in marks])
                # One vector more than asked for, as the query's own may be among them.
                for mark, (found, scores) in zip(marks, Forest(vectors, trees, bits).search(queries, k + 1, share), strict=True):
                    members = [ids[p] for p in found]
                    near = np.concatenate([best[mark][0], *members])
                    value = np.concatenate([best[mark][1], np.repeat(scores, [len(m) for m in members])])
                    other = near != asked[mark][0]
                    near, value = near[other], value[other]
                    order = np.lexsort((near, -value))[:k]
                    best[mark] = near[order], value[order]
        counts = [len(near) for near, _ in best]
        yield pd.DataFrame(
            {
                "mark": np.repeat(np.arange(len(best)), counts),
                "query_id": np.repeat([own for own, _ in asked], counts),
                "vec_id": np.concatenate([near for near, _ in best]),
                "score": np.concatenate([value for _, value in best]),
            }
        )

    return search


def nearest(
    rows: DataFrame,
    queries: Column,
    *,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    trees: int = TREES,
    bits: int = BITS,
    share: float = SHARE,
    rows_per_shard: int = ROWS_PER_SHARD,
    queries_per_block: int = QUERIES_PER_BLOCK,
    workspace: Workspace | None = None,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest of every row for which ``queries`` holds."""
    workspace = workspace or Workspace(rows.sparkSession)
    # Not-a-number counts as greater than every number.
    usable = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    valid = workspace.write(
        rows.select(
            F.col(key).cast("long").alias("id"),
            F.col(vector).cast("array<double>").alias("vector"),
            F.coalesce(queries, F.lit(False)).alias("asks"),
        )
        .filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & F.coalesce(usable, F.lit(False)))
        .withColumn("dim", F.size("vector")),
        "vectors",
    )
    # Rows that agree in id and vector are one with a count, of which no more than ``k`` can be among the nearest.
    counted = valid.groupBy("id", "vector", "dim").agg(
        F.least(F.count("*"), F.lit(k)).alias("copies"), F.bool_or("asks").alias("asks")
    )
    counted = workspace.write(counted, "counted")
    n, asking = counted.agg(F.count("*"), F.count_if("asks")).first()
    shards = max(1, -(-n // rows_per_shard))
    blocks = -(-asking // queries_per_block)
    schema = "query_id long, rank int, vec_id long, score double"
    if not blocks:
        return rows.sparkSession.createDataFrame([], schema)

    def dealt(parts: int) -> Column:
        return F.pmod(F.xxhash64("id", "vector", F.lit(parts)), F.lit(parts)).cast("int")

    by = ["dim", "shard"]
    packed = counted.withColumn("shard", dealt(shards)).repartition(shards, *by).groupBy(*by).applyInPandas(_pack, SHARD)
    index = workspace.write(packed, "index")
    # Blocks are folders of one table each way, so that their number does not lengthen any plan.
    every, results = workspace.path("queries"), workspace.path("nearest")
    counted.filter("asks").withColumn("block", dealt(blocks)).write.partitionBy("block").parquet(every)
    order = W.partitionBy("mark").orderBy(F.desc("score"), "vec_id")
    for block in range(blocks):
        chosen = rows.sparkSession.read.parquet(every).filter(F.col("block") == block).select("id", "vector").collect()
        if not chosen:
            continue
        sent = rows.sparkSession.sparkContext.broadcast([(r["id"], np.array(r["vector"], dtype=np.float64)) for r in chosen])
        found = index.mapInPandas(_search(sent, k, trees, bits, share), "mark long, query_id long, vec_id long, score double")
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        ranked.select("query_id", "rank", "vec_id", "score").write.parquet(f"{results}/block={block}")
        sent.unpersist()
    return rows.sparkSession.read.schema(schema).parquet(f"{results}/block=*")
