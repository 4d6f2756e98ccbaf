"""Mixing sources to target weights by weighted fair queueing, with DataFrame functions only.

Every source is a queue of its documents in shuffled order, repeated up to ``repeats`` times. A copy's
virtual finish time is the number of words its source has sent up to its end, divided by the source's
target. Copies are sent in order of finish time, whatever their source, until the budget is used up.

How it scales. Running sums are never taken over a whole source: documents fall into ``SHUFFLE_BUCKETS``
slices of the shuffle order, the slices' sums are accumulated per source, and a document only adds up
what precedes it in its own slice. The global order is cut likewise: sums per slice of virtual time find
the slice in which the budget ends, only that one is sorted finely, and its last copy sent is the
threshold that decides about every other row by comparison. No source, however large, meets in a task,
and slices are a matter of speed only: the result does not depend on their number.

Defined results: a null or empty text has size 0 and takes 0; a null source is a source of its own that
sorts last; a null key or text counts as the empty one in the shuffle, whose order hashes key and text. Rows that agree
in both are interchangeable. Equal finish times go by rank of source, shuffle order and key. An empty table gives
no rows. Sources and their sizes are one small table, as the list of weights is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import Workspace
from .simhash import pick
from .text import word_count

WEIGHTS = (5, 2, 1)
REPEATS = 3

# Slices of the shuffle order of a source (hex digits of its hash) and of one unit of virtual time.
SHUFFLE_DIGITS = 3
TIME_SLICES = 8192


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Target of every source from its ``source`` and ``source_size``; adds ``place`` and ``target``.

    Sources sorted by code point, null last, carry the weights in turn and share the total. None goes
    beyond ``repeats`` times its size: a water level ``l`` is sought such that ``min(limit, l * weight)``
    adds up to the total. With sources by ``limit / weight``, those below the level are a prefix.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(w) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int")
    )
    placed = sizes.withColumn("place", F.row_number().over(by_name)).withColumn("weight", weight.cast("long"))
    limited = placed.withColumn("most", F.col("source_size") * repeats).withColumn("brim", F.col("most") / F.col("weight"))
    before = W.orderBy("brim", "place").rowsBetween(W.unboundedPreceding, -1)
    onward = W.orderBy("brim", "place").rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))).cast(
        "double"
    ) / F.sum("weight").over(onward).cast("double")
    levels = limited.withColumn("level", level)
    first = F.min(F.when(F.col("level") <= F.col("brim"), F.struct("brim", "place", "level"))).over(everything)
    return levels.withColumn("found", first["level"]).select(
        "source",
        "source_size",
        "place",
        F.least(F.col("most").cast("double"), F.col("found") * F.col("weight")).alias("target"),
    )


def _finish(copy: int) -> Column:
    """Virtual finish time of a document's copy, from 0."""
    words = F.lit(copy).cast("long") * F.col("source_size") + F.col("sent")
    return F.try_divide(words.cast("double"), F.col("target"))


def _order(copy: int) -> Column:
    """Place of a copy in the global order."""
    return F.struct(
        _finish(copy).alias("finish"),
        F.col("place").alias("place"),
        F.lit(copy).alias("copy"),
        F.col("shuffled").alias("shuffled"),
        F.col("size").alias("size"),
    )


def shuffle_mark(key: str, text: str) -> Column:
    """Place in the shuffle order, from key and text: rows of one key lie apart, and which of them is sent is settled by what they hold."""
    content = F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    return F.md5(F.concat_ws(" ", F.coalesce(F.col(key).cast("string"), F.lit("")), content).cast("binary"))


def row_mark(key: str, text: str, source: str) -> Column:
    """Hash by which equal rows are recognized."""
    return F.xxhash64(F.col(key), F.col(source), F.col(text))


def queued(docs: DataFrame, workspace: Workspace, *, weights, repeats, key: str, text: str, source: str) -> DataFrame:
    """Every document with its size, its source's size and target, and the words sent up to its end."""
    label = shuffle_mark(key, text)
    sized = workspace.write(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
            label.alias("shuffled"),
            row_mark(key, text, source).alias("mark"),
        ).withColumn("slice", F.substring("shuffled", 1, SHUFFLE_DIGITS)),
        "sized",
    )
    slices = workspace.write(sized.groupBy("source", "slice").agg(F.sum("size").alias("slice_size")), "slices")
    targets = source_targets(
        slices.groupBy("source").agg(F.sum("slice_size").alias("source_size")), weights, repeats
    )
    earlier = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    starts = slices.withColumn("start", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)))
    starts = starts.alias("s").join(targets.alias("t"), F.expr("s.source <=> t.source")).select(
        F.col("s.source").alias("source_"), F.col("slice").alias("slice_"), "start", "source_size", "place", "target"
    )
    within = W.partitionBy("source", "slice").orderBy("shuffled", "key", "size").rowsBetween(W.unboundedPreceding, 0)
    return workspace.write(
        sized.withColumn("upto", F.sum("size").over(within))
        .join(starts, F.expr("source <=> source_ AND slice = slice_"))
        .withColumn("sent", F.col("start") + F.col("upto"))
        .select("key", "mark", "source", "size", "shuffled", "sent", "source_size", "place", "target"),
        "queued",
    )


def _last_sent(queue: DataFrame, repeats: int) -> Column | None:
    """Place of the last copy within the budget, as a literal; None if nothing is sent."""
    copies = queue.filter("size > 0").select(
        F.explode(F.array(*[_order(c) for c in range(repeats)])).alias("at")
    )
    time_slice = F.floor(F.least(F.col("at.finish"), F.lit(2.0)) * TIME_SLICES)
    sums = copies.groupBy(time_slice.alias("slice")).agg(F.sum("at.size").alias("words"))
    budget = queue.select("source", "source_size").distinct().agg(F.sum("source_size").alias("budget"))
    running = sums.withColumn(
        "upto", F.sum("words").over(W.orderBy("slice").rowsBetween(W.unboundedPreceding, 0))
    )
    total = budget.first()["budget"]
    if not total:
        return None
    # The slice in which the budget ends; if it is never used up, the one after the last.
    found = running.agg(
        F.min(F.when(F.col("upto") > total, F.col("slice"))).alias("slice"),
        F.max(F.when(F.col("upto") <= total, F.struct("slice", "upto"))).alias("whole"),
    ).first()
    done = found["whole"]["upto"] if found["whole"] else 0
    last_whole = found["whole"]["slice"] if found["whole"] else None
    fine = copies.filter(time_slice == F.lit(found["slice"])) if found["slice"] is not None else None
    best = None
    if fine is not None:
        best = (
            fine.withColumn("upto", F.sum("at.size").over(W.orderBy("at").rowsBetween(W.unboundedPreceding, 0)) + F.lit(done))
            .filter(F.col("upto") <= total)
            .agg(F.max("at").alias("at"))
            .first()["at"]
        )
    if best is None and last_whole is not None:
        best = copies.filter(time_slice == F.lit(last_whole)).agg(F.max("at").alias("at")).first()["at"]
    if best is None:
        return None
    return F.struct(
        F.lit(best["finish"]).alias("finish"),
        F.lit(best["place"]).alias("place"),
        F.lit(best["copy"]).alias("copy"),
        F.lit(best["shuffled"]).alias("shuffled"),
        F.lit(best["size"]).cast("long").alias("size"),
    )


def mix(
    docs: DataFrame,
    *,
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per document: key, size, source, source_size, target, copies sent, words taken, and ``mark``."""
    workspace = workspace or Workspace(docs.sparkSession)
    queue = queued(docs, workspace, weights=weights, repeats=repeats, key=key, text=text, source=source)
    last = _last_sent(queue, repeats)
    sent = F.lit(0)
    if last is not None:
        for copy in range(repeats):
            sent = sent + F.coalesce((_order(copy) <= last).cast("int"), F.lit(0))
    copies = F.when(F.col("size") > 0, sent).otherwise(0)
    return queue.select(
        F.col("key").alias(key),
        F.col("size"),
        F.col("source"),
        F.col("source_size"),
        F.col("target"),
        copies.cast("int").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
        "mark",
    )


def mixed_rows(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of the mix, each document as often as it is sent, with the columns it came with."""
    workspace = options.setdefault("workspace", Workspace(docs.sparkSession))
    found = mix(docs, key=key, text=text, source=source, **options)
    # Equal rows are one row that is sent as often as all of them.
    sums = found.groupBy("mark").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    sent = workspace.write(sums.filter("copies > 0"), "sent")
    each = pick(docs, row_mark(key, text, source), sent)
    return each.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("_row.*")
