"""Records of CSV files whose quoted fields may hold line breaks, found by many tasks per file.

Whether a line begins a record depends on all quotes before it. But a line, and so a split of a file, can only do one of four
things to the state "inside quotes": keep it, turn it, or leave it inside or outside whatever it was. These maps compose: each
split's lines give the map of the split, the maps of the splits before it give its start state, and the start state
tells which of its lines begin a record. Records that end in the split they begin in are put together there; only
the pieces at the borders of splits, two per split at most, are put together across them.

A quote opens a field only where one starts, at the beginning of a record or after a comma; anywhere else outside quotes it is a character
like others. Inside, a doubled quote is one character and a single one closes the field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlens.session import Workspace

QUOTE, COMMA = '"', ","
SPLIT = ("file", "start")

# States of the scan of a line, looked at just before a quote.
UNQUOTED, INSIDE, CLOSED, AT_START = 0, 1, 2, 3


class BrokenQuotes(ValueError):
    """A quoted field does not end where it should."""


def ends_inside(line: Column, inside: bool) -> Column:
    """Whether the line's end lies inside a quoted field, if its beginning does (``inside``) or begins a record."""

    def after_quote(state: Column, before: Column) -> Column:
        """State after a quote, ``before`` being the text between it and the quote before it."""
        opens = F.endswith(before, F.lit(COMMA)) | ((before == "") & state.isin(CLOSED, AT_START))
        return F.when(state == INSIDE, F.lit(CLOSED)).when(opens, F.lit(INSIDE)).otherwise(F.lit(UNQUOTED))

    between = F.split(line, QUOTE)
    start = F.lit(INSIDE if inside else AT_START)
    state = F.aggregate(F.slice(between, F.lit(1), F.size(between) - 1), start, after_quote)
    return F.when(F.contains(line, F.lit(QUOTE)), state == INSIDE).otherwise(F.lit(inside))


def read_lines(spark: SparkSession, path: str | list[str], exclude: str | None = None) -> DataFrame:
    """Lines with their ``file``, the ``start`` of the split that reads them, and ``place``, rising within a split."""
    lines = spark.read.text(path, lineSep="\n")
    if exclude is not None:
        lines = lines.filter(~F.col("_metadata.file_name").contains(exclude))
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        F.col("value").alias("line"),
    )


def with_state(rows: DataFrame, by: str, order: str, start: Column) -> DataFrame:
    """``rows`` with ``before`` and ``after``: inside quotes before and after each, in order.

    ``from_out`` and ``from_in`` are a row's map; the state before the first row of each group is ``start``. It is that which
    the last row with a constant map leaves, turned once by every turning row since.
    """
    earlier = W.partitionBy(*by.split()).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    turns = F.col("from_out") & ~F.col("from_in")
    fixed = F.col("from_out") == F.col("from_in")
    counted = rows.withColumn("_turns", F.coalesce(F.count_if(turns).over(earlier), F.lit(0)))
    left = F.when(fixed, F.struct(F.col("from_out").alias("state"), F.col("_turns").alias("turns")))
    since = counted.withColumn("_left", F.last(left, ignorenulls=True).over(earlier))
    known = F.col("_left").isNotNull()
    base = F.when(known, F.col("_left.state")).otherwise(start)
    turned = (F.col("_turns") - F.when(known, F.col("_left.turns")).otherwise(0)) % 2 == 1
    before = since.withColumn("before", base != turned)
    return before.withColumn("after", F.when(F.col("before"), F.col("from_in")).otherwise(F.col("from_out"))).drop("_turns", "_left")


def split_states(lines: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """Per ``file`` and ``start`` of a split the state ``inside`` that it begins with, and the state ``after`` it."""
    # The last line with a constant map sets the state, each turning line after it turns it: two aggregates, nothing is put in order.
    fixed = F.col("from_out") == F.col("from_in")
    # Place and state in one number, which a hash aggregate can hold.
    last = F.max(F.when(fixed, 2 * F.col("place") + F.col("from_out").cast("long"))).alias("last")
    splits = workspace.write(lines.groupBy(*SPLIT).agg(last), "split-ends") if workspace else lines.groupBy(*SPLIT).agg(last)
    turning = lines.filter(F.col("from_out") & ~F.col("from_in")).select(*SPLIT, "place")
    later = turning.join(splits, list(SPLIT)).filter(F.col("last").isNull() | (2 * F.col("place") > F.col("last")))
    odd = later.groupBy(*SPLIT).agg((F.count("*") % 2 == 1).alias("odd"))
    turned = F.coalesce("odd", F.lit(False))

    def end(inside: bool) -> Column:
        return F.coalesce(F.col("last") % 2 == 1, F.lit(inside)) != turned

    whole = splits.join(odd, list(SPLIT), "left").select(*SPLIT, end(False).alias("from_out"), end(True).alias("from_in"))
    return with_state(whole, "file", "start", F.lit(False)).select(*SPLIT, F.col("before").alias("inside"), "after")


def records(
    spark: SparkSession,
    path: str | list[str],
    *,
    header: bool = True,
    exclude: str | None = None,
    workspace: Workspace | None = None,
) -> DataFrame:
    """One ``record`` per row of the files, blank lines and each file's ``header`` left out.

    The lines are landed once, with their maps, as a table of columns: the states need no text, and every later reader sees
    the same splits. A field that is still open at the end of a file raises ``BrokenQuotes``.
    """
    workspace = workspace or Workspace(spark)
    lines = read_lines(spark, path, exclude)
    maps = {"from_out": ends_inside(F.col("line"), False), "from_in": ends_inside(F.col("line"), True)}
    landed = workspace.write(lines.withColumns(maps), "lines")
    states = workspace.write(split_states(landed, workspace), "split-states")
    last = states.groupBy("file").agg(F.max_by("after", "start").alias("open")).filter("open").first()
    if last is not None:
        raise BrokenQuotes(f"unbalanced quotes: a field is open at the end of {last['file']!r}")

    placed = with_state(landed.join(states.select(*SPLIT, "inside"), list(SPLIT)), "file start", "place", F.col("inside"))
    blank = ~F.col("before") & F.rtrim(F.col("line"), F.lit("\r")).eqNullSafe("")
    begins = ~F.col("before") & ~blank
    upto = W.partitionBy(*SPLIT).orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    numbered = placed.withColumns({"number": F.count_if(begins).over(upto), "blank": blank}).filter(~F.col("blank"))
    # Lines before the first beginning, number 0, end a record of an earlier split.
    in_order = F.array_sort(F.collect_list(F.struct("place", "line")))
    pieces = numbered.groupBy(*SPLIT, "number").agg(
        F.array_join(F.transform(in_order, lambda x: x["line"]), "\n").alias("text"),
        F.max_by("after", "place").alias("open"),
    )
    pieces = pieces.withColumn("header", F.lit(header) & (F.col("start") == 0) & (F.col("number") == 1))
    whole = pieces.filter((F.col("number") > 0) & ~F.col("open")).select("text", "header")
    border = pieces.filter((F.col("number") == 0) | F.col("open"))
    by_file = W.partitionBy("file").orderBy("start", "number").rowsBetween(W.unboundedPreceding, 0)
    owned = border.withColumn("owner", F.count_if(F.col("number") > 0).over(by_file))
    parts = F.array_sort(F.collect_list(F.struct("start", "number", "text")))
    joined = owned.groupBy("file", "owner").agg(
        F.array_join(F.transform(parts, lambda x: x["text"]), "\n").alias("text"), F.max("header").alias("header")
    )
    every = whole.unionAll(joined.select("text", "header"))
    return every.filter(~F.col("header")).select(F.rtrim(F.col("text"), F.lit("\r")).alias("record"))
