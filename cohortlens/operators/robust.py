"""Exact medians and median absolute deviations that hold up under skewed groups.

``median()`` keeps every distinct value of a group in one aggregation buffer, and a median window
sends a whole group to one task. Either breaks once a single group holds a large part of the rows.
Here each pass over the data is a plain ``groupBy().agg()`` that combines on the map side:

1. a mergeable quantile sketch per group gives a narrow bracket around the median;
2. values outside the bracket are replaced by minus or plus infinity, which leaves the median as it
   is but collapses them into two entries of the aggregation buffer. What remains is the share of
   a group inside the bracket, below a thousandth of its rows at the default accuracy.

Where the planner broadcasts the brackets the rows themselves are not shuffled, only a row per group and
task is; with more groups than that the rows are joined by group, the oversized ones in slices (see
``join_groups``). A group smaller than the sketch's accuracy is carried by its sketch almost whole.

Results are exact. Should a sketch miss, the clipped median comes out infinite and its sign tells the side.
Only such groups are read again: their next bracket lies just outside the last one and is as
narrow, and so on outward until the median is found. A group whose sketched middle is itself infinite, or not a
number, is final at once.

Deviations need one pass more. Pass 2 also sketches ``|x - m|`` around the sketched median ``m``.
By the triangle inequality, moving the centre to the exact median shifts no deviation by more than
the distance between both centres, so that sketch, widened by this distance, brackets the MAD.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators.joins import join_groups
from cohortlens.session import Workspace

DEFAULT_ACCURACY = 10_000
GROUP_ROWS = "_group_rows"

# Half the width of the first bracket, and how far each further one reaches beyond it, in sketch errors.
_FIRST_SPREAD = 2.0
_NEXT_SPREAD = 64.0

# Aggregation buffers a task holds before Spark sorts its input instead; sketches of small groups are small.
_GROUPS_IN_MEMORY = 20_000
_FALLBACK = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"


@contextmanager
def many_groups(spark: SparkSession):
    """While active, aggregates over many groups are hashed rather than sorted."""
    before = spark.conf.get(_FALLBACK)
    spark.conf.set(_FALLBACK, str(max(int(before), _GROUPS_IN_MEMORY)))
    try:
        yield
    finally:
        spark.conf.set(_FALLBACK, before)



# The aggregates are written as SQL text: wide statistics take hundreds of them, and every Column
# call costs a round trip to the JVM.


def _value(name: str) -> str:
    return f"cast(`{name}` as double)"


def _bracket(value: str, accuracy: int, spread: float) -> Column:
    """Sketched quantiles just below, at and just above the middle."""
    reach = min(spread / accuracy, 0.5)
    return F.expr(f"percentile_approx({value}, array({0.5 - reach!r}D, 0.5D, {0.5 + reach!r}D), {accuracy})")


def _clipped_median(value: str, low: str, high: str) -> Column:
    infinity = "double('infinity')"
    return F.expr(
        f"median(case when {value} < {low} then -{infinity} when {value} > {high} then {infinity} else {value} end)"
    )


def _is_missed(result: str, middle: str) -> Column:
    """Did the bracket fail to hold the median? Then the clipped one is infinite while the middle is not."""
    infinity = "double('infinity')"
    return F.expr(f"coalesce(abs({result}) = {infinity} and abs({middle}) < {infinity}, false)")


def _settled(
    df: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    names: tuple[str, str, str],
    bounds: dict[str, tuple[str, str]],
    workspace: Workspace,
    accuracy: int,
) -> DataFrame:
    """``table`` with the results of missed groups searched for further out.

    ``names`` are the prefixes of result, sketched middle and centre; a centre makes it a search among deviations.
    ``bounds`` has the expressions of the last bracket. Few groups are read again, if any; each attempt covers as
    much of them as the one before, so no buffer grows beyond that share of a group.
    """
    result, middle, centre = names
    flags = [F.coalesce(F.bool_or(_is_missed(f"`{result}{c}`", f"`{middle}{c}`[1]")), F.lit(False)) for c in cols]
    for c, missed_any in zip(cols, table.agg(*flags).first(), strict=True):
        if not missed_any:
            continue
        low, high = bounds[c]
        value = f"abs({_value(c)} - centre)" if centre else _value(c)
        found = table.select(
            *keys,
            GROUP_ROWS,
            F.col(f"{result}{c}").alias("result"),
            F.expr(low).alias("low"),
            F.expr(f"`{middle}{c}`[1]").alias("middle"),
            F.expr(high).alias("high"),
            (F.col(f"{centre}{c}") if centre else F.lit(None).cast("double")).alias("centre"),
        )
        settled, attempt, reach = [], 0, 0.0
        missed = found.filter(_is_missed("result", "middle"))
        while reach < 0.5 and not missed.isEmpty():
            attempt += 1
            reach = min((_FIRST_SPREAD + _NEXT_SPREAD * attempt) / accuracy, 0.5)
            rows = join_groups(df.select(*keys, c), missed, keys, GROUP_ROWS)
            ends = f"percentile_approx({value}, array({0.5 - reach!r}D, {0.5 + reach!r}D), {accuracy})"
            edges = workspace.write(rows.groupBy(*keys).agg(F.expr(ends).alias("ends")), "edges")
            outer = missed.join(edges, list(keys)).select(
                *keys,
                GROUP_ROWS,
                "middle",
                "centre",
                F.expr("if(result < 0, least(ends[0], low), high)").alias("low"),
                F.expr("if(result < 0, low, greatest(ends[1], high))").alias("high"),
            )
            rows = join_groups(df.select(*keys, c), workspace.write(outer, "brackets"), keys, GROUP_ROWS)
            again = rows.groupBy(*keys, GROUP_ROWS, "middle", "centre", "low", "high").agg(
                _clipped_median(value, "low", "high").alias("result")
            )
            found = workspace.write(again, "settled")
            last = reach >= 0.5
            missed = found.filter(_is_missed("result", "middle"))
            settled.append(found if last else found.filter(~_is_missed("result", "middle")))
        if settled:
            fixed = reduce(DataFrame.unionByName, settled).select(*keys, F.col("result").alias("_settled"))
            better = F.coalesce("_settled", f"{result}{c}").alias(f"{result}{c}")
            others = [name for name in table.columns if name not in (*keys, f"{result}{c}")]
            table = table.join(fixed, list(keys), "left").select(*keys, *others, better)
    return table


def _first_pass(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], extra: Sequence[Column], accuracy: int, spread: float
) -> DataFrame:
    near = [_bracket(_value(c), accuracy, spread).alias(f"near_{c}") for c in cols]
    return df.groupBy(*keys).agg(F.count("*").alias(GROUP_ROWS), *extra, *near)


def _second_pass(
    df: DataFrame,
    near: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    deviations: bool,
    accuracy: int,
    spread: float,
) -> DataFrame:
    aggregates = []
    for c in cols:
        low, middle, high = (f"`near_{c}`[{i}]" for i in range(3))
        aggregates.append(_clipped_median(_value(c), low, high).alias(f"median_{c}"))
        if deviations:
            around = f"abs({_value(c)} - {middle})"
            aggregates.append(_bracket(around, accuracy, spread).alias(f"dev_{c}"))
            aggregates.append(F.expr(f"max({middle})").alias(f"middle_{c}"))
    brackets = near.select(*keys, GROUP_ROWS, *[f"near_{c}" for c in cols])
    rows = join_groups(df.select(*keys, *cols), brackets, keys, GROUP_ROWS)
    return rows.groupBy(*keys).agg(F.count("*").alias(GROUP_ROWS), *aggregates)


def _deviation_bounds(c: str) -> tuple[str, str]:
    """Bracket of the deviations around the exact median, from the sketch around the sketched one."""
    median, low, high = f"`median_{c}`", f"`dev_{c}`[0]", f"`dev_{c}`[2]"
    # The relative part absorbs rounding.
    reach = f"(abs({median} - `middle_{c}`) + 1e-9D * (abs({median}) + {high}))"
    return f"({low} - {reach})", f"({high} + {reach})"


def _third_pass(df: DataFrame, centres: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    aggregates = []
    for c in cols:
        around = f"abs({_value(c)} - `median_{c}`)"
        aggregates.append(_clipped_median(around, *_deviation_bounds(c)).alias(f"mad_{c}"))
    return join_groups(df.select(*keys, *cols), centres, keys, GROUP_ROWS).groupBy(*keys).agg(*aggregates)


def group_medians(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    workspace: Workspace,
    *,
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """Exact interpolated median of each column per group, as ``median_<col>``.

    ``df`` is read twice and should come from a written table. Groups with a null key are left out.
    """
    with many_groups(df.sparkSession):
        near = workspace.write(_first_pass(df, keys, cols, (), accuracy, _FIRST_SPREAD), "brackets")
        medians = workspace.write(_second_pass(df, near, keys, cols, False, accuracy, _FIRST_SPREAD), "medians")
        table = medians.join(near.drop(GROUP_ROWS), list(keys))
        exact = _settled(df, table, keys, cols, ("median_", "near_", ""), _near_bounds(cols), workspace, accuracy)
    return exact.select(*keys, *[f"median_{c}" for c in cols])


def _near_bounds(cols: Sequence[str]) -> dict[str, tuple[str, str]]:
    return {c: (f"`near_{c}`[0]", f"`near_{c}`[2]") for c in cols}


def with_group_median(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    workspace: Workspace,
    *,
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """Each row with the medians of its group; rows without a complete key get nulls."""
    medians = group_medians(df, keys, cols, workspace, accuracy=accuracy)
    return df.join(medians, list(keys), "left")


def robust_stats(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    workspace: Workspace,
    *,
    extra: Sequence[Column] = (),
    having: Column | None = None,
    accuracy: int = DEFAULT_ACCURACY,
) -> DataFrame:
    """Exact ``median_<col>`` and ``mad_<col>`` per group, next to any ``extra`` aggregates.

    ``extra`` rides along in the first pass. ``having`` may use the extra aggregates; groups it
    drops are skipped by the later passes. ``df`` is read three times and should be a written table.
    """
    with many_groups(df.sparkSession):
        first = _first_pass(df, keys, cols, extra, accuracy, _FIRST_SPREAD)
        if having is not None:
            first = first.filter(having)
        first = workspace.write(first, "brackets")
        second = workspace.write(_second_pass(df, first, keys, cols, True, accuracy, _FIRST_SPREAD), "medians")
        near = first.select(*keys, *[f"near_{c}" for c in cols])
        table = second.join(near, list(keys))
        second = _settled(df, table, keys, cols, ("median_", "near_", ""), _near_bounds(cols), workspace, accuracy)
        third = workspace.write(_third_pass(df, second, keys, cols), "deviations")
        table = second.join(third, list(keys))
        bounds = {c: _deviation_bounds(c) for c in cols}
        exact = _settled(df, table, keys, cols, ("mad_", "dev_", "median_"), bounds, workspace, accuracy)
    exact = exact.select(*keys, *[f"{p}_{c}" for c in cols for p in ("median", "mad")])
    return first.drop(GROUP_ROWS, *[f"near_{c}" for c in cols]).join(exact, list(keys))
