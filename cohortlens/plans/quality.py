"""Data-quality checks. ``check_*`` return the offending rows; the summaries count them.

Summaries read a table once for all its columns instead of once per check.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.config import METRICS
from cohortlens.functions import count_if, pct
from cohortlens.operators.relational import union_all


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows."""
    values = df.filter(F.col(column).isNotNull()).groupBy(column)
    return values.agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > 1)


def is_unaccepted(column: str, values: Sequence[str]) -> Column:
    """Present, but none of the accepted values."""
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def check_accepted(
    df: DataFrame, column: str, values: Sequence[str], where: Column | None = None
) -> DataFrame:
    """Values outside the accepted ones; nulls are a matter of ``check_not_null``."""
    rows = df if where is None else df.filter(where)
    return rows.filter(is_unaccepted(column, values))


def check_relationships(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key the parent does not have."""
    return child.filter(F.col(key).isNotNull()).join(parent.select(key), key, "left_anti")


def is_below_floor(floor: int) -> Column:
    """Flagged on some metric against fewer peers than the floor, or in too small a group."""
    broken = [
        F.coalesce(F.col(f"outlier_{rule}_{m.name}"), F.lit(False)) & (F.col(m.peer_n) < floor)
        for rule in ("mad", "zscore")
        for m in METRICS
    ]
    return reduce(Column.__or__, broken, F.col("peer_group_n") < floor)


def check_floor(mart: DataFrame, floor: int = 30) -> DataFrame:
    """Entities flagged against fewer peers than the floor allows, on any metric."""
    counts = dict.fromkeys(m.peer_n for m in METRICS)
    return mart.filter(is_below_floor(floor)).select("npi", "specialty", "state", "peer_group_n", *counts)


def is_outside_unit(column: str) -> Column:
    return (F.col(column) < 0) | (F.col(column) > 1)


def check_unit_interval(df: DataFrame, column: str = "brand_cost_share") -> DataFrame:
    return df.filter(is_outside_unit(column)).select("npi", column)


def flag_rate(mart: DataFrame) -> DataFrame:
    """Share of flagged entities; null for an empty mart."""
    flagged = count_if(F.col("is_outlier_any_mad"))
    total = F.count("*")
    rate = F.when(total > 0, flagged.cast("double") / total)
    return mart.agg(total.alias("total"), flagged.alias("flagged_mad"), rate.alias("flag_rate"))


def check_flag_rate(mart: DataFrame, ceiling: float = 0.08) -> DataFrame:
    """The flag rate, if it reaches the ceiling."""
    return flag_rate(mart).filter(F.col("flag_rate") >= ceiling)


# ---------------------------------------------------------------- summaries

SUMMARY = ("check_name", "n_violations")


def summary(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """Several counts over one table in one pass, as (check, violations) rows."""
    totals = df.agg(*[c.alias(f"_{i}") for i, c in enumerate(counts.values())])
    rows = [
        F.struct(F.lit(name).alias(SUMMARY[0]), F.col(f"_{i}").alias(SUMMARY[1]))
        for i, name in enumerate(counts)
    ]
    return totals.select(F.inline(F.array(*rows)))


def count_violations(name: str, violations: DataFrame) -> DataFrame:
    return violations.agg(F.count("*").alias(SUMMARY[1])).select(F.lit(name).alias(SUMMARY[0]), SUMMARY[1])


def not_null_summary(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    return union_all(
        [
            summary(df, {f"{table}.{c}": count_if(F.col(c).isNull()) for c in columns})
            for table, (df, columns) in tables.items()
        ]
    )


def unique_summary(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    return union_all(
        [count_violations(f"{table}.{c}", check_unique(df, c)) for table, (df, c) in tables.items()]
    )


def accepted_summary(
    tables: dict[str, tuple[DataFrame, dict[str, Sequence[str]], Column | None]]
) -> DataFrame:
    return union_all(
        [
            summary(
                df if where is None else df.filter(where),
                {f"{table}.{c}": count_if(is_unaccepted(c, values)) for c, values in columns.items()},
            )
            for table, (df, columns, where) in tables.items()
        ]
    )


def relationship_summary(children: dict[str, DataFrame], parent: DataFrame, key: str) -> DataFrame:
    return union_all(
        [count_violations(f"{name}.{key}", check_relationships(df, parent, key)) for name, df in children.items()]
    )


def floor_summary(mart: DataFrame, floor: int = 30) -> DataFrame:
    return summary(mart, {"peer_floor": count_if(is_below_floor(floor))})


def mart_totals(floor: int = 30, min_score: float = 1.0) -> dict[str, Column]:
    """What extracts are held against: rows, rows with a state, flagged ones, and rows that each metric's ranking can take."""
    totals = {
        "rows": F.count(F.lit(1)),
        "rows_with_state": count_if(F.col("state").isNotNull()),
        "flagged": count_if(F.col("is_outlier_any_mad")),
    }
    for m in METRICS:
        ranked = F.col(m.value).isNotNull() & (F.col(m.peer_n) >= floor) & (F.abs(f"mz_{m.name}") >= min_score)
        totals[f"ranked:{m.value}"] = count_if(ranked)
    return totals


def check_extracts(
    totals: dict[str, int], kpis: DataFrame, states: DataFrame, ranked: DataFrame, n: int = 1000
) -> DataFrame:
    """Do the extracts agree with the mart and with each other? One row per check.

    Rates must follow from the counts, state rows must add up to the mart, and every metric must
    have the number of ranked rows that the mart can supply, at most ``n``. ``totals`` are the mart's own (``mart_totals``), which
    a build observes while it writes the mart: only the extracts are read here.
    """
    total = F.col("total_providers_in_mart")
    from_kpis = _verdicts(
        kpis,
        {
            "mad_rate_follows": F.col("pct_flagged_mad") == pct(F.col("flagged_mad"), total),
            "zscore_rate_follows": F.col("pct_flagged_zscore") == pct(F.col("flagged_zscore"), total),
            "kpi_rows": total == F.lit(totals["rows"]),
        },
    )
    from_states = _verdicts(
        states.agg(F.sum("n_providers").alias("n"), F.sum("flagged_mad").alias("flagged")),
        {
            "state_rows": F.col("n") == F.lit(totals["rows_with_state"]),
            "state_flags": F.col("flagged") == F.lit(totals["flagged"]),
        },
    )

    spark = kpis.sparkSession
    supply = [(m.value, totals[f"ranked:{m.value}"]) for m in METRICS]
    expected = spark.createDataFrame(supply, "metric string, rows long")
    found = ranked.groupBy("metric").agg(F.count("*").alias("found"))
    from_ranked = _verdicts(
        expected.join(found, "metric", "left").agg(
            F.bool_and(F.coalesce("found", F.lit(0)) == F.least("rows", F.lit(n))).alias("all_agree")
        ),
        {"ranked_rows": F.col("all_agree")},
    )
    return union_all([from_kpis, from_states, from_ranked])


def _verdicts(source: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """One (check, ok) row per condition on a single-row frame; unknown counts as not ok."""
    rows = [
        F.struct(F.lit(name).alias("check_name"), F.coalesce(ok, F.lit(False)).alias("ok"))
        for name, ok in conditions.items()
    ]
    return source.select(F.inline(F.array(*rows)))
