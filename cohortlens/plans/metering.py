"""Usage reports over a meter table and a job log. "Now" is an argument."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.sources.loadchecks import moment

# The kinds of statement that move data.
QUERY_TYPES = ("SELECT", "CREATE_TABLE_AS_SELECT", "COPY", "INSERT", "MERGE")


def _since(now: datetime | str, days: int) -> Column:
    """Rows of the last ``days`` calendar days; the filter reaches the scan."""
    first_day = F.date_sub(moment(now).cast("date"), days).cast("timestamp_ntz")
    return F.col("start_time") >= first_day


def daily_usage(meter: DataFrame, now: datetime | str, days: int = 30) -> DataFrame:
    """Credits per day and warehouse."""
    # Through the date: truncating a time without zone would go through the session's zone.
    day = F.col("start_time").cast("date").cast("timestamp_ntz")
    return (
        meter.filter(_since(now, days))
        .groupBy(day.alias("usage_date"), "warehouse_name")
        .agg(
            F.round(F.sum("credits_used"), 3).alias("credits"),
            F.round(F.sum("credits_used_cloud_services"), 3).alias("credits_cloud_services"),
        )
        .orderBy(F.col("usage_date").desc(), F.col("credits").desc(), "warehouse_name")
    )


def top_k_jobs(
    log: DataFrame,
    now: datetime | str,
    warehouse: str,
    query_types: Sequence[str] = QUERY_TYPES,
    days: int = 7,
    k: int = 20,
) -> DataFrame:
    """The longest jobs of the last days, with readable units and a preview of the text."""
    return (
        log.filter(
            _since(now, days)
            & (F.col("warehouse_name") == warehouse)
            & F.col("query_type").isin(*query_types)
        )
        .orderBy(F.col("total_elapsed_time").desc(), "query_id")
        .limit(k)
        .select(
            "query_id",
            "user_name",
            "warehouse_name",
            "warehouse_size",
            "query_type",
            F.round(F.col("total_elapsed_time") / F.lit(1000.0), 1).alias("elapsed_sec"),
            F.round(F.col("bytes_scanned") / F.pow(F.lit(2.0), F.lit(30)), 2).alias("gb_scanned"),
            "rows_produced",
            "start_time",
            F.left("query_text", F.lit(120)).alias("query_preview"),
        )
    )


def usage_runway(meter: DataFrame, budget: float, now: datetime | str, days: int = 7) -> DataFrame:
    """How long the budget lasts at the recent burn; no burn, no forecast.

    Total and recent use come from the same pass, so there is nothing to join.
    """
    recent = F.when(_since(now, days), F.col("credits_used"))
    used, recent_used = F.col("used").cast("double"), F.col("recent").cast("double")
    left = F.lit(float(budget)) - used
    burn = recent_used / F.lit(float(days))
    return meter.agg(F.sum("credits_used").alias("used"), F.sum(recent).alias("recent")).select(
        F.round(used, 2).alias("credits_used_total"),
        F.lit(float(budget)).alias("credit_budget"),
        F.round(left, 2).alias("credits_remaining"),
        F.round(F.lit(100.0) * used / F.lit(float(budget)), 1).alias("pct_consumed"),
        F.round(burn, 3).alias("avg_daily_burn_last_7d"),
        F.when(recent_used > 0, F.round(left / burn, 1)).alias("days_remaining_at_recent_burn"),
    )
