"""Checks on freshly loaded sources."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.relational import union_all


@dataclass(frozen=True)
class Freshness:
    """Age in days from which a source is reported."""

    warn_after: int
    error_after: int


# Windows for the yearly files and for the monthly registry.
YEARLY = Freshness(540, 730)
MONTHLY = Freshness(60, 180)


def moment(now: datetime | str) -> Column:
    """A fixed point in time, so that repeated runs agree."""
    return F.lit(str(now)).cast("timestamp_ntz")


def source_freshness(df: DataFrame, loaded_at: str, window: Freshness, now: datetime | str) -> DataFrame:
    """Latest load, its age in whole days and the verdict; an empty source is an error."""
    newest = df.agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("max_loaded_at"))
    age = F.datediff(moment(now), F.col("max_loaded_at"))
    status = (
        F.when(F.col("max_loaded_at").isNull() | (age > window.error_after), F.lit("error"))
        .when(age > window.warn_after, F.lit("warn"))
        .otherwise(F.lit("ok"))
    )
    return newest.select("max_loaded_at", age.alias("age_days"), status.alias("status"))


def validate_load(sources: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Rows, distinct keys, null keys and the load time span of each (table, key, load time)."""
    return union_all(
        [
            df.agg(
                F.count("*").alias("row_count"),
                F.count_distinct(F.col(key)).alias("distinct_keys"),
                F.count_if(F.col(key).isNull()).alias("null_keys"),
                F.min(loaded_at).alias("earliest"),
                F.max(loaded_at).alias("latest"),
            ).select(F.lit(name).alias("source_table"), "*")
            for name, (df, key, loaded_at) in sources.items()
        ]
    )
