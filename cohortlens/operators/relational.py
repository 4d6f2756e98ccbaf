"""Small relational helpers shared by the plans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dominant(attribute: str, weight: str) -> Column:
    """Attribute of the heaviest row; equal weights go to the greatest attribute.

    Rows without a weight do not take part.
    """
    rank = F.when(F.col(weight).isNotNull(), F.struct(F.col(weight), F.col(attribute)))
    return F.max_by(F.col(attribute), rank)


def top_n_per(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of every group. ``order`` has to be total for repeatable results.

    A large group would meet in one task. Each group is therefore ranked in slices first, as many as the
    session has shuffle partitions, and only the best ``n`` of each slice are ranked together. Up to a
    configured ``n`` Spark also cuts every partition before the shuffle (WindowGroupLimit).
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*df.columns), F.lit(slices)))
    return _first_rows(_first_rows(sliced, [*by, "_slice"], order, n).drop("_slice"), by, order, n)


def _first_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def all_ids(key: str, *frames: DataFrame) -> DataFrame:
    """Every key that occurs in any of the frames, once."""
    return union_all([f.select(key) for f in frames]).distinct()


def labelled_union(label: str, frames: dict[str, DataFrame]) -> DataFrame:
    """Stack frames of equal schema, each marked with its name."""
    return union_all([f.select(F.lit(name).alias(label), "*") for name, f in frames.items()])


def histogram(df: DataFrame, value: str, width: float, series: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins: lower edge and row count per series; null values are not counted."""
    edge = F.floor(F.col(value).cast("double") / F.lit(float(width))) * F.lit(float(width))
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(*series, edge.alias("bin_start"))
        .agg(F.count("*").alias("n"))
    )
