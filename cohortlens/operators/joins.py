"""Joining per-group values onto rows when a single group may hold a large part of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A group is divided when it holds at least this share of all rows; there can be no more such
# groups than the share's inverse.
MAX_HOT_GROUPS = 1000


def join_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], size: str) -> DataFrame:
    """Inner join of rows with a written table of one row per group.

    A plain join by key would gather the rows of an oversized group in one task, and whatever aggregates
    them next would reuse that partitioning, which AQE may not split. Groups are therefore told apart by
    their number of rows in ``size``: the oversized ones, few by definition, are broadcast as a list of keys,
    their rows are dealt to as many slices as the session has shuffle partitions, and their values are
    repeated for each slice. All others have one slice. The join is by key and slice.
    """
    slices = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = groups.agg(F.sum(size)).first()[0] or 0
    is_hot = F.col(size) * MAX_HOT_GROUPS >= F.lit(total)
    hot = groups.filter(is_hot).select(*keys, F.lit(True).alias("_hot"))
    # Rows of one scan partition share a slice, which a retried task repeats.
    dealt = F.when(F.col("_hot"), F.pmod(F.spark_partition_id(), F.lit(slices))).otherwise(0)
    sliced = rows.join(F.broadcast(hot), list(keys), "left").withColumn("_slice", dealt).drop("_hot")
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(slices - 1))).otherwise(F.array(F.lit(0)))
    return sliced.join(groups.withColumn("_slice", F.explode(every)), [*keys, "_slice"]).drop("_slice")
