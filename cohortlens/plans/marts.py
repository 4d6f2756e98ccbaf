"""Peer-group statistics and the scored outlier mart.

Both work for any grouping keys and any list of metrics; the provider model is one configuration.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.config import METRICS, PEER_KEYS, Metric, OutlierConfig
from cohortlens.functions import any_of, gated_flag, modified_zscore, zscore
from cohortlens.operators.joins import join_groups
from cohortlens.operators.robust import robust_stats
from cohortlens.session import Workspace

IDENTITY = (
    "npi",
    "provider_full_name",
    "taxonomy_code",
    "specialty",
    "state",
    "city",
    "part_d_prescriber_flag",
    "part_b_provider_flag",
)
STATISTICS = ("mean", "stddev", "median", "mad")


def _unique(pairs: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    return list(dict.fromkeys(pairs))


def coverage_counts(metrics: Sequence[Metric]) -> list[Column]:
    """Group size and, per metric, how many members have a value at all."""
    counted = _unique([(m.coverage, m.counted) for m in metrics])
    return [F.count("*").alias("n_providers"), *[F.count(c).alias(n) for n, c in counted]]


def mean_and_stddev(metrics: Sequence[Metric]) -> list[Column]:
    """Mean and sample deviation. Sums of exact types stay exact until the final division."""
    out = []
    for m in metrics:
        mean = F.when(F.count(m.value) > 0, F.sum(m.value).cast("double") / F.count(m.value))
        out.append(mean.alias(f"mean_{m.name}"))
        out.append(F.stddev_samp(F.col(m.value).cast("double")).alias(f"stddev_{m.name}"))
    return out


def complete_keys(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])


def group_stats(
    population: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[Metric],
    workspace: Workspace,
    config: OutlierConfig = OutlierConfig(),
) -> DataFrame:
    """Counts, mean, deviation, median and MAD of every metric, one row per group of sufficient size.

    ``population`` is scanned three times and should be a written table.
    """
    stats = robust_stats(
        population.filter(complete_keys(keys)),
        keys,
        [m.value for m in metrics],
        workspace,
        extra=[*coverage_counts(metrics), *mean_and_stddev(metrics)],
        having=F.col("n_providers") >= config.min_group_n,
        accuracy=config.bracket_accuracy,
    )
    counts = [n for n, _ in _unique([(m.coverage, m.counted) for m in metrics])]
    columns = [F.col(f"mean_{m.name}") for m in metrics] + [F.col(f"stddev_{m.name}") for m in metrics]
    columns += [F.col(f"median_{m.value}").alias(f"median_{m.name}") for m in metrics]
    columns += [F.col(f"mad_{m.value}").alias(f"mad_{m.name}") for m in metrics]
    return stats.select(*keys, "n_providers", *counts, *columns)


def peer_group_stats(
    population: DataFrame,
    taxonomy: DataFrame,
    workspace: Workspace,
    config: OutlierConfig = OutlierConfig(),
) -> DataFrame:
    """Statistics per (taxonomy code, state), with the code's display name."""
    stats = group_stats(population, PEER_KEYS, METRICS, workspace, config)
    names = taxonomy.select("taxonomy_code", "display_name")
    ordered = [
        F.col(f"{statistic}_{m.name}") for m in METRICS for statistic in STATISTICS
    ]
    counts = [n for n, _ in _unique([(m.coverage, m.counted) for m in METRICS])]
    return stats.join(names, "taxonomy_code", "left").select(
        F.col("taxonomy_code").alias("canonical_taxonomy_code"),
        "state",
        "n_providers",
        *counts,
        *ordered,
        F.coalesce("display_name", "taxonomy_code").alias("specialty"),
    )


def score(
    population: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[Metric],
    config: OutlierConfig = OutlierConfig(),
    *,
    spread: bool = False,
) -> DataFrame:
    """Add peer statistics, scores and flags to every member of a group in ``stats``.

    The join is left to the planner: a small written statistics table is broadcast, a large one is
    joined by key, where AQE splits an oversized group. AQE may not do so where an aggregate by the same
    keys follows; with ``spread`` oversized groups are joined in slices instead.
    """
    counts = _unique([(m.coverage, m.peer_n) for m in metrics])
    statistics = [f"{s}_{m.name}" for m in metrics for s in STATISTICS]
    peers = stats.select(
        *keys,
        F.col("n_providers").alias("peer_group_n"),
        *[F.col(n).alias(peer_n) for n, peer_n in counts],
        *statistics,
    )
    joined = join_groups(population, peers, keys, "peer_group_n") if spread else population.join(peers, list(keys))

    def part(prefix: str, m: Metric) -> Column:
        return F.col(f"{prefix}_{m.name}")

    scored = joined.withColumns(
        {
            **{
                f"z_{m.name}": zscore(F.col(m.value).cast("double"), part("mean", m), part("stddev", m))
                for m in metrics
            },
            **{
                f"mz_{m.name}": modified_zscore(
                    F.col(m.value).cast("double"), part("median", m), part("mad", m), config.mad_constant
                )
                for m in metrics
            },
        }
    )
    rules = (("zscore", "z", config.z_threshold), ("mad", "mz", config.mad_threshold))
    flagged = scored.withColumns(
        {
            f"outlier_{rule}_{m.name}": gated_flag(
                part(prefix, m), threshold, F.col(m.peer_n), config.metric_floor
            )
            for rule, prefix, threshold in rules
            for m in metrics
        }
    )
    return flagged.withColumns(
        {
            f"is_outlier_any_{rule}": any_of([F.col(f"outlier_{rule}_{m.name}") for m in metrics])
            for rule, _, _ in reversed(rules)
        }
    )


def outlier_mart(
    population: DataFrame, stats: DataFrame, config: OutlierConfig = OutlierConfig()
) -> DataFrame:
    """The scored provider table. ``population`` is the dimension joined with both facts."""
    facts = [c for c in population.columns if c in _FACTS]
    keyed = stats.withColumnRenamed("canonical_taxonomy_code", "taxonomy_code").drop("specialty")
    return score(population.select(*IDENTITY, *facts), keyed, PEER_KEYS, METRICS, config).select(
        *IDENTITY,
        *facts,
        *mart_columns(),
    )


_FACTS = (
    "part_d_year",
    "total_drug_cost",
    "part_d_total_claims",
    "brand_cost_share",
    "avg_cost_per_claim",
    "part_b_year",
    "total_medicare_payment",
    "part_b_total_services",
)

PEER_COUNTS = ("peer_group_n", "peer_n_part_d", "peer_n_part_b", "peer_n_brand_share", "peer_n_avg_cost_per_claim")


def mart_columns() -> list[str]:
    """Everything the scoring adds, in the mart's column order."""
    return [
        *PEER_COUNTS,
        *[f"{s}_{m.name}" for m in METRICS for s in STATISTICS],
        *[f"z_{m.name}" for m in METRICS],
        *[f"mz_{m.name}" for m in METRICS],
        *[f"outlier_zscore_{m.name}" for m in METRICS],
        *[f"outlier_mad_{m.name}" for m in METRICS],
        "is_outlier_any_mad",
        "is_outlier_any_zscore",
    ]
