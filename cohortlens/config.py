"""Tunables and the registry of scored metrics."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Metric:
    """One scored measure.

    ``name`` is the suffix of every derived column (``mean_<name>``, ``mz_<name>``, ...),
    ``value`` the entity's own column, ``coverage`` the peer-stats column that counts the
    peers standing behind the statistic, and ``counted`` the column that count is taken over.
    """

    name: str
    value: str
    coverage: str
    counted: str

    @property
    def peer_n(self) -> str:
        """Name of the coverage count once it sits on a scored entity."""
        stem = self.coverage.removeprefix("n_").removesuffix("_observed")
        return f"peer_n_{stem}"


# The six metrics, their columns and the count that gates each of them.
METRICS = (
    Metric("drug_cost", "total_drug_cost", "n_part_d", "total_drug_cost"),
    Metric("part_d_claims", "part_d_total_claims", "n_part_d", "total_drug_cost"),
    Metric("brand_cost_share", "brand_cost_share", "n_brand_share_observed", "brand_cost_share"),
    Metric("avg_cost_per_claim", "avg_cost_per_claim", "n_avg_cost_per_claim_observed", "avg_cost_per_claim"),
    Metric("part_b_payment", "total_medicare_payment", "n_part_b", "total_medicare_payment"),
    Metric("part_b_services", "part_b_total_services", "n_part_b", "total_medicare_payment"),
)

METRIC_BY_VALUE = {m.value: m for m in METRICS}

PEER_KEYS = ("taxonomy_code", "state")


@dataclass(frozen=True)
class OutlierConfig:
    """Every threshold of the outlier rules, with the published defaults."""

    min_group_n: int = 30
    metric_floor: int = 30
    z_threshold: float = 2.0
    mad_threshold: float = 3.5
    mad_constant: float = 0.6745
    # Rank accuracy of the bracket that the exact medians are searched in (1/accuracy of a group).
    bracket_accuracy: int = 10_000
