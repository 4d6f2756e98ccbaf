"""What must hold for every table of the model: the declared checks, and the counts a write takes along.

Row-level checks need one look at every row. For tables that a build writes, that look is the write itself: the counts are
observed on the rows as they are written, and checking costs no scan. The observed node is the last one before the files, so that a
repeated task counts once; views are scanned instead, as a shuffle above them could repeat rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlens.config import OutlierConfig
from cohortlens.functions import count_if
from cohortlens.functions.labels import OTHER_GROUPING, SPECIALTY_GROUPINGS
from cohortlens.plans import quality


@dataclass(frozen=True)
class TableChecks:
    """Checks declared for one table; nulls are never outside the accepted values."""

    not_null: tuple[str, ...]
    unique: tuple[str, ...] = ()
    accepted: dict[str, tuple[str, ...]] = field(default_factory=dict)
    in_dimension: bool = False


GROUPING_LABELS = tuple(dict.fromkeys([*SPECIALTY_GROUPINGS.values(), OTHER_GROUPING]))

# The declared checks of every table.
DECLARED = {
    "stg_part_d": TableChecks(
        ("npi", "total_claims", "is_beneficiary_count_suppressed", "data_year"),
        accepted={"drug_kind": ("brand", "generic")},
    ),
    "stg_part_b": TableChecks(("npi", "hcpcs_code", "data_year"), accepted={"provider_entity_code": ("I", "O")}),
    "stg_registry": TableChecks(
        ("npi", "specialty_grouping"),
        unique=("npi",),
        accepted={"entity_type_code": ("1",), "specialty_grouping": GROUPING_LABELS},
    ),
    "taxonomy": TableChecks(("taxonomy_code", "display_name"), unique=("taxonomy_code",)),
    "part_d_annual": TableChecks(("npi",), unique=("npi",)),
    "part_b_annual": TableChecks(("npi",), unique=("npi",)),
    "provider_profile": TableChecks(
        ("npi", "is_in_nppes", "is_part_d_prescriber", "is_part_b_provider"), unique=("npi",)
    ),
    "peer_group_stats": TableChecks(
        (
            "canonical_taxonomy_code",
            "specialty",
            "state",
            "n_providers",
            "n_part_d",
            "n_part_b",
            "n_brand_share_observed",
            "n_avg_cost_per_claim_observed",
        )
    ),
    "dim_provider": TableChecks(("npi",), unique=("npi",)),
    "fct_part_d": TableChecks(("npi",), unique=("npi",), in_dimension=True),
    "fct_part_b": TableChecks(("npi",), unique=("npi",), in_dimension=True),
    "mart": TableChecks(
        (
            "npi",
            "specialty",
            "state",
            "peer_group_n",
            "peer_n_part_d",
            "peer_n_part_b",
            "peer_n_brand_share",
            "peer_n_avg_cost_per_claim",
            "is_outlier_any_mad",
            "is_outlier_any_zscore",
        ),
        in_dimension=True,
    ),
}


# A table's row-level checks that another one's rows answer: the same rows under the same names.
SAME_ROWS = {"dim_provider": "provider_profile", "fct_part_d": "part_d_annual", "fct_part_b": "part_b_annual"}


def row_counts(name: str, config: OutlierConfig) -> dict[str, Column]:
    """Violations of the table's row-level checks, as aggregates over its rows."""
    checks = DECLARED[name]
    counts = {f"not_null:{name}.{c}": count_if(F.col(c).isNull()) for c in checks.not_null}
    for c, values in checks.accepted.items():
        counts[f"accepted:{name}.{c}"] = count_if(quality.is_unaccepted(c, values))
    if name == "part_d_annual":
        counts["unit_interval:part_d_annual.brand_cost_share"] = count_if(quality.is_outside_unit("brand_cost_share"))
    if name == "mart":
        counts["floor:mart"] = count_if(quality.is_below_floor(config.metric_floor))
    return counts


def observed_counts(name: str, config: OutlierConfig) -> dict[str, Column]:
    """All that is counted while the table is written: its checks, those of its projections, and the mart's totals."""
    counts = row_counts(name, config)
    for other, source in SAME_ROWS.items():
        if source == name:
            counts |= row_counts(other, config)
    return counts | (quality.mart_totals(config.metric_floor) if name == "mart" else {})
