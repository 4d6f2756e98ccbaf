"""Classifiers that turn a value into a label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label for the first three characters of a taxonomy code.
SPECIALTY_GROUPINGS = {
    "171": "Other Service Provider",
    "174": "Other Service Provider",
    "193": "Group",
    "207": "Physician",
    "208": "Physician",
    "291": "Laboratory",
    "333": "Supplier",
    "363": "Advanced Practice",
}
OTHER_GROUPING = "Other"

# Upper limit (exclusive) and label of each cost band, then the open top band.
COST_BANDS = (
    (1_000, "1 · <$1k"),
    (10_000, "2 · $1k–10k"),
    (100_000, "3 · $10k–100k"),
    (1_000_000, "4 · $100k–1M"),
    (10_000_000, "5 · $1M–10M"),
)
TOP_COST_BAND = "6 · ≥$10M"

# Lower limit (inclusive) and label of each priority tier, then the rest.
PRIORITY_TIERS = ((1_000_000, "Tier 1 (>=$1M)"), (250_000, "Tier 2 ($250k-$1M)"))
LOWEST_TIER = "Tier 3 (<$250k)"

# Lower limits of the severity bands on the absolute score.
EXTREME_SCORE = 10.0
ELEVATED_SCORE = 3.5


def specialty_grouping(code: Column) -> Column:
    """Coarse specialty from a taxonomy code."""
    by_prefix = F.create_map(*[F.lit(x) for pair in SPECIALTY_GROUPINGS.items() for x in pair])
    return F.coalesce(by_prefix[F.substring(code, 1, 3)], F.lit(OTHER_GROUPING))


def drug_kind(brand: Column, generic: Column) -> Column:
    """"generic" when both names agree up to case, else "brand"; null without a brand name."""
    same = F.coalesce(F.upper(brand) == F.upper(generic), F.lit(False))
    named = F.length(F.trim(brand)) > 0
    return F.when(named, F.when(same, F.lit("generic")).otherwise(F.lit("brand")))


def cost_band(cost: Column) -> Column:
    band = F.lit(TOP_COST_BAND)
    for limit, label in reversed(COST_BANDS):
        band = F.when(cost < limit, F.lit(label)).otherwise(band)
    return band


def priority_tier(amount: Column) -> Column:
    tier = F.lit(LOWEST_TIER)
    for limit, label in reversed(PRIORITY_TIERS):
        tier = F.when(amount >= limit, F.lit(label)).otherwise(tier)
    return tier


def severity_band(score: Column) -> Column:
    """Band of an outlier score for display; null scores have no band."""
    size = F.abs(score)
    return (
        F.when(size >= EXTREME_SCORE, F.lit("extreme"))
        .when(size >= ELEVATED_SCORE, F.lit("elevated"))
        .when(size.isNotNull(), F.lit("typical"))
    )
