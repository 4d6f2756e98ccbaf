"""One unified row per entity, from three overlapping sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import full_name, nonblank
from cohortlens.operators.relational import union_all

UNKNOWN_SPECIALTY = "Unknown"

PROFILE_COLUMNS = (
    "npi",
    "provider_first_name",
    "provider_last_name",
    "provider_credentials",
    "provider_sex_code",
    "taxonomy_code",
    "nucc_grouping",
    "nucc_classification",
    "nucc_specialization",
    "nppes_specialty_grouping",
    "specialty",
    "canonical_taxonomy_code",
    "state",
    "city",
    "practice_zip5",
    "is_in_nppes",
    "is_part_d_prescriber",
    "is_part_b_provider",
)


def _blank_to_null(c: Column) -> Column:
    """Only the empty text counts as missing here; blanks are a value."""
    return F.nullif(c, F.lit(""))


def specialty_chain() -> Column:
    """Display specialty: seed name, then either claim source, then the coarse grouping."""
    return F.coalesce(
        F.col("t.display_name"),
        nonblank(F.col("d.prescriber_specialty_text")),
        nonblank(F.col("b.provider_specialty_text")),
        F.col("n.specialty_grouping"),
        F.lit(UNKNOWN_SPECIALTY),
    )


def state_chain() -> Column:
    sources = ("n.practice_state", "d.prescriber_state", "b.provider_state")
    return F.coalesce(*[_blank_to_null(F.col(c)) for c in sources])


def city_chain() -> Column:
    """Unlike the state, an empty registry city wins over the claim sources."""
    return F.coalesce(
        F.col("n.practice_city"), F.initcap("d.prescriber_city"), F.initcap("b.provider_city")
    )


REGISTRY_INPUTS = (
    "npi",
    "provider_first_name",
    "provider_last_name",
    "provider_credentials",
    "provider_sex_code",
    "primary_taxonomy_code",
    "specialty_grouping",
    "practice_state",
    "practice_city",
    "practice_zip5",
)


def _unified(joined: DataFrame, npi: str) -> DataFrame:
    """Profile columns and facts from rows that hold registry, prescriptions, services and seed as ``n``, ``d``, ``b`` and ``t``."""
    return joined.select(
        F.col(npi).alias("npi"),
        "n.provider_first_name",
        "n.provider_last_name",
        "n.provider_credentials",
        "n.provider_sex_code",
        F.col("n.primary_taxonomy_code").alias("taxonomy_code"),
        F.col("t.grouping").alias("nucc_grouping"),
        F.col("t.classification").alias("nucc_classification"),
        F.col("t.specialization").alias("nucc_specialization"),
        F.col("n.specialty_grouping").alias("nppes_specialty_grouping"),
        specialty_chain().alias("specialty"),
        # Without a registry entry there is no peer group; see the inner join of the mart.
        F.col("n.primary_taxonomy_code").alias("canonical_taxonomy_code"),
        state_chain().alias("state"),
        city_chain().alias("city"),
        "n.practice_zip5",
        F.col("n.npi").isNotNull().alias("is_in_nppes"),
        F.col("d.npi").isNotNull().alias("is_part_d_prescriber"),
        F.col("b.npi").isNotNull().alias("is_part_b_provider"),
        F.col("d.data_year").alias("part_d_year"),
        "d.total_drug_cost",
        F.col("d.total_claims").alias("part_d_total_claims"),
        "d.brand_cost_share",
        "d.avg_cost_per_claim",
        F.col("b.data_year").alias("part_b_year"),
        "b.total_medicare_payment",
        F.col("b.total_services").alias("part_b_total_services"),
    )


def profile_with_facts(
    registry: DataFrame, part_d: DataFrame, part_b: DataFrame, taxonomy: DataFrame
) -> DataFrame:
    """Profile columns plus the yearly facts, one row per entity of any source.

    The profile and the metrics on it need the very same joins, so they are made once here. Entities are those of the
    registry, those of the prescriptions alone and those of the services alone. Each kind is a chain of joins that begins
    with its own source: every join keeps the partitioning by entity, which a union of all ids would lose, and over
    bucketed tables nothing is shuffled. The seed is a file of a few hundred rows and is broadcast by its size.
    """
    n, d, b, t = registry.alias("n"), part_d.alias("d"), part_b.alias("b"), taxonomy.alias("t")
    nowhere = F.lit(False)
    has_id = F.col("n.npi").isNotNull()
    in_registry = (
        n.filter(has_id)
        .join(d, F.col("n.npi") == F.col("d.npi"), "left")
        .join(b, F.col("n.npi") == F.col("b.npi"), "left")
        .join(t, F.col("n.primary_taxonomy_code") == F.col("t.taxonomy_code"), "left")
    )
    prescribing = (
        d.join(n, F.col("d.npi") == F.col("n.npi"), "left_anti")
        .join(b, F.col("d.npi") == F.col("b.npi"), "left")
        .join(n, nowhere, "left")
        .join(t, nowhere, "left")
    )
    serving = (
        b.join(n, F.col("b.npi") == F.col("n.npi"), "left_anti")
        .join(d, F.col("b.npi") == F.col("d.npi"), "left_anti")
        .join(n, nowhere, "left")
        .join(d, nowhere, "left")
        .join(t, nowhere, "left")
    )
    # Registry entries without an id are one entity, of which nothing is known.
    unknown = n.filter(~has_id).select("npi").distinct().alias("a")
    for source in (n, d, b, t):
        unknown = unknown.join(source, nowhere, "left")
    return union_all(
        [_unified(in_registry, "n.npi"), _unified(prescribing, "d.npi"), _unified(serving, "b.npi"), _unified(unknown, "a.npi")]
    )


FACT_COLUMNS = (
    "part_d_year",
    "total_drug_cost",
    "part_d_total_claims",
    "brand_cost_share",
    "avg_cost_per_claim",
    "part_b_year",
    "total_medicare_payment",
    "part_b_total_services",
)


def with_metrics(dim: DataFrame, fct_part_d: DataFrame, fct_part_b: DataFrame) -> DataFrame:
    """Population with its metrics; entities without activity stay, with nulls."""
    part_d = fct_part_d.select(
        "npi",
        F.col("data_year").alias("part_d_year"),
        "total_drug_cost",
        F.col("total_claims").alias("part_d_total_claims"),
        "brand_cost_share",
        "avg_cost_per_claim",
    )
    part_b = fct_part_b.select(
        "npi",
        F.col("data_year").alias("part_b_year"),
        "total_medicare_payment",
        F.col("total_services").alias("part_b_total_services"),
    )
    return dim.join(part_d, "npi", "left").join(part_b, "npi", "left")


def dim_provider(profile: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Entity dimension under display names; ``keep`` passes further columns through."""
    return profile.select(
        "npi",
        full_name(F.col("provider_first_name"), F.col("provider_last_name"), F.col("npi")).alias(
            "provider_full_name"
        ),
        "provider_first_name",
        "provider_last_name",
        "provider_credentials",
        "provider_sex_code",
        F.col("canonical_taxonomy_code").alias("taxonomy_code"),
        "specialty",
        "nucc_grouping",
        "nucc_classification",
        "nucc_specialization",
        "nppes_specialty_grouping",
        "state",
        "city",
        "practice_zip5",
        F.col("is_in_nppes").alias("in_nppes_flag"),
        F.col("is_part_d_prescriber").alias("part_d_prescriber_flag"),
        F.col("is_part_b_provider").alias("part_b_provider_flag"),
        *keep,
    )


def fct_part_d(annual: DataFrame) -> DataFrame:
    """Yearly prescriptions. A name that is brand and generic counts in both distinct counts."""
    return annual.select(
        "npi",
        "data_year",
        "total_claims",
        "total_30day_fills",
        "total_drug_cost",
        "total_day_supply",
        "distinct_generics",
        "distinct_brands",
        (F.col("distinct_generics") + F.col("distinct_brands")).alias("distinct_drugs_total"),
        "brand_claims",
        "generic_claims",
        "brand_drug_cost",
        "generic_drug_cost",
        "brand_claims_share",
        "brand_cost_share",
        "avg_cost_per_claim",
    )


def fct_part_b(annual: DataFrame) -> DataFrame:
    """Yearly services, without the attributes that only feed the profile."""
    return annual.drop("provider_specialty_text", "provider_state", "provider_city")
