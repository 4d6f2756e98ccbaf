"""Typed views over the raw text tables; one output row per input row, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import drug_kind, specialty_grouping, try_to_dec, try_to_int

# Staged name -> raw name, for the columns that are passed on as text.
PART_D_TEXT = {
    "npi": "prscrbr_npi",
    "prescriber_last_org_name": "prscrbr_last_org_name",
    "prescriber_first_name": "prscrbr_first_name",
    "prescriber_city": "prscrbr_city",
    "prescriber_state": "prscrbr_state_abrvtn",
    "prescriber_state_fips": "prscrbr_state_fips",
    "prescriber_specialty_text": "prscrbr_type",
    "brand_name": "brnd_name",
    "generic_name": "gnrc_name",
    "ge65_suppression_flag": "ge65_sprsn_flag",
    "ge65_beneficiary_suppression_flag": "ge65_bene_sprsn_flag",
}
PART_D_COUNTS = {
    "total_claims": "tot_clms",
    "total_day_supply": "tot_day_suply",
    "total_beneficiaries": "tot_benes",
    "ge65_total_claims": "ge65_tot_clms",
    "ge65_total_day_supply": "ge65_tot_day_suply",
    "ge65_total_beneficiaries": "ge65_tot_benes",
}
PART_D_AMOUNTS = {
    "total_30day_fills": "tot_30day_fills",
    "total_drug_cost": "tot_drug_cst",
    "ge65_total_30day_fills": "ge65_tot_30day_fills",
    "ge65_total_drug_cost": "ge65_tot_drug_cst",
}
PART_B_TEXT = {
    "npi": "rndrng_npi",
    "provider_last_org_name": "rndrng_prvdr_last_org_name",
    "provider_first_name": "rndrng_prvdr_first_name",
    "provider_middle_initial": "rndrng_prvdr_mi",
    "provider_credentials": "rndrng_prvdr_crdntls",
    "provider_entity_code": "rndrng_prvdr_ent_cd",
    "provider_city": "rndrng_prvdr_city",
    "provider_state": "rndrng_prvdr_state_abrvtn",
    "provider_state_fips": "rndrng_prvdr_state_fips",
    "provider_zip5": "rndrng_prvdr_zip5",
    "provider_ruca": "rndrng_prvdr_ruca",
    "provider_ruca_desc": "rndrng_prvdr_ruca_desc",
    "provider_country": "rndrng_prvdr_cntry",
    "provider_specialty_text": "rndrng_prvdr_type",
    "medicare_participating_ind": "rndrng_prvdr_mdcr_prtcptg_ind",
    "hcpcs_code": "hcpcs_cd",
    "hcpcs_description": "hcpcs_desc",
    "hcpcs_drug_indicator": "hcpcs_drug_ind",
    "place_of_service": "place_of_srvc",
}
PART_B_COUNTS = {
    "total_beneficiaries": "tot_benes",
    "total_services": "tot_srvcs",
    "total_bene_day_services": "tot_bene_day_srvcs",
}
PART_B_AVERAGES = {
    "avg_submitted_charge": "avg_sbmtd_chrg",
    "avg_medicare_allowed_amount": "avg_mdcr_alowd_amt",
    "avg_medicare_payment_amount": "avg_mdcr_pymt_amt",
    "avg_medicare_standardized_amount": "avg_mdcr_stdzd_amt",
}
REGISTRY_AS_IS = (
    "npi",
    "entity_type_code",
    "provider_last_name",
    "provider_first_name",
    "provider_middle_name",
    "provider_credentials",
    "provider_sex_code",
    "primary_taxonomy_code",
)


def _text(names: dict[str, str]) -> list[Column]:
    return [F.col(raw).alias(name) for name, raw in names.items()]


def _counts(names: dict[str, str]) -> list[Column]:
    return [try_to_int(F.col(raw)).alias(name) for name, raw in names.items()]


def _decimals(names: dict[str, str], scale: int) -> list[Column]:
    return [try_to_dec(F.col(raw), 18, scale).alias(name) for name, raw in names.items()]


def _provenance(data_year: int) -> list[Column]:
    return [F.lit(data_year).alias("data_year"), F.col("_loaded_at").alias("loaded_at")]


def stg_part_d(raw: DataFrame, data_year: int = 2023) -> DataFrame:
    """Entity x drug rows. Suppressed rows stay; only their beneficiary count is missing."""
    return raw.select(
        *_text(PART_D_TEXT),
        drug_kind(F.col("brnd_name"), F.col("gnrc_name")).alias("drug_kind"),
        *_counts(PART_D_COUNTS),
        *_decimals(PART_D_AMOUNTS, 2),
        # The raw text decides: an unreadable count was published, a missing one was suppressed.
        F.col("tot_benes").isNull().alias("is_beneficiary_count_suppressed"),
        *_provenance(data_year),
    )


def stg_part_b(raw: DataFrame, data_year: int = 2023) -> DataFrame:
    """Entity x service x place rows."""
    return raw.select(
        *_text(PART_B_TEXT),
        *_counts(PART_B_COUNTS),
        *_decimals(PART_B_AVERAGES, 4),
        *_provenance(data_year),
    )


def stg_registry(raw: DataFrame) -> DataFrame:
    """One row per registered entity. Dates stay text. ``initcap`` splits words at blanks only."""
    return raw.select(
        *REGISTRY_AS_IS,
        F.upper(F.trim("practice_state")).alias("practice_state"),
        F.initcap(F.trim("practice_city")).alias("practice_city"),
        F.left(F.trim("practice_zip"), F.lit(5)).alias("practice_zip5"),
        specialty_grouping(F.col("primary_taxonomy_code")).alias("specialty_grouping"),
        F.col("enumeration_date").alias("enumeration_date_raw"),
        F.col("last_update_date").alias("last_update_date_raw"),
        F.col("_loaded_at").alias("loaded_at"),
    )
