"""Schemas of the raw text tables (fixed values)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T


def all_text(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


RAW_PART_D = all_text(
    """
    prscrbr_npi prscrbr_last_org_name prscrbr_first_name prscrbr_city prscrbr_state_abrvtn
    prscrbr_state_fips prscrbr_type prscrbr_type_src brnd_name gnrc_name tot_clms tot_30day_fills
    tot_day_suply tot_drug_cst tot_benes ge65_sprsn_flag ge65_tot_clms ge65_tot_30day_fills
    ge65_tot_drug_cst ge65_tot_day_suply ge65_bene_sprsn_flag ge65_tot_benes
    """.split()
)

RAW_REGISTRY = all_text(
    """
    npi entity_type_code provider_last_name provider_first_name provider_middle_name
    provider_credentials practice_city practice_state practice_zip provider_sex_code
    primary_taxonomy_code enumeration_date last_update_date deactivation_date
    """.split()
)

TAXONOMY_SEED = all_text(
    ("taxonomy_code", "grouping", "classification", "specialization", "display_name")
)

# Short name -> header of the published registry file.
REGISTRY_HEADERS = {
    "npi": "NPI",
    "entity_type_code": "Entity Type Code",
    "provider_last_name": "Provider Last Name (Legal Name)",
    "provider_first_name": "Provider First Name",
    "provider_middle_name": "Provider Middle Name",
    "provider_credentials": "Provider Credential Text",
    "practice_city": "Provider Business Practice Location Address City Name",
    "practice_state": "Provider Business Practice Location Address State Name",
    "practice_zip": "Provider Business Practice Location Address Postal Code",
    "provider_sex_code": "Provider Sex Code",
    "primary_taxonomy_code": "Healthcare Provider Taxonomy Code_1",
    "enumeration_date": "Provider Enumeration Date",
    "last_update_date": "Last Update Date",
    "deactivation_date": "NPI Deactivation Date",
}
INDIVIDUAL = "1"
