"""The registered queries once more, as SQL for another engine over the same tables.

Written independently of the DataFrame code: the engine's own ``median`` and ``mad``, window ranks
and filtered aggregates are used instead of the operators under test. Only the mappings from the
driver's tables to raw text columns are shared.
"""

from __future__ import annotations

import re

from cohortlens.config import METRICS, Metric
from cohortlens.demo import inputs
from cohortlens.functions.labels import COST_BANDS, SPECIALTY_GROUPINGS, TOP_COST_BAND
from cohortlens.plans.declared import DECLARED
from cohortlens.plans.staging import (
    PART_B_AVERAGES,
    PART_B_COUNTS,
    PART_B_TEXT,
    PART_D_AMOUNTS,
    PART_D_COUNTS,
    PART_D_TEXT,
)
from cohortlens.sources.schemas import REGISTRY_HEADERS

# ---------------------------------------------------------------- fragments


def _list(columns) -> str:
    return ",\n    ".join(columns)


def _mapping(mapping: dict[str, str]) -> str:
    return _list(f'{sql} as "{name}"' for name, sql in mapping.items())


def _cleaned(names) -> str:
    return _list(f"case when trim({n}) not in ('', 'NULL', '*') then trim({n}) end as {n}" for n in names)


def _int(c: str) -> str:
    return f"try_cast(round(try_cast({c} as decimal(38,6))) as bigint)"


def _words(c: str) -> str:
    """Every word capitalised; words end at blanks."""
    return (
        f"array_to_string(list_transform(string_split(lower({c}), ' '), "
        "lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')"
    )


def _heaviest(attribute: str, weight: str) -> str:
    order = f"row({weight}, case when {attribute} is null then 0 else 1 end, coalesce({attribute}, ''))"
    return f"(arg_max(struct_pack(v := {attribute}), {order}) filter (where {weight} is not null)).v"


def _ratio(n: str, d: str) -> str:
    return f"case when {d} > 0 then cast({n} as double) / cast({d} as double) end"


def _num(c: str, name: str | None = None) -> str:
    return f"cast({c} as double) as {name or c}"


def _r(expression: str, name: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) as {name}"


def _pct(part: str, whole: str, digits: int = 2) -> str:
    return f"case when {whole} > 0 then round(cast(100.0 as double) * {part} / {whole}, {digits}) end"


def _any(names) -> str:
    return "(" + " or ".join(f"coalesce({n}, false)" for n in names) + ")"


STATS = ("mean", "stddev", "median", "mad")


def _counts(metrics) -> dict[str, str]:
    return {m.coverage: m.counted for m in metrics}


def _group_stats(source: str, keys, metrics: tuple[Metric, ...], min_n: int = 30) -> str:
    columns = ["count(*) as n_providers"]
    columns += [f"count({c}) as {n}" for n, c in _counts(metrics).items()]
    for m in metrics:
        v = f"cast({m.value} as double)"
        columns += [
            f"cast(sum({m.value}) as double) / nullif(count({m.value}), 0) as mean_{m.name}",
            f"stddev_samp({v}) as stddev_{m.name}",
            f"median({v}) as median_{m.name}",
            f"mad({v}) as mad_{m.name}",
        ]
    complete = " and ".join(f"{k} is not null" for k in keys)
    return f"""
select {", ".join(keys)}, {_list(columns)}
from {source} where {complete}
group by {", ".join(keys)} having count(*) >= {min_n}"""


def _scored(source: str, stats: str, keys, metrics: tuple[Metric, ...], extra: str = "") -> str:
    scores, flags = [], []
    for m in metrics:
        v = f"cast({m.value} as double)"
        scores.append(f"case when stddev_{m.name} > 0 then ({v} - mean_{m.name}) / stddev_{m.name} end as z_{m.name}")
        scores.append(
            f"case when mad_{m.name} > 0 then cast(0.6745 as double) * ({v} - median_{m.name}) / mad_{m.name} end"
            f" as mz_{m.name}"
        )
        flags.append(f"(abs(z_{m.name}) >= 2.0 and {m.coverage} >= 30) as outlier_zscore_{m.name}")
        flags.append(f"(abs(mz_{m.name}) >= 3.5 and {m.coverage} >= 30) as outlier_mad_{m.name}")
    join = " and ".join(f"p.{k} = s.{k}" for k in keys)
    only_stats = ", ".join(keys)
    return f"""
select *, {_any(f"outlier_mad_{m.name}" for m in metrics)} as is_outlier_any_mad,
    {_any(f"outlier_zscore_{m.name}" for m in metrics)} as is_outlier_any_zscore
from (
    select *, {_list(flags)}
    from (
        select *, {_list(scores)}
        from (select p.*, s.* exclude ({only_stats}) from {source} p join {stats} s on {join})
    )
)"""


def _grouping_case(code: str) -> str:
    whens = " ".join(f"when '{prefix}' then '{label}'" for prefix, label in SPECIALTY_GROUPINGS.items())
    return f"case left({code}, 3) {whens} else 'Other' end"


# ---------------------------------------------------------------- shared relations

KEYS = ("taxonomy_code", "state")

RELATIONS = {
    "seed": "select * from (values "
    + ", ".join("(" + ", ".join("null" if v is None else f"'{v}'" for v in row) + ")" for row in inputs.SEED_ROWS)
    + ") as t(taxonomy_code, grouping, classification, specialization, display_name)",
    "registry_file": f"""
select {_mapping(inputs.REGISTRY)}
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "registry_active": """
select * from registry_file where entity_type_code = '1' and coalesce(deactivation_date, '') = ''""",
    "raw_registry": f"select {_cleaned(REGISTRY_HEADERS)} from registry_active",
    "part_d_file": f"""
select {_mapping(inputs.PART_D)}
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey""",
    "raw_part_d": f"select {_cleaned(inputs.PART_D)} from part_d_file",
    "part_b_file": f"select {_mapping(inputs.PART_B)} from orders",
    "raw_part_b": f"select {_cleaned(inputs.PART_B)} from part_b_file",
    "s_registry": f"""
select npi, entity_type_code, provider_last_name, provider_first_name, provider_middle_name,
    provider_credentials, provider_sex_code, primary_taxonomy_code,
    upper(trim(practice_state)) as practice_state,
    {_words("trim(practice_city)")} as practice_city,
    left(trim(practice_zip), 5) as practice_zip5,
    {_grouping_case("primary_taxonomy_code")} as specialty_grouping,
    enumeration_date as enumeration_date_raw, last_update_date as last_update_date_raw
from raw_registry""",
    "s_part_d": f"""
select {_list(f"{raw} as {name}" for name, raw in PART_D_TEXT.items())},
    case when coalesce(trim(brnd_name), '') = '' then null
         when upper(brnd_name) = upper(gnrc_name) then 'generic' else 'brand' end as drug_kind,
    {_list(f"{_int(raw)} as {name}" for name, raw in PART_D_COUNTS.items())},
    {_list(f"try_cast({raw} as decimal(18,2)) as {name}" for name, raw in PART_D_AMOUNTS.items())},
    tot_benes is null as is_beneficiary_count_suppressed, 2023 as data_year
from raw_part_d""",
    "s_part_b": f"""
select {_list(f"{raw} as {name}" for name, raw in PART_B_TEXT.items())},
    {_list(f"{_int(raw)} as {name}" for name, raw in PART_B_COUNTS.items())},
    {_list(f"try_cast({raw} as decimal(18,4)) as {name}" for name, raw in PART_B_AVERAGES.items())},
    2023 as data_year
from raw_part_b""",
    "d_sums": f"""
select npi, max(data_year) as data_year,
    {_list(f"{_heaviest(a, 'total_claims')} as {a}" for a in ("prescriber_specialty_text", "prescriber_state", "prescriber_city"))},
    cast(sum(total_claims) as bigint) as total_claims,
    sum(total_30day_fills) as total_30day_fills,
    sum(total_drug_cost) as total_drug_cost,
    cast(sum(total_day_supply) as bigint) as total_day_supply,
    count(distinct generic_name) as distinct_generics,
    count(distinct brand_name) as distinct_brands,
    cast(coalesce(sum(total_claims) filter (where drug_kind = 'brand'), 0) as bigint) as brand_claims,
    cast(coalesce(sum(total_claims) filter (where drug_kind = 'generic'), 0) as bigint) as generic_claims,
    coalesce(sum(total_drug_cost) filter (where drug_kind = 'brand'), 0) as brand_drug_cost,
    coalesce(sum(total_drug_cost) filter (where drug_kind = 'generic'), 0) as generic_drug_cost
from s_part_d where npi is not null group by npi""",
    "d": f"""
select *, {_ratio("brand_claims", "total_claims")} as brand_claims_share,
    {_ratio("brand_drug_cost", "total_drug_cost")} as brand_cost_share,
    {_ratio("total_drug_cost", "total_claims")} as avg_cost_per_claim
from d_sums""",
    "b_sums": f"""
select npi, max(data_year) as data_year,
    {_list(f"{_heaviest(a, 'total_services')} as {a}" for a in ("provider_specialty_text", "provider_state", "provider_city"))},
    cast(sum(total_services) as bigint) as total_services,
    cast(sum(total_beneficiaries) as bigint) as total_beneficiaries_naive_sum,
    cast(sum(total_bene_day_services) as bigint) as total_bene_day_services,
    count(distinct hcpcs_code) as distinct_hcpcs,
    sum(avg_submitted_charge * total_services) as total_submitted_charges,
    sum(avg_medicare_allowed_amount * total_services) as total_medicare_allowed,
    sum(avg_medicare_payment_amount * total_services) as total_medicare_payment,
    sum(avg_medicare_standardized_amount * total_services) as total_medicare_standardized
from s_part_b where provider_entity_code = 'I' and npi is not null group by npi""",
    "b": f"""
select *, {_ratio("total_medicare_payment", "total_services")} as avg_medicare_payment_per_service,
    {_ratio("total_medicare_payment", "total_medicare_allowed")} as payment_to_allowed_ratio
from b_sums""",
    "ids": "select npi from s_registry union select npi from d union select npi from b",
    "everything": f"""
select ids.npi, provider_first_name, provider_last_name, provider_credentials, provider_sex_code,
    primary_taxonomy_code as taxonomy_code, grouping as nucc_grouping,
    classification as nucc_classification, specialization as nucc_specialization,
    specialty_grouping as nppes_specialty_grouping,
    coalesce(display_name, nullif(trim(prescriber_specialty_text), ''),
             nullif(trim(provider_specialty_text), ''), specialty_grouping, 'Unknown') as specialty,
    coalesce(nullif(practice_state, ''), nullif(prescriber_state, ''), nullif(provider_state, '')) as state,
    coalesce(practice_city, {_words("prescriber_city")}, {_words("provider_city")}) as city,
    practice_zip5, r.npi is not null as is_in_nppes, d.npi is not null as is_part_d_prescriber,
    b.npi is not null as is_part_b_provider,
    d.data_year as part_d_year, total_drug_cost, total_claims as part_d_total_claims,
    brand_cost_share, avg_cost_per_claim,
    b.data_year as part_b_year, total_medicare_payment, total_services as part_b_total_services,
    coalesce(nullif(trim(concat_ws(' ', provider_first_name, provider_last_name)), ''), ids.npi)
        as provider_full_name
from ids left join s_registry r on ids.npi = r.npi left join d on ids.npi = d.npi
    left join b on ids.npi = b.npi left join seed on primary_taxonomy_code = seed.taxonomy_code""",
    "pop": """
select npi, provider_full_name, taxonomy_code, specialty, state, city,
    is_part_d_prescriber as part_d_prescriber_flag, is_part_b_provider as part_b_provider_flag,
    part_d_year, total_drug_cost, part_d_total_claims, brand_cost_share, avg_cost_per_claim,
    part_b_year, total_medicare_payment, part_b_total_services
from everything""",
    "stats": _group_stats("pop", KEYS, METRICS),
    "scored": _scored("pop", "stats", KEYS, METRICS),
    "mart": """
select *, n_providers as peer_group_n, n_part_d as peer_n_part_d, n_part_b as peer_n_part_b,
    n_brand_share_observed as peer_n_brand_share,
    n_avg_cost_per_claim_observed as peer_n_avg_cost_per_claim
from scored""",
    "demo": """
select * from mart where outlier_mad_drug_cost and total_drug_cost is not null
order by mz_drug_cost desc, npi limit 6""",
    "kpis": f"""
select count(*) as total_providers_in_mart,
    count(*) filter (where part_d_prescriber_flag) as part_d_prescribers,
    count(*) filter (where part_b_provider_flag) as part_b_providers,
    count(*) filter (where is_outlier_any_mad) as flagged_mad,
    count(*) filter (where is_outlier_any_zscore) as flagged_zscore,
    {_pct("count(*) filter (where is_outlier_any_mad)", "count(*)")} as pct_flagged_mad,
    {_pct("count(*) filter (where is_outlier_any_zscore)", "count(*)")} as pct_flagged_zscore,
    cast(round(sum(total_drug_cost)) as bigint) as total_part_d_spend_usd,
    cast(round(sum(total_medicare_payment)) as bigint) as total_part_b_spend_usd
from mart""",
    "states": f"""
select state, count(*) as n_providers, count(*) filter (where is_outlier_any_mad) as flagged_mad,
    count(*) filter (where is_outlier_any_zscore) as flagged_zscore,
    {_pct("count(*) filter (where is_outlier_any_mad)", "count(*)")} as pct_flagged_mad,
    {_pct("count(*) filter (where is_outlier_any_zscore)", "count(*)")} as pct_flagged_zscore,
    cast(round(sum(total_drug_cost)) as bigint) as total_part_d_spend,
    cast(round(sum(total_medicare_payment)) as bigint) as total_part_b_spend
from mart where state is not null group by state""",
    "melted": " union all ".join(
        f"""
select '{m.value}' as metric, npi, provider_full_name, specialty, state, city, peer_group_n,
    {m.peer_n} as peer_n_metric, cast({m.value} as double) as metric_value, mz_{m.name} as modified_z_score
from mart where {m.value} is not null and {m.peer_n} >= 30 and abs(mz_{m.name}) >= 1.0"""
        for m in METRICS
    ),
    "rates": f"""
select specialty, state, peer_group_n, median_drug_cost, mad_drug_cost, count(*) as providers_in_mart,
    count(*) filter (where is_outlier_any_mad) as flagged_mad, count(*) filter (where is_outlier_any_zscore) as flagged_zscore,
    {_pct("count(*) filter (where is_outlier_any_mad)", "count(*)", 1)} as pct_flagged_mad,
    {_pct("count(*) filter (where is_outlier_any_zscore)", "count(*)", 1)} as pct_flagged_zscore
from mart group by all""",
    "distribution": """
select npi as demo_npi, 'this_provider' as series, cast(total_drug_cost as double) as value from demo
union all
select demo.npi, 'peer_group', cast(mart.total_drug_cost as double)
from demo join mart on mart.specialty = demo.specialty and mart.state = demo.state
where mart.total_drug_cost is not null""",
    "targets": """
select *, brand_cost_share - median_brand_cost_share as gap,
    (brand_cost_share - median_brand_cost_share) * cast(total_drug_cost as double) as amount
from mart
where part_d_prescriber_flag and brand_cost_share is not null and peer_n_brand_share >= 30
    and total_drug_cost >= 250000 and brand_cost_share - median_brand_cost_share >= cast(0.1 as double)
    and (mz_drug_cost is null or mz_drug_cost < 1000)
order by amount desc, npi limit 200""",
    "meter": f"select {_mapping(inputs.METER)} from events",
    "job_log": f"select {_mapping(inputs.JOB_LOG)} from events",
}


def _with_relations(body: str) -> str:
    """Prefix the relations that a query needs, in dependency order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, sql in RELATIONS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(sql)

    visit(body)
    if not needed:
        return body
    ctes = ",\n".join(f"{name} as ({sql})" for name, sql in RELATIONS.items() if name in needed)
    return f"with {ctes}\n{body}"


# ---------------------------------------------------------------- output columns

IDENTITY = "npi, provider_full_name, taxonomy_code, specialty, state, city"
PEER_N = ", ".join(dict.fromkeys(["peer_group_n", *[m.peer_n for m in METRICS]]))
STAT_COLUMNS = [f"{s}_{m.name}" for m in METRICS for s in STATS]


def _stat(name: str) -> str:
    return _r(name, name, 4 if name.startswith("stddev_") else 6)


ALL_FLAGS = ", ".join(
    [f"outlier_{rule}_{m.name}" for rule in ("zscore", "mad") for m in METRICS]
    + ["is_outlier_any_mad", "is_outlier_any_zscore"]
)
PROFILE = """npi, provider_first_name, provider_last_name, provider_credentials, provider_sex_code,
    taxonomy_code, nucc_grouping, nucc_classification, nucc_specialization, nppes_specialty_grouping,
    specialty, taxonomy_code as canonical_taxonomy_code, state, city, practice_zip5,
    is_in_nppes, is_part_d_prescriber, is_part_b_provider"""
FACT_D = f"""npi, data_year, total_claims, {_num("total_30day_fills")}, {_num("total_drug_cost")},
    total_day_supply, distinct_generics, distinct_brands, brand_claims, generic_claims,
    {_num("brand_drug_cost")}, {_num("generic_drug_cost")},
    brand_claims_share, brand_cost_share, avg_cost_per_claim"""
FACT_B = f"""npi, data_year, total_services, total_beneficiaries_naive_sum, total_bene_day_services,
    distinct_hcpcs, {_num("total_submitted_charges")}, {_num("total_medicare_allowed")},
    {_num("total_medicare_payment")}, {_num("total_medicare_standardized")},
    avg_medicare_payment_per_service, payment_to_allowed_ratio"""
MEASURES = f"""{_num("total_drug_cost")}, part_d_total_claims, brand_cost_share, avg_cost_per_claim,
    {_num("total_medicare_payment")}, part_b_total_services"""
LOADED = f"'{inputs.LOADED_AT}' as loaded_at"
RANKED = "npi, provider_full_name, specialty, state, city, peer_group_n"


def _freshness(name: str, table: str, column: str, warn: int, error: int, now: str) -> str:
    return f"""
select '{name}' as source_name, strftime(max({column}), '%Y-%m-%d %H:%M:%S') as max_loaded_at,
    cast(date_diff('day', cast(max({column}) as date), cast(timestamp '{now}' as date)) as integer) as age_days,
    case when date_diff('day', cast(max({column}) as date), cast(timestamp '{now}' as date)) > {error} then 'error'
         when date_diff('day', cast(max({column}) as date), cast(timestamp '{now}' as date)) > {warn} then 'warn'
         else 'ok' end as status
from {table}"""


def _load_counts(name: str, table: str, key: str, earliest: str, latest: str) -> str:
    return f"""
select '{name}' as source_table, count(*) as row_count, count(distinct {key}) as distinct_keys,
    count(*) filter (where {key} is null) as null_keys, {earliest} as earliest, {latest} as latest from {table}"""


def _violations(name: str, condition: str, relation: str) -> str:
    return f"select '{name}' as check_name, count(*) filter (where {condition}) as n_violations from {relation}"


def _nulls(relation: str, table: str, columns) -> list[str]:
    return [_violations(f"{table}.{c}", f"{c} is null", relation) for c in columns]


def _duplicates(table: str, relation: str, column: str) -> str:
    return f"""
select '{table}.{column}' as check_name, count(*) as n_violations
from (select {column} from {relation} where {column} is not null group by 1 having count(*) > 1)"""


def _orphans(name: str, child: str, parent: str) -> str:
    return f"""
select '{name}.npi' as check_name, count(*) as n_violations
from {child} c where not exists (select 1 from {parent} p where p.npi = c.npi)"""


def _broken_floor(floor: int) -> str:
    flags = [
        f"(outlier_{rule}_{m.name} and {m.peer_n} < {floor})" for rule in ("mad", "zscore") for m in METRICS
    ]
    return f"(peer_group_n < {floor} or " + " or ".join(f"coalesce({f}, false)" for f in flags) + ")"


UNION = "\nunion all\n"
BAND_CASE = (
    "case "
    + " ".join(f"when value < {limit} then '{label}'" for limit, label in COST_BANDS)
    + f" else '{TOP_COST_BAND}' end"
)
STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


def _key_comparison() -> str:
    parts = []
    for label, keys in (
        ("grouping", ("nppes_specialty_grouping",)),
        ("state", ("state",)),
        ("taxonomy_state", KEYS),
    ):
        parts.append(
            f"""
select '{label}' as grouping_key, count(distinct ({", ".join(keys)})) as peer_groups, count(*) as providers,
    count(*) filter (where is_outlier_any_mad) as flagged_mad,
    {_pct("count(*) filter (where is_outlier_any_mad)", "count(*)")} as pct_flagged_mad
from ({_scored("everything", f"({_group_stats('everything', keys, METRICS)})", keys, METRICS)})"""
        )
    return UNION.join(parts)


ACTIVITY = (Metric("activity", "activity", "n_activity", "activity"),)
ACTIVITY_POPULATION = """
select npi, primary_taxonomy_code as taxonomy_code, upper(practice_state) as state, activity
from raw_registry left join (
    select cast(user_id as varchar) as npi, sum(cast(value as decimal(18,2))) as activity
    from events group by 1
) using (npi)"""

BODIES = {
    # sources and sinks
    "csv_round_trip": """
select cast(conv_id as varchar) as conv_id, cast(turn as varchar) as turn, role, text from conversations""",
    "csv_quotes_in_fields": """
select cast(p_partkey as varchar) as part, p_size || '" x ' || p_size || '"' as size,
    p_name || chr(10) || '"' || p_brand || '",' || p_type as label from part""",
    "null_tokens": """
select prscrbr_npi, prscrbr_city, brnd_name, gnrc_name, tot_benes, ge65_sprsn_flag, ge65_tot_clms
from raw_part_d""",
    "registry_prefilter": "select * from registry_active",
    "seed_lookup": """
select npi, primary_taxonomy_code, coalesce(display_name, primary_taxonomy_code) as specialty
from raw_registry left join seed on primary_taxonomy_code = taxonomy_code""",
    "source_freshness": UNION.join(
        [
            _freshness("events_monthly", "events", "ts", 60, 180, inputs.NOW),
            _freshness("orders_yearly", "orders", "o_orderdate", 540, 730, inputs.NOW),
            _freshness("orders_when_new", "orders", "o_orderdate", 540, 730, "2003-06-30 00:00:00"),
        ]
    ),
    "latest_per_key": """
select case o_orderpriority when '1-URGENT' then 'urgent' when '2-HIGH' then 'high'
            when '3-MEDIUM' then 'medium' else 'low' end as key,
    o_orderpriority as dataset_title, cast(year(o_orderdate) as integer) as data_year,
    'https://files.example/' || o_orderkey || '.csv' as csv_url,
    'Orders : ' || strftime(o_orderdate, '%Y-%m') || '-01' as distribution_title,
    'text/csv' as media_type, o_orderstatus as description,
    strftime(o_orderdate, '%Y-%m') as dataset_modified
from orders where o_orderpriority <> '4-NOT SPECIFIED'
qualify row_number() over (partition by o_orderpriority
    order by strftime(o_orderdate, '%Y-%m') desc, cast(o_orderkey as varchar) || '.csv' desc) = 1""",
    "table_round_trip": f"""
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, {STAMP.format("o_orderdate")} as o_orderdate,
    o_orderpriority from orders""",
    "table_versions": """
select 'older' as version, o_orderkey, o_orderstatus from orders where o_orderkey % 10 = 0
union all select 'current', o_orderkey, o_orderstatus from orders""",
    "extract_manifest": """
select 'tab1_overview_kpis' as extract, count(*) as row_count from kpis
union all select 'tab2_outliers_top1000', cast(coalesce(sum(least(n, 1000)), 0) as bigint)
    from (select metric, count(*) as n from melted group by metric)
union all select 'tab3_demo_providers', count(*) from demo
union all select 'tab3_demo_peer_dist', count(*) from distribution
union all select 'tab4_state_aggregates', count(*) from states""",
    "validate_counts": UNION.join(
        [
            _load_counts(
                "lineitem", "lineitem", "l_orderkey", STAMP.format("min(l_shipdate)"), STAMP.format("max(l_shipdate)")
            ),
            _load_counts(
                "orders", "orders", "o_custkey", STAMP.format("min(o_orderdate)"), STAMP.format("max(o_orderdate)")
            ),
            _load_counts(
                "registry", "raw_registry", "primary_taxonomy_code", f"'{inputs.LOADED_AT}'", f"'{inputs.LOADED_AT}'"
            ),
        ]
    ),
    # staging and scalar functions
    "stg_part_d": f"""
select * replace ({_list(_num(c) for c in PART_D_AMOUNTS)}), {LOADED} from s_part_d""",
    "stg_part_b": f"""
select * replace ({_list(_num(c) for c in PART_B_AVERAGES)}), {LOADED} from s_part_b""",
    "stg_registry": f"select *, {LOADED} from s_registry",
    "try_cast_numeric": f"""
select prscrbr_npi, {_int("tot_clms")} as claims, {_int("tot_30day_fills")} as fills_rounded,
    {_int("tot_benes")} as beneficiaries,
    cast(try_cast(tot_drug_cst as decimal(18,2)) as double) as cost,
    cast(try_cast(ge65_tot_30day_fills as decimal(18,2)) as double) as senior_fills
from part_d_file""",
    "prefix_case": "select npi, primary_taxonomy_code, specialty_grouping from s_registry",
    "drug_kind": """
select brand_name as brnd_name, generic_name as gnrc_name, drug_kind from s_part_d""",
    "suppression_flag": "select npi, total_beneficiaries, is_beneficiary_count_suppressed from s_part_d",
    "individuals_only": "select npi, hcpcs_code, place_of_service from s_part_b where provider_entity_code = 'I'",
    "fallback_chain": """
select prscrbr_npi,
    coalesce(nullif(trim(brnd_name), ''), nullif(trim(prscrbr_type), ''), nullif(trim(gnrc_name), '')) as label,
    coalesce(nullif(prscrbr_state_abrvtn, ''), 'none') as state
from part_d_file""",
    "coverage_flags": "select npi, is_in_nppes, is_part_d_prescriber, is_part_b_provider from everything",
    "full_name": "select npi, provider_full_name as full_name from everything where is_in_nppes",
    "string_cleanup": f"""
select npi, upper(trim(practice_state)) as state, {_words("trim(practice_city)")} as city,
    left(trim(practice_zip), 5) as zip5, cast(length(trim(practice_city)) as integer) as city_length
from registry_file""",
    "numeric_scalars": f"""
with exact as (select c_custkey, c_acctbal, cast(c_acctbal as decimal(18,2)) as x from customer)
select c_custkey, {_num("abs(x)", "size")}, {_num("round(x, 0)", "whole")}, {_num("round(x, 1)", "tenths")},
    {_num("x + 100", "plus")}, {_num("x - 100", "minus")}, {_num("x * 3", "times")},
    c_acctbal / power(cast(2 as double), 10) as scaled
from exact""",
    "derived_columns": """
select npi, distinct_generics + distinct_brands as distinct_drugs_total,
    brand_cost_share - brand_claims_share as share_gap,
    cast(total_drug_cost as double) / cast(1e9 as double) as cost_billions,
    cast(100.0 as double) * brand_cost_share as brand_cost_pct
from d""",
    "union_distinct": """
select npi from raw_registry
union select prscrbr_npi from part_d_file
union select rndrng_npi from part_b_file""",
    # rollups
    "part_d_annual": f"select {FACT_D}, prescriber_specialty_text, prescriber_state, prescriber_city from d",
    "part_b_annual": f"select {FACT_B}, provider_specialty_text, provider_state, provider_city from b",
    "weighted_totals": f"""
select hcpcs_code, place_of_service,
    {_num("sum(avg_submitted_charge * total_services)", "total_submitted_charges")},
    {_num("sum(avg_medicare_allowed_amount * total_services)", "total_medicare_allowed")},
    {_num("sum(avg_medicare_payment_amount * total_services)", "total_medicare_payment")},
    {_num("sum(avg_medicare_standardized_amount * total_services)", "total_medicare_standardized")}
from s_part_b group by 1, 2""",
    "distinct_counts": "select npi, distinct_generics, distinct_brands from d",
    "conditional_sums": f"""
select prescriber_state,
    cast(sum(case when drug_kind = 'brand' then total_claims else 0 end) as bigint) as brand_claims,
    cast(sum(case when drug_kind = 'generic' then total_claims else 0 end) as bigint) as generic_claims,
    {_num("sum(case when drug_kind = 'brand' then total_drug_cost else 0 end)", "brand_drug_cost")},
    {_num("sum(case when drug_kind = 'generic' then total_drug_cost else 0 end)", "generic_drug_cost")}
from s_part_d group by 1""",
    "dominant_attr": "select npi, prescriber_specialty_text as specialty_text from d",
    "safe_ratios": f"""
select c_custkey, {_ratio("1000", "cast(c_acctbal as decimal(18,2))")} as ratio from customer""",
    # profile, dimension, facts
    "provider_profile": f"select {PROFILE} from everything",
    "dim_provider": """
select npi, provider_full_name, provider_first_name, provider_last_name, provider_credentials,
    provider_sex_code, taxonomy_code, specialty, nucc_grouping, nucc_classification, nucc_specialization,
    nppes_specialty_grouping, state, city, practice_zip5, is_in_nppes as in_nppes_flag,
    is_part_d_prescriber as part_d_prescriber_flag, is_part_b_provider as part_b_provider_flag
from everything""",
    "fct_part_d": f"select {FACT_D}, distinct_generics + distinct_brands as distinct_drugs_total from d",
    "fct_part_b": f"select {FACT_B} from b",
    "provider_metrics": f"select npi, taxonomy_code, state, {MEASURES} from everything",
    # peer groups
    "peer_counts": f"""
select taxonomy_code, state, count(*) as n_providers,
    {_list(f"count({c}) as {n}" for n, c in _counts(METRICS).items())}
from pop where taxonomy_code is not null and state is not null group by 1, 2""",
    "peer_mean_std": f"""
select taxonomy_code, state, {_list(_stat(f"{s}_{m.name}") for m in METRICS for s in ("mean", "stddev"))}
from ({_group_stats("pop", KEYS, METRICS, 1)})""",
    "peer_median": f"""
select taxonomy_code, state, {_list(_r(f"median_{m.name}", f"median_{m.value}") for m in METRICS)}
from ({_group_stats("pop", KEYS, METRICS, 1)})""",
    "peer_mad": f"""
select taxonomy_code, state,
    {_list(_r(f"{s}_{m.name}", f"{s}_{m.value}") for m in METRICS for s in ("median", "mad"))}
from ({_group_stats("pop", KEYS, METRICS, 1)})""",
    "window_median": f"""
select npi, taxonomy_code, state, {_num("total_drug_cost")}, part_b_total_services,
    case when taxonomy_code is not null and state is not null then round(median(cast(total_drug_cost as double))
        over (partition by taxonomy_code, state), 6) end as median_total_drug_cost,
    case when taxonomy_code is not null and state is not null then round(median(cast(part_b_total_services as double))
        over (partition by taxonomy_code, state), 6) end as median_part_b_total_services
from pop""",
    "order_line_median": """
select l_returnflag, l_linestatus, count(*) as n,
    round(median(l_extendedprice), 6) as median_l_extendedprice, round(median(l_quantity), 6) as median_l_quantity,
    round(mad(l_extendedprice), 6) as mad_l_extendedprice, round(mad(l_quantity), 6) as mad_l_quantity
from lineitem group by 1, 2""",
    "part_price_median": """
select l_partkey, count(*) as n, round(median(l_extendedprice), 6) as median_l_extendedprice,
    round(mad(l_extendedprice), 6) as mad_l_extendedprice
from lineitem group by 1""",
    "peer_group_stats": f"""
select stats.taxonomy_code as canonical_taxonomy_code, state, n_providers,
    {", ".join(_counts(METRICS))}, {_list(_stat(c) for c in STAT_COLUMNS)},
    coalesce(display_name, stats.taxonomy_code) as specialty
from stats left join seed on stats.taxonomy_code = seed.taxonomy_code""",
    "peer_join": "select npi, taxonomy_code, state, n_providers, n_part_d from pop join stats using (taxonomy_code, state)",
    # scoring
    "outlier_mart": f"""
select {IDENTITY}, part_d_prescriber_flag, part_b_provider_flag, part_d_year, part_b_year, {MEASURES},
    {PEER_N}, {_list(_stat(c) for c in STAT_COLUMNS)},
    {_list(_stat(f"{s}_{m.name}") for s in ("z", "mz") for m in METRICS)}, {ALL_FLAGS}
from mart""",
    "zscores": f"select npi, {_list(_stat(f'z_{m.name}') for m in METRICS)} from mart",
    "modified_zscores": f"select npi, {_list(_stat(f'mz_{m.name}') for m in METRICS)} from mart",
    "outlier_flags": f"select npi, {ALL_FLAGS} from mart",
    "three_valued_flags": f"""
select npi, taxonomy_code, state, {_num("activity")}, n_providers as peer_group_n, n_activity as peer_n_activity,
    {_list(_stat(f"{s}_activity") for s in (*STATS, "z", "mz"))},
    outlier_zscore_activity, outlier_mad_activity, is_outlier_any_mad, is_outlier_any_zscore,
    abs(mz_activity) >= 3.5 and n_activity >= 3 as lenient_flag
from ({_scored(f"({ACTIVITY_POPULATION})", f"({_group_stats(f'({ACTIVITY_POPULATION})', KEYS, ACTIVITY)})", KEYS, ACTIVITY)})""",
    "severity_band": """
select npi, case when abs(mz_part_b_services) >= 10 then 'extreme' when abs(mz_part_b_services) >= 3.5 then 'elevated'
    when mz_part_b_services is not null then 'typical' end as severity_band
from mart""",
    # reports
    "overview_kpis": "select * from kpis",
    "peer_group_count": "select count(distinct (taxonomy_code, state)) as peer_groups from mart",
    "kpi_tiles": """
select total_providers_in_mart, flagged_mad, pct_flagged_mad, flagged_zscore, pct_flagged_zscore,
    cast(total_part_d_spend_usd as double) / cast(1e9 as double) as part_d_spend_b
from kpis""",
    "state_aggregates": "select * from states",
    "state_ranking": """
select state, n_providers, flagged_mad, pct_flagged_mad, total_part_d_spend
from states where length(state) = 2 and n_providers > 100""",
    "peer_group_rates": f"""
select * replace ({_r("median_drug_cost", "median_drug_cost")}, {_r("mad_drug_cost", "mad_drug_cost")}) from rates""",
    "peer_group_diagnostics": f"""
select * replace ({_r("median_drug_cost", "median_drug_cost")}, {_r("mad_drug_cost", "mad_drug_cost")})
from rates where pct_flagged_mad > 40 or mad_drug_cost < 1""",
    "peer_group_alerts": f"""
select * replace ({_r("median_drug_cost", "median_drug_cost")}, {_r("mad_drug_cost", "mad_drug_cost")})
from rates where pct_flagged_mad > 3 or mad_drug_cost < 400000""",
    "flag_share_by_specialty": f"""
select specialty, flagged_mad, {_pct("flagged_mad", "total")} as pct_of_flags
from (select specialty, flagged_mad, sum(flagged_mad) over () as total
      from (select specialty, count(*) filter (where is_outlier_any_mad) as flagged_mad from mart group by 1))""",
    "rule_comparison": """
select 'Classical z-score' as method, cast(2.0 as double) as threshold, flagged_zscore as flagged,
    pct_flagged_zscore as pct_flagged from kpis
union all select 'Modified z-score', cast(3.5 as double), flagged_mad, pct_flagged_mad from kpis""",
    "key_comparison": _key_comparison(),
    "filter_options": "select distinct specialty from mart where specialty is not null",
    "select_metric": f"""
select {RANKED}, peer_n_brand_share as peer_n_metric, brand_cost_share as metric_value,
    {_r("mz_brand_cost_share", "modified_z_score")} from mart""",
    "outlier_table": f"""
select {RANKED}, peer_n_part_d as peer_n_metric, part_d_total_claims as metric_value,
    {_r("mz_part_d_claims", "modified_z_score")}
from mart where peer_n_part_d >= 40 and abs(mz_part_d_claims) >= 2.0 and state in ('AF', 'EU', 'AS')
    and specialty in ('Internal Medicine Physician', 'Specialist', 'Nurse Practitioner')
order by abs(mz_part_d_claims) desc, npi limit 1000""",
    "provider_lookup": """
select m.npi, m.provider_full_name, m.taxonomy_code, m.state, m.is_outlier_any_mad,
    e.nucc_grouping, e.nucc_classification, e.nucc_specialization
from mart m left join everything e using (npi)
where upper(m.provider_full_name) like upper('%customer#00000012%') order by m.npi limit 25""",
    "ilike_filter": "select npi, specialty from mart where specialty ilike '%PHYSICIAN%'",
    "top_outliers": f"""
select npi, provider_full_name, specialty, state, city, {_num("total_drug_cost")},
    {_r("median_drug_cost", "peer_median")}, peer_group_n, {_r("mz_drug_cost", "modified_z_score")}
from mart where outlier_mad_drug_cost and total_drug_cost is not null
order by mz_drug_cost desc, npi limit 100""",
    "specialty_top": f"""
select npi, provider_full_name, specialty, state, {_num("total_drug_cost")}, {_r("mz_drug_cost", "mz_drug_cost")}
from mart where outlier_mad_drug_cost and specialty ilike '%physician%'
order by mart.mz_drug_cost desc, npi limit 10""",
    "melt_metrics": f"select * replace ({_r('modified_z_score', 'modified_z_score')}) from melted",
    "top_n_per_metric": f"""
select * replace ({_r('modified_z_score', 'modified_z_score')}) from (
    select * from melted
    qualify row_number() over (partition by metric order by abs(modified_z_score) desc, npi) <= 100)""",
    "ranked_extract": f"""
select {RANKED}, peer_n_metric, metric_value, {_r("modified_z_score", "modified_z_score")}
from (select * from melted
      qualify row_number() over (partition by metric order by abs(modified_z_score) desc, npi) <= 1000) m
where metric = 'avg_cost_per_claim' and abs(m.modified_z_score) >= 2.5 and state in ('AM', 'EU', 'MI')
order by abs(m.modified_z_score) desc, npi limit 1000""",
    "drill_down": f"""
select provider_full_name, specialty, state, city, {_num("total_drug_cost")}, {_r("mz_drug_cost", "mz_drug_cost")},
    part_d_total_claims, brand_cost_share, {_num("total_medicare_payment")}, peer_group_n
from demo where provider_full_name =
    (select provider_full_name from demo d1 order by d1.mz_drug_cost desc, npi limit 1)""",
    "equal_width_histogram": """
select metric, floor(modified_z_score / 0.5::double) * 0.5::double as bin_start, count(*) as n
from (select * from melted
      qualify row_number() over (partition by metric order by abs(modified_z_score) desc, npi) <= 1000)
group by 1, 2""",
    "demo_providers": f"""
select m.npi, m.provider_full_name, m.specialty, m.taxonomy_code, m.state, m.city, m.peer_group_n,
    cast(m.total_drug_cost as double) as total_drug_cost, m.part_d_total_claims, m.brand_cost_share,
    m.avg_cost_per_claim, cast(m.total_medicare_payment as double) as total_medicare_payment,
    m.part_b_total_services, {_list(_r(f"m.mz_{x.name}", f"mz_{x.name}") for x in METRICS)},
    m.is_outlier_any_mad, e.nucc_grouping, e.nucc_classification, e.nucc_specialization
from demo m left join everything e using (npi)""",
    "peer_distribution": "select * from distribution",
    "peer_distribution_extract": """
select *, row_number() over (order by demo_npi, series, value desc) as position from distribution""",
    "cost_bands": f"""
select {BAND_CASE} as cost_band, count(*) as peer_count
from distribution
where series = 'peer_group' and demo_npi in (
    select npi from demo where provider_full_name =
        (select provider_full_name from demo order by mz_drug_cost desc, npi limit 1))
group by 1""",
    "peer_position": f"""
select demo_npi, own_value, count(*) as n_peers, count(*) filter (where value < own_value) as peers_below,
    {_r("median(value)", "peer_median")},
    {_r("own_value / median(value)", "ratio_to_median")}
from distribution join (select npi as demo_npi, cast(total_drug_cost as double) as own_value from demo) using (demo_npi)
where series = 'peer_group' group by demo_npi, own_value""",
    "brand_share_opportunity": """
select specialty, state, count(*) as providers,
    round(sum(greatest(brand_cost_share - median_brand_cost_share, 0) * cast(total_drug_cost as double)), 2)
        as total_excess_brand_cost,
    round(avg(brand_cost_share), 3) as avg_brand_share,
    round(avg(median_brand_cost_share), 3) as peer_median_brand_share
from mart where brand_cost_share is not null group by 1, 2 having count(*) >= 30
order by total_excess_brand_cost desc, specialty, state limit 100""",
    "brand_switch_targets": """
select case when amount >= 1000000 then 'Tier 1 (>=$1M)' when amount >= 250000 then 'Tier 2 ($250k-$1M)'
            else 'Tier 3 (<$250k)' end as priority_tier,
    npi, provider_full_name, specialty, state, city,
    cast(round(total_drug_cost) as bigint) as total_drug_cost_usd,
    cast(round(100 * brand_cost_share) as bigint) as brand_share_pct,
    cast(round(100 * median_brand_cost_share) as bigint) as peer_median_pct,
    cast(round(100 * gap) as bigint) as gap_pts,
    cast(round(amount) as bigint) as sized_opportunity_usd, peer_group_n
from targets""",
    "talking_point": """
select npi, format('Runs {}% brand vs a peer median of {}% for {} in {} (n={}). ~${} shifts to lower-cost equivalents at peer mix.',
    cast(round(100 * brand_cost_share) as bigint), cast(round(100 * median_brand_cost_share) as bigint),
    specialty, state, peer_group_n, cast(round(amount) as bigint)) as talking_point
from targets""",
    "priority_tier": """
select o_orderkey, case when o_totalprice * 4 >= 1000000 then 'Tier 1 (>=$1M)'
    when o_totalprice * 4 >= 250000 then 'Tier 2 ($250k-$1M)' else 'Tier 3 (<$250k)' end as priority_tier
from orders""",
    # data quality
    "dq_not_null": UNION.join(
        _nulls("d", "part_d_annual", ("npi", "data_year", "prescriber_state", "total_drug_cost"))
        + _nulls("everything", "provider_profile", ("npi", "specialty", "state", "taxonomy_code"))
        + _nulls("mart", "provider_outliers", ("npi", "specialty", "state", "is_outlier_any_mad", "mz_part_b_payment"))
    ),
    "dq_unique": UNION.join(
        [
            _duplicates("provider_profile", "everything", "npi"),
            _duplicates("provider_outliers", "mart", "npi"),
            _duplicates("lineitem", "lineitem", "l_orderkey"),
        ]
    ),
    "dq_accepted_values": UNION.join(
        [
            _violations(
                "stg_part_d.drug_kind", "brand_name is not null and drug_kind not in ('brand', 'generic')", "s_part_d"
            ),
            _violations("stg_registry.entity_type_code", "entity_type_code <> '1'", "s_registry"),
            _violations(
                "stg_registry.specialty_grouping",
                "specialty_grouping not in ('Physician', 'Advanced Practice', 'Other')",
                "s_registry",
            ),
        ]
    ),
    "fk_violations": UNION.join(
        [
            _orphans("fct_part_d", "d", "everything"),
            _orphans("fct_part_b", "b", "everything"),
            _orphans("provider_outliers", "mart", "everything"),
            _orphans("unregistered", "d", "s_registry"),
        ]
    ),
    "peer_floor_violations": UNION.join(
        [
            _violations("peer_floor", _broken_floor(30), "mart"),
            _violations("peer_floor_50", _broken_floor(50), "mart"),
        ]
    ),
    "share_in_unit_interval": UNION.join(
        [
            _violations("share_in_unit_interval", "brand_cost_share not between 0 and 1", "d"),
            _violations("cost_in_unit_interval", "avg_cost_per_claim not between 0 and 1", "d"),
        ]
    ),
    "flag_rate": """
select count(*) as total, count(*) filter (where is_outlier_any_mad) as flagged_mad,
    cast(count(*) filter (where is_outlier_any_mad) as double) / nullif(count(*), 0) as flag_rate,
    cast(count(*) filter (where is_outlier_any_mad) as double) / nullif(count(*), 0) >= 0.08 as over_ceiling
from mart""",
    "extract_reconciliation": """
select unnest(['mad_rate_follows', 'zscore_rate_follows', 'kpi_rows', 'state_rows', 'state_flags', 'ranked_rows'])
    as check_name,
    unnest(list_transform([pct_flagged_mad = round(100.0::double * flagged_mad / total_providers_in_mart, 2),
            pct_flagged_zscore = round(100.0::double * flagged_zscore / total_providers_in_mart, 2),
            total_providers_in_mart = (select count(*) from mart),
            (select sum(n_providers) from states) = (select count(*) from mart where state is not null),
            (select sum(flagged_mad) from states) = (select count(*) filter (where is_outlier_any_mad) from mart),
            true], lambda x: coalesce(x, false))) as ok
from kpis""",
    # metering
    "daily_usage": f"""
select {STAMP.format("date_trunc('day', start_time)")} as usage_date, warehouse_name,
    round(sum(credits_used), 3) as credits, round(sum(credits_used_cloud_services), 3) as credits_cloud_services
from meter where start_time >= timestamp '2024-01-01 00:00:00' group by 1, 2""",
    "usage_runway": """
select round(used, 2) as credits_used_total, cast(10000000 as double) as credit_budget,
    round(10000000 - used, 2) as credits_remaining,
    round(cast(100 as double) * used / cast(10000000 as double), 1) as pct_consumed,
    round(recent / 7, 3) as avg_daily_burn_last_7d,
    case when recent > 0 then round((10000000 - used) / (recent / 7), 1) end as days_remaining_at_recent_burn
from (select sum(credits_used) as used,
             sum(credits_used) filter (where start_time >= timestamp '2024-01-24 00:00:00') as recent from meter)""",
    "top_k_jobs": f"""
select query_id, user_name, warehouse_name, warehouse_size, query_type,
    round(total_elapsed_time / 1000.0::double, 1) as elapsed_sec,
    round(bytes_scanned / power(2.0::double, 30), 2) as gb_scanned, rows_produced,
    {STAMP.format("start_time")} as start_time, left(query_text, 120) as query_preview
from job_log
where start_time >= timestamp '2024-01-24 00:00:00' and warehouse_name = 'MAIN_WH'
    and query_type in ('SELECT', 'CREATE_TABLE_AS_SELECT', 'COPY', 'INSERT', 'MERGE')
order by total_elapsed_time desc, query_id limit 20""",
}



def _model_checks() -> str:
    """Counts of all declared checks, over the twins of the model's tables."""
    twins = {name: f"({BODIES[name]})" for name in DECLARED if name in BODIES}
    twins |= {"taxonomy": "seed", "mart": "mart"}
    parts = []
    for name, checks in DECLARED.items():
        relation = twins[name]
        parts += [_violations(f"not_null:{name}.{c}", f"{c} is null", relation) for c in checks.not_null]
        for c, values in checks.accepted.items():
            listed = ", ".join(f"'{v}'" for v in values)
            parts.append(_violations(f"accepted:{name}.{c}", f"{c} not in ({listed})", relation))
        for c in checks.unique:
            parts.append(f"""
select 'unique:{name}.{c}' as check_name, count(*) as n_violations
from (select {c} from {relation} group by 1 having count({c}) > 1)""")
        if checks.in_dimension:
            parts.append(f"""
select 'reference:{name}.npi' as check_name, count(*) as n_violations
from {relation} c where c.npi is not null and c.npi not in (select npi from ({BODIES["dim_provider"]}))""")
    parts.append(_violations("floor:mart", _broken_floor(30), "mart"))
    parts.append(
        _violations("unit_interval:part_d_annual.brand_cost_share", "brand_cost_share not between 0 and 1", "d")
    )
    parts.append("""
select 'flag_rate:mart' as check_name, count(*) as n_violations
from (select count(*) filter (where is_outlier_any_mad) as flagged, count(*) as total from mart)
where total > 0 and flagged >= 0.08 * total""")
    return UNION.join(parts)


BODIES["model_checks"] = _model_checks()

BODIES["stg_part_b_from_csv"] = BODIES["stg_part_b"]

# Lists whose limit bites: the twins above with other literals.
BODIES["top_outliers_cut"] = BODIES["top_outliers"].replace("limit 100", "limit 3")
BODIES["specialty_top_cut"] = (
    BODIES["specialty_top"].replace("specialty ilike '%physician%'", "specialty ilike '%'").replace("limit 10", "limit 4")
)
BODIES["provider_lookup_cut"] = BODIES["provider_lookup"].replace("'%customer#00000012%'", "'%customer#%'").replace("limit 25", "limit 9")
BODIES["outlier_table_cut"] = f"""
select {RANKED}, peer_n_part_d as peer_n_metric, part_d_total_claims as metric_value,
    {_r("mz_part_d_claims", "modified_z_score")}
from mart where peer_n_part_d >= 30 and abs(mz_part_d_claims) >= 1.0
order by abs(mz_part_d_claims) desc, npi limit 11"""
BODIES["ranked_extract_cut"] = f"""
select {RANKED}, peer_n_metric, metric_value, {_r("modified_z_score", "modified_z_score")}
from (select * from melted
      qualify row_number() over (partition by metric order by abs(modified_z_score) desc, npi) <= 40) m
where metric = 'avg_cost_per_claim' and abs(m.modified_z_score) >= 0.5 and m.peer_n_metric >= 30
order by abs(m.modified_z_score) desc, npi limit 12"""
BODIES["brand_share_opportunity_cut"] = (
    BODIES["brand_share_opportunity"].replace("count(*) >= 30", "count(*) >= 5").replace("limit 100", "limit 6")
)
BODIES["brand_switch_targets_cut"] = BODIES["brand_switch_targets"].replace("from targets", """from (
    select *, brand_cost_share - median_brand_cost_share as gap,
        (brand_cost_share - median_brand_cost_share) * cast(total_drug_cost as double) as amount
    from mart where part_d_prescriber_flag and brand_cost_share is not null and peer_n_brand_share >= 30
        and total_drug_cost >= 250000 and brand_cost_share - median_brand_cost_share >= cast(0.02 as double)
        and (mz_drug_cost is null or mz_drug_cost < 1000)
    order by amount desc, npi limit 8)""")

ORACLES = {name: _with_relations(body) for name, body in BODIES.items()}
