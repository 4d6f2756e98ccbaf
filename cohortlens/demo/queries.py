"""Every operator as a query over the driver's tables.

Queries return plain types (doubles for decimals, text for timestamps), so that another engine can
be compared value by value. Statistics that depend on the order of floating-point sums are rounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.config import METRICS, Metric, OutlierConfig
from cohortlens.demo import inputs
from cohortlens.demo.inputs import NOW, build, table
from cohortlens.functions import (
    drug_kind,
    first_nonblank,
    full_name,
    gated_flag,
    null_if_tokens,
    priority_tier,
    safe_ratio,
    severity_band,
    specialty_grouping,
    try_to_dec,
    try_to_int,
    weighted_total,
)
from cohortlens.operators.relational import all_ids, dominant, histogram
from cohortlens.operators.robust import group_medians, robust_stats, with_group_median
from cohortlens.plans import marts, metering, model_checks, profile, quality, reports, rollups, staging
from cohortlens.session import Workspace
from cohortlens.sources import catalog, loadchecks, readers, writers
from cohortlens.sources.schemas import REGISTRY_HEADERS, TAXONOMY_SEED, all_text

Query = Callable[[SparkSession, str], DataFrame]

REGISTERED: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function's name, with plain output types.

    A trailing underscore keeps the function apart from an operator of the same name.
    """
    REGISTERED[function.__name__.rstrip("_")] = lambda spark, sf_dir: plain(function(spark, sf_dir))
    return function


def plain(df: DataFrame) -> DataFrame:
    changed = False
    columns = []
    for field in df.schema.fields:
        name = f"`{field.name}`"
        if isinstance(field.dataType, T.DecimalType):
            columns.append(f"cast({name} as double) as {name}")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            columns.append(f"left(cast({name} as string), 19) as {name}")
        elif isinstance(field.dataType, T.DateType):
            columns.append(f"cast({name} as string) as {name}")
        else:
            columns.append(name)
            continue
        changed = True
    return df.selectExpr(*columns) if changed else df


def digits_for(column: str) -> int:
    """Spread is a large number with rounding noise; everything else is kept to six digits."""
    return 4 if column.startswith("stddev_") else 6


def rounded(df: DataFrame, *keep: str) -> DataFrame:
    """Round all doubles except those listed."""
    columns = []
    for field in df.schema.fields:
        name = f"`{field.name}`"
        if isinstance(field.dataType, T.DoubleType) and field.name not in keep:
            columns.append(f"round({name}, {digits_for(field.name)}) as {name}")
        else:
            columns.append(name)
    return df.selectExpr(*columns)


# ---------------------------------------------------------------- sources and sinks


@query
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole multi-line texts through the CSV sink and the all-text CSV source."""
    texts = table(spark, sf_dir, "conversations").selectExpr(
        "cast(conv_id as string) as conv_id", "cast(turn as string) as turn", "role", "text"
    )
    path = Workspace(spark).path("csv")
    writers.write_csv(texts, path)
    return readers.read_raw_csv(spark, path, all_text(texts.columns), multi_line=True)


@query
def csv_quotes_in_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes inside unquoted fields are plain characters, also beside quoted line breaks."""
    lines = table(spark, sf_dir, "part").selectExpr(
        """cast(p_partkey as string) || ',' || p_size || '" x ' || p_size || '",' || '"' || p_name || '
""' || p_brand || '"",' || p_type || '"' as value"""
    )
    path = Workspace(spark).path("quotes")
    lines.write.text(path)
    return readers.read_raw_csv(spark, path, all_text(("part", "size", "label")), multi_line=True, header=False)


@query
def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_if_tokens(
        inputs.part_d_file(spark, sf_dir).select(
            "prscrbr_npi", "prscrbr_city", "brnd_name", "gnrc_name", "tot_benes", "ge65_sprsn_flag", "ge65_tot_clms"
        )
    )


@query
def registry_prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.prefilter_registry(inputs.registry_file(spark, sf_dir))


@query
def seed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = inputs.raw_registry(spark, sf_dir).select("npi", "primary_taxonomy_code")
    path = Workspace(spark).path("seed")
    writers.write_csv(inputs.taxonomy_seed(spark), path)
    seed = readers.read_seed(spark, path, TAXONOMY_SEED).select("taxonomy_code", "display_name")
    return registry.join(
        seed, F.col("primary_taxonomy_code") == F.col("taxonomy_code"), "left"
    ).select(
        "npi",
        "primary_taxonomy_code",
        F.coalesce("display_name", "primary_taxonomy_code").alias("specialty"),
    )


@query
def source_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    orders = table(spark, sf_dir, "orders")
    return reports.labelled_union(
        "source_name",
        {
            "events_monthly": loadchecks.source_freshness(events, "ts", loadchecks.MONTHLY, NOW),
            "orders_yearly": loadchecks.source_freshness(orders, "o_orderdate", loadchecks.YEARLY, NOW),
            "orders_when_new": loadchecks.source_freshness(
                orders, "o_orderdate", loadchecks.YEARLY, "2003-06-30 00:00:00"
            ),
        },
    )


@query
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = {"urgent": "1-URGENT", "high": "2-HIGH", "medium": "3-MEDIUM", "low": "5-LOW"}
    return catalog.latest_distribution(inputs.catalog(spark, sf_dir), titles)


@query
def table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    return writers.write_table(orders, Workspace(spark).root, "staging", "orders")


@query
def table_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written twice: the second version is read, the first one still there."""
    root = Workspace(spark).root
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for rows in (orders.filter("o_orderkey % 10 = 0"), orders):
        writers.write_table(rows, root, "staging", "versions")
    older, _ = writers.table_versions(spark, f"{root}/staging/versions")
    current = writers.read_table(spark, root, "staging", "versions")
    return reports.labelled_union("version", {"older": spark.read.schema(orders.schema).parquet(older), "current": current})


@query
def extract_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = build(spark, sf_dir)
    return writers.extract_manifest(reports.extracts(b.mart, b.dim_provider))


@query
def validate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loadchecks.validate_load(
        {
            "lineitem": (table(spark, sf_dir, "lineitem"), "l_orderkey", "l_shipdate"),
            "orders": (table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate"),
            "registry": (
                inputs.raw_registry(spark, sf_dir).withColumn("npi", F.col("primary_taxonomy_code")),
                "npi",
                "_loaded_at",
            ),
        }
    )


# ---------------------------------------------------------------- staging and scalar functions


@query
def stg_part_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_part_d(inputs.raw_part_d(spark, sf_dir))


@query
def stg_part_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_part_b(inputs.raw_part_b(spark, sf_dir))


@query
def stg_part_b_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw services landed as CSV text, with line breaks inside quotes, and loaded from there."""
    path = Workspace(spark).path("part_b")
    raw = inputs.part_b_file(spark, sf_dir)
    broken = raw.select("*", F.lit('first "line"\nsecond, line').alias("remark"))
    writers.write_csv(broken, path)
    loaded = readers.load_raw(spark, path, multi_line=True)
    remarks = loaded.filter(F.col("remark") == 'first "line"\nsecond, line').drop("remark", "_loaded_at")
    return staging.stg_part_b(remarks.withColumn("_loaded_at", F.lit(inputs.LOADED_AT).cast("timestamp_ntz")))


@query
def stg_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_registry(inputs.raw_registry(spark, sf_dir))


@query
def try_cast_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    part_d = inputs.part_d_file(spark, sf_dir)
    return part_d.select(
        "prscrbr_npi",
        try_to_int(F.col("tot_clms")).alias("claims"),
        try_to_int(F.col("tot_30day_fills")).alias("fills_rounded"),
        try_to_int(F.col("tot_benes")).alias("beneficiaries"),
        try_to_dec(F.col("tot_drug_cst"), 18, 2).alias("cost"),
        try_to_dec(F.col("ge65_tot_30day_fills"), 18, 2).alias("senior_fills"),
    )


@query
def prefix_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = inputs.raw_registry(spark, sf_dir)
    return registry.select(
        "npi", "primary_taxonomy_code", specialty_grouping(F.col("primary_taxonomy_code")).alias("specialty_grouping")
    )


@query
def drug_kind_(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.raw_part_d(spark, sf_dir)
    return raw.select("brnd_name", "gnrc_name", drug_kind(F.col("brnd_name"), F.col("gnrc_name")).alias("drug_kind"))



@query
def suppression_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_part_d(inputs.raw_part_d(spark, sf_dir)).select(
        "npi", "total_beneficiaries", "is_beneficiary_count_suppressed"
    )


@query
def individuals_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = staging.stg_part_b(inputs.raw_part_b(spark, sf_dir))
    return stg.filter(F.col("provider_entity_code") == "I").select("npi", "hcpcs_code", "place_of_service")


@query
def fallback_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.part_d_file(spark, sf_dir)
    return lines.select(
        "prscrbr_npi",
        first_nonblank(F.col("brnd_name"), F.col("prscrbr_type"), F.col("gnrc_name")).alias("label"),
        F.coalesce(F.nullif("prscrbr_state_abrvtn", F.lit("")), F.lit("none")).alias("state"),
    )


@query
def coverage_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir).provider_profile.select(
        "npi", "is_in_nppes", "is_part_d_prescriber", "is_part_b_provider"
    )


@query
def full_name_(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = inputs.raw_registry(spark, sf_dir)
    return registry.select(
        "npi",
        full_name(F.col("provider_first_name"), F.col("provider_last_name"), F.col("npi")).alias("full_name"),
    )



@query
def string_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    header = REGISTRY_HEADERS
    wide = inputs.registry_file(spark, sf_dir)
    state, city, zip_code = (F.col(f"`{header[c]}`") for c in ("practice_state", "practice_city", "practice_zip"))
    return wide.select(
        F.col(header["npi"]).alias("npi"),
        F.upper(F.trim(state)).alias("state"),
        F.initcap(F.trim(city)).alias("city"),
        F.left(F.trim(zip_code), F.lit(5)).alias("zip5"),
        F.length(F.trim(city)).alias("city_length"),
    )


@query
def numeric_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = F.col("c_acctbal").cast("decimal(18,2)")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.abs(exact).alias("size"),
        F.round(exact, 0).alias("whole"),
        F.round(exact, 1).alias("tenths"),
        (exact + 100).alias("plus"),
        (exact - 100).alias("minus"),
        (exact * 3).alias("times"),
        (F.col("c_acctbal") / F.pow(F.lit(2.0), F.lit(10.0))).alias("scaled"),
    )


@query
def derived_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir).fct_part_d.select(
        "npi",
        "distinct_drugs_total",
        (F.col("brand_cost_share") - F.col("brand_claims_share")).alias("share_gap"),
        (F.col("total_drug_cost").cast("double") / F.lit(1e9)).alias("cost_billions"),
        (F.lit(100.0) * F.col("brand_cost_share")).alias("brand_cost_pct"),
    )


@query
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return all_ids(
        "npi",
        inputs.raw_registry(spark, sf_dir),
        inputs.part_d_file(spark, sf_dir).withColumnRenamed("prscrbr_npi", "npi"),
        inputs.part_b_file(spark, sf_dir).withColumnRenamed("rndrng_npi", "npi"),
    )


# ---------------------------------------------------------------- rollups


@query
def part_d_annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir).part_d_annual


@query
def part_b_annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir).part_b_annual


@query
def weighted_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = staging.stg_part_b(inputs.raw_part_b(spark, sf_dir))
    return stg.groupBy("hcpcs_code", "place_of_service").agg(
        *[
            weighted_total(F.col(average), F.col("total_services")).alias(total)
            for total, average in rollups.PART_B_TOTALS.items()
        ]
    )


@query
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = staging.stg_part_d(inputs.raw_part_d(spark, sf_dir))
    return stg.groupBy("npi").agg(
        F.count_distinct("generic_name").alias("distinct_generics"),
        F.count_distinct("brand_name").alias("distinct_brands"),
    )


@query
def conditional_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = staging.stg_part_d(inputs.raw_part_d(spark, sf_dir))
    return stg.groupBy("prescriber_state").agg(*[c.alias(n) for n, c in rollups.conditional_sums().items()])


@query
def dominant_attr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heaviest attribute per entity; combined by attribute first, as the rollups do."""
    stg = staging.stg_part_d(inputs.raw_part_d(spark, sf_dir))
    heaviest = stg.groupBy("npi", "prescriber_specialty_text").agg(F.max("total_claims").alias("claims"))
    return heaviest.groupBy("npi").agg(dominant("prescriber_specialty_text", "claims").alias("specialty_text"))


@query
def safe_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", safe_ratio(F.lit(1000), F.col("c_acctbal").cast("decimal(18,2)")).alias("ratio")
    )


# ---------------------------------------------------------------- profile, dimension, facts


@query
def provider_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir).provider_profile


@query
def dim_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir).dim_provider


@query
def fct_part_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir).fct_part_d


@query
def fct_part_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(spark, sf_dir).fct_part_b


@query
def provider_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = build(spark, sf_dir)
    joined = profile.with_metrics(b.dim_provider, b.fct_part_d, b.fct_part_b)
    return joined.select("npi", "taxonomy_code", "state", *[m.value for m in METRICS])


# ---------------------------------------------------------------- peer groups


@query
def peer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    population = build(spark, sf_dir).population.filter(marts.complete_keys(marts.PEER_KEYS))
    return population.groupBy(*marts.PEER_KEYS).agg(*marts.coverage_counts(METRICS))


@query
def peer_mean_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    population = build(spark, sf_dir).population.filter(marts.complete_keys(marts.PEER_KEYS))
    return rounded(population.groupBy(*marts.PEER_KEYS).agg(*marts.mean_and_stddev(METRICS)))


@query
def peer_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = build(spark, sf_dir)
    population = b.population.filter(marts.complete_keys(marts.PEER_KEYS))
    return rounded(group_medians(population, marts.PEER_KEYS, [m.value for m in METRICS], b.workspace))


@query
def peer_mad(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = build(spark, sf_dir)
    population = b.population.filter(marts.complete_keys(marts.PEER_KEYS))
    return rounded(robust_stats(population, marts.PEER_KEYS, [m.value for m in METRICS], b.workspace))


@query
def window_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = build(spark, sf_dir)
    population = b.population.select("npi", *marts.PEER_KEYS, "total_drug_cost", "part_b_total_services")
    columns = ["total_drug_cost", "part_b_total_services"]
    return rounded(with_group_median(population, marts.PEER_KEYS, columns, b.workspace))


@query
def order_line_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and MAD straight over the detail rows, where a group is a fifth of the table."""
    workspace = Workspace(spark)
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice", "l_quantity")
    stats = robust_stats(
        lines, ["l_returnflag", "l_linestatus"], ["l_extendedprice", "l_quantity"], workspace,
        extra=[F.count("*").alias("n")],
    )
    return rounded(stats)


@query
def part_price_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median and MAD over many small groups: the line prices of every part."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_extendedprice")
    return rounded(
        robust_stats(lines, ["l_partkey"], ["l_extendedprice"], Workspace(spark), extra=[F.count("*").alias("n")])
    )


@query
def peer_group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(build(spark, sf_dir).peer_group_stats)


@query
def peer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = build(spark, sf_dir)
    stats = b.peer_group_stats.select(
        F.col("canonical_taxonomy_code").alias("taxonomy_code"), "state", "n_providers", "n_part_d"
    )
    return b.dim_provider.join(stats, list(marts.PEER_KEYS)).select(
        "npi", "taxonomy_code", "state", "n_providers", "n_part_d"
    )


# ---------------------------------------------------------------- scoring


@query
def outlier_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the scored provider table."""
    return rounded(build(spark, sf_dir).mart, "brand_cost_share", "avg_cost_per_claim")


@query
def zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(build(spark, sf_dir).mart.select("npi", *[f"z_{m.name}" for m in METRICS]))


@query
def modified_zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(build(spark, sf_dir).mart.select("npi", *[f"mz_{m.name}" for m in METRICS]))


@query
def outlier_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = build(spark, sf_dir).mart
    return mart.select("npi", *[c for c in mart.columns if "outlier_" in c])


THIN = (Metric("activity", "activity", "n_activity", "activity"),)


@query
def three_valued_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metric most peers lack: scores exist, flags are false or null, the composite never null."""
    workspace = Workspace(spark)
    population = workspace.write(inputs.activity_population(spark, sf_dir), "activity")
    stats = workspace.write(marts.group_stats(population, marts.PEER_KEYS, THIN, workspace), "stats")
    scored = marts.score(population, stats, marts.PEER_KEYS, THIN)
    lenient = gated_flag(F.col("mz_activity"), 3.5, F.col("peer_n_activity"), 3)
    return rounded(scored.withColumn("lenient_flag", lenient))


@query
def severity_band_(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = build(spark, sf_dir).mart
    return mart.select("npi", severity_band(F.col("mz_part_b_services")).alias("severity_band"))



# ---------------------------------------------------------------- reports


@query
def overview_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.overview_kpis(build(spark, sf_dir).mart)


@query
def peer_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.peer_group_count(build(spark, sf_dir).mart)


@query
def kpi_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.kpi_tiles(reports.overview_kpis(build(spark, sf_dir).mart))


@query
def state_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.state_aggregates(build(spark, sf_dir).mart)


@query
def state_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.state_ranking(reports.state_aggregates(build(spark, sf_dir).mart), min_providers=100)


@query
def peer_group_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.peer_group_rates(build(spark, sf_dir).mart))


@query
def peer_group_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.peer_group_diagnostics(build(spark, sf_dir).mart))


@query
def peer_group_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The diagnostics with limits tight enough to report groups of these tables."""
    return rounded(reports.peer_group_diagnostics(build(spark, sf_dir).mart, max_rate=3, min_mad=400_000))


@query
def flag_share_by_specialty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.flag_share_by_specialty(build(spark, sf_dir).mart)


@query
def rule_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rule_comparison(build(spark, sf_dir).mart)


KEYINGS = {
    "grouping": ("nppes_specialty_grouping",),
    "state": ("state",),
    "taxonomy_state": ("taxonomy_code", "state"),
}


@query
def key_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = build(spark, sf_dir)
    return reports.flag_rate_by_key(b.population, KEYINGS, b.workspace)


@query
def filter_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.filter_options(build(spark, sf_dir).mart, "specialty")


@query
def select_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.select_metric(build(spark, sf_dir).mart, "brand_cost_share"), "metric_value")


@query
def outlier_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = reports.rank_outliers(
        build(spark, sf_dir).mart,
        "part_d_total_claims",
        threshold=2.0,
        min_peer_n=40,
        specialties=["Internal Medicine Physician", "Specialist", "Nurse Practitioner"],
        states=["AF", "EU", "AS"],
    )
    return rounded(ranked, "metric_value")


@query
def provider_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = build(spark, sf_dir)
    found = reports.find_provider(b.mart, b.dim_provider, name="customer#00000012")
    return found.select(
        "npi", "provider_full_name", "taxonomy_code", "state", "is_outlier_any_mad",
        "nucc_grouping", "nucc_classification", "nucc_specialization",
    )


@query
def ilike_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = build(spark, sf_dir).mart
    return mart.filter(F.col("specialty").ilike("%PHYSICIAN%")).select("npi", "specialty")


@query
def top_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.top_outliers(build(spark, sf_dir).mart))


@query
def specialty_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.specialty_top(build(spark, sf_dir).mart, "%physician%"))


@query
def melt_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.melt_metrics(build(spark, sf_dir).mart), "metric_value")


@query
def top_n_per_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.top_n_per_metric(build(spark, sf_dir).mart, n=100), "metric_value")


@query
def ranked_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    extract = reports.top_n_per_metric(build(spark, sf_dir).mart)
    ranked = reports.rank_extract(extract, "avg_cost_per_claim", threshold=2.5, states=["AM", "EU", "MI"])
    return rounded(ranked, "metric_value")


@query
def equal_width_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = reports.top_n_per_metric(build(spark, sf_dir).mart)
    return histogram(ranked, "modified_z_score", 0.5, ["metric"])


@query
def demo_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = build(spark, sf_dir)
    return rounded(reports.demo_providers(b.mart, b.dim_provider), "brand_cost_share", "avg_cost_per_claim")


@query
def peer_distribution_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distribution written as an ordered extract of several files and read back with each row's place."""
    mart = build(spark, sf_dir).mart
    path = Workspace(spark).path("distribution")
    rows = reports.peer_distribution(mart, reports.demo_selection(mart), ordered=False)
    writers.write_extract(rows, path, order=reports.distribution_order(), files=5)
    return writers.read_extract(spark, path, "demo_npi string, series string, value double")


@query
def peer_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = build(spark, sf_dir).mart
    return reports.peer_distribution(mart, reports.demo_selection(mart))


def _first_selected(selected: DataFrame) -> str:
    """Name of the most extreme of a few selected entities."""
    first = selected.orderBy(F.col("mz_drug_cost").desc(), "npi").select("provider_full_name").first()
    return first[0] if first else ""


@query
def cost_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost bands of the peers of the most extreme selected entity, chosen by its name."""
    b = build(spark, sf_dir)
    selected = b.workspace.write(reports.demo_selection(b.mart), "selected")
    distribution = reports.peer_distribution(b.mart, selected)
    return reports.cost_bands(distribution, selected, _first_selected(selected))


@query
def drill_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = build(spark, sf_dir)
    providers = b.workspace.write(reports.demo_providers(b.mart, b.dim_provider), "demo_providers")
    return rounded(reports.drill_down(providers, _first_selected(providers)), "brand_cost_share")


@query
def peer_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = build(spark, sf_dir)
    return rounded(reports.peer_position(b.mart, reports.demo_selection(b.mart), b.workspace))


@query
def brand_share_opportunity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.brand_share_opportunity(build(spark, sf_dir).mart)


@query
def brand_switch_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.brand_switch_targets(build(spark, sf_dir).mart).drop("talking_point")


@query
def talking_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.brand_switch_targets(build(spark, sf_dir).mart).select("npi", "talking_point")


# The same lists with limits below what the test data offer, so that the cut and the order at it count.


@query
def top_outliers_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.top_outliers(build(spark, sf_dir).mart, n=3))


@query
def specialty_top_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.specialty_top(build(spark, sf_dir).mart, "%", n=4))


@query
def provider_lookup_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = build(spark, sf_dir)
    return reports.find_provider(b.mart, b.dim_provider, name="customer#", limit=9).select(
        "npi", "provider_full_name", "taxonomy_code", "state", "is_outlier_any_mad",
        "nucc_grouping", "nucc_classification", "nucc_specialization",
    )


@query
def outlier_table_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = reports.rank_outliers(build(spark, sf_dir).mart, "part_d_total_claims", threshold=1.0, min_peer_n=30, limit=11)
    return rounded(ranked, "metric_value")


@query
def ranked_extract_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    extract = reports.top_n_per_metric(build(spark, sf_dir).mart, n=40)
    return rounded(reports.rank_extract(extract, "avg_cost_per_claim", threshold=0.5, limit=12), "metric_value")


@query
def brand_share_opportunity_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.brand_share_opportunity(build(spark, sf_dir).mart, min_providers=5, n=6)


@query
def brand_switch_targets_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.brand_switch_targets(build(spark, sf_dir).mart, min_gap=0.02, n=8).drop("talking_point")


@query
def priority_tier_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", priority_tier(F.col("o_totalprice") * 4).alias("priority_tier")
    )



# ---------------------------------------------------------------- data quality


@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = build(spark, sf_dir)
    return quality.not_null_summary(
        {
            "part_d_annual": (b.part_d_annual, ("npi", "data_year", "prescriber_state", "total_drug_cost")),
            "provider_profile": (b.provider_profile, ("npi", "specialty", "state", "taxonomy_code")),
            "provider_outliers": (b.mart, ("npi", "specialty", "state", "is_outlier_any_mad", "mz_part_b_payment")),
        }
    )


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = build(spark, sf_dir)
    return quality.unique_summary(
        {
            "provider_profile": (b.provider_profile, "npi"),
            "provider_outliers": (b.mart, "npi"),
            "lineitem": (table(spark, sf_dir, "lineitem"), "l_orderkey"),
        }
    )


@query
def dq_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    stg = staging.stg_part_d(inputs.raw_part_d(spark, sf_dir))
    registry = staging.stg_registry(inputs.raw_registry(spark, sf_dir))
    return quality.accepted_summary(
        {
            "stg_part_d": (stg, {"drug_kind": ("brand", "generic")}, F.col("brand_name").isNotNull()),
            "stg_registry": (
                registry,
                {"entity_type_code": ("1",), "specialty_grouping": ("Physician", "Advanced Practice", "Other")},
                None,
            ),
        }
    )


@query
def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = build(spark, sf_dir)
    registry = staging.stg_registry(inputs.raw_registry(spark, sf_dir))
    within = quality.relationship_summary(
        {"fct_part_d": b.fct_part_d, "fct_part_b": b.fct_part_b, "provider_outliers": b.mart}, b.dim_provider, "npi"
    )
    unregistered = quality.relationship_summary({"unregistered": b.fct_part_d}, registry, "npi")
    return within.unionByName(unregistered)


@query
def peer_floor_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = build(spark, sf_dir).mart
    strict = quality.floor_summary(mart, 50).withColumn("check_name", F.lit("peer_floor_50"))
    return quality.floor_summary(mart).unionByName(strict)


@query
def share_in_unit_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    annual = build(spark, sf_dir).part_d_annual
    return quality.count_violations("share_in_unit_interval", quality.check_unit_interval(annual)).unionByName(
        quality.count_violations(
            "cost_in_unit_interval", quality.check_unit_interval(annual, "avg_cost_per_claim")
        )
    )


@query
def flag_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = build(spark, sf_dir).mart
    return quality.flag_rate(mart).withColumn("over_ceiling", F.col("flag_rate") >= 0.08)


@query
def extract_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = build(spark, sf_dir)
    found = reports.extracts(b.mart, b.dim_provider)
    return quality.check_extracts(
        b.observed["mart"], found["tab1_overview_kpis"], found["tab4_state_aggregates"], found["tab2_outliers_top1000"]
    )


@query
def model_checks_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_checks.model_checks(build(spark, sf_dir))


# ---------------------------------------------------------------- metering


@query
def daily_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metering.daily_usage(inputs.meter(spark, sf_dir), NOW)


@query
def usage_runway(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metering.usage_runway(inputs.meter(spark, sf_dir), 10_000_000.0, NOW)


@query
def top_k_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metering.top_k_jobs(inputs.job_log(spark, sf_dir), NOW, "MAIN_WH")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored mart over a coarse key, for inputs too small for fine peer groups."""
    b = build(spark, sf_dir)
    config = OutlierConfig()
    keys = KEYINGS["grouping"]
    stats = b.workspace.write(marts.group_stats(b.population, keys, METRICS, b.workspace, config), "stats")
    return plain(rounded(marts.score(b.population, stats, keys, METRICS, config)))
