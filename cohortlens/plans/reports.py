"""Reports, extracts and analyses over the scored mart; every one is a lazy DataFrame.

Ranked lists always end with the entity's key, so that repeated runs agree on ties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.config import METRIC_BY_VALUE, METRICS, Metric, OutlierConfig
from cohortlens.functions import cost_band, count_if, pct, priority_tier, safe_ratio
from cohortlens.operators.relational import labelled_union, top_n_per
from cohortlens.operators.robust import group_medians
from cohortlens.plans import marts
from cohortlens.session import Workspace

PEERS_BY_NAME = ("specialty", "state")


# ---------------------------------------------------------------- totals and rollups


def _flag_summary(n: str) -> list[Column]:
    return [
        F.count("*").alias(n),
        count_if(F.col("is_outlier_any_mad")).alias("flagged_mad"),
        count_if(F.col("is_outlier_any_zscore")).alias("flagged_zscore"),
        pct(count_if(F.col("is_outlier_any_mad")), F.count("*")).alias("pct_flagged_mad"),
        pct(count_if(F.col("is_outlier_any_zscore")), F.count("*")).alias("pct_flagged_zscore"),
    ]


def _spend(column: str) -> Column:
    """Whole currency units; the sum is exact, so the rounding is repeatable."""
    return F.round(F.sum(column), 0).cast("bigint")


def overview_kpis(mart: DataFrame) -> DataFrame:
    """One row of headline numbers. Rates divide by all rows, active or not."""
    return mart.agg(
        *_flag_summary("total_providers_in_mart"),
        count_if(F.col("part_d_prescriber_flag")).alias("part_d_prescribers"),
        count_if(F.col("part_b_provider_flag")).alias("part_b_providers"),
        _spend("total_drug_cost").alias("total_part_d_spend_usd"),
        _spend("total_medicare_payment").alias("total_part_b_spend_usd"),
    ).select(
        "total_providers_in_mart",
        "part_d_prescribers",
        "part_b_providers",
        "flagged_mad",
        "flagged_zscore",
        "pct_flagged_mad",
        "pct_flagged_zscore",
        "total_part_d_spend_usd",
        "total_part_b_spend_usd",
    )


def peer_group_count(mart: DataFrame) -> DataFrame:
    """Number of distinct peer groups in the mart."""
    return mart.agg(F.count_distinct("taxonomy_code", "state").alias("peer_groups"))


def kpi_tiles(kpis: DataFrame) -> DataFrame:
    """Headline tiles, with the spend in billions."""
    return kpis.select(
        "total_providers_in_mart",
        "flagged_mad",
        "pct_flagged_mad",
        "flagged_zscore",
        "pct_flagged_zscore",
        (F.col("total_part_d_spend_usd").cast("double") / F.lit(1e9)).alias("part_d_spend_b"),
    )


def state_aggregates(mart: DataFrame) -> DataFrame:
    return (
        mart.filter(F.col("state").isNotNull())
        .groupBy("state")
        .agg(
            *_flag_summary("n_providers"),
            _spend("total_drug_cost").alias("total_part_d_spend"),
            _spend("total_medicare_payment").alias("total_part_b_spend"),
        )
        .orderBy("state")
    )


def state_ranking(states: DataFrame, min_providers: int = 1000) -> DataFrame:
    """Two-letter states with enough providers, by flag rate."""
    return (
        states.filter((F.length("state") == 2) & (F.col("n_providers") > min_providers))
        .select("state", "n_providers", "flagged_mad", "pct_flagged_mad", "total_part_d_spend")
        .orderBy(F.col("pct_flagged_mad").desc(), "state")
    )


def peer_group_rates(mart: DataFrame) -> DataFrame:
    """Flag counts and rates of every peer group, as named in the mart."""
    groups = mart.groupBy("specialty", "state", "peer_group_n", "median_drug_cost", "mad_drug_cost").agg(
        F.count("*").alias("providers_in_mart"),
        count_if(F.col("is_outlier_any_mad")).alias("flagged_mad"),
        count_if(F.col("is_outlier_any_zscore")).alias("flagged_zscore"),
    )
    return groups.withColumns(
        {
            "pct_flagged_mad": pct(F.col("flagged_mad"), F.col("providers_in_mart"), 1),
            "pct_flagged_zscore": pct(F.col("flagged_zscore"), F.col("providers_in_mart"), 1),
        }
    )


def peer_group_diagnostics(mart: DataFrame, max_rate: float = 40, min_mad: float = 1) -> DataFrame:
    """Groups that flag suspiciously often, or whose members are suspiciously alike."""
    return (
        peer_group_rates(mart)
        .filter((F.col("pct_flagged_mad") > max_rate) | (F.col("mad_drug_cost") < min_mad))
        .orderBy(F.col("pct_flagged_mad").desc(), "specialty", "state")
    )


def flag_share_by_specialty(mart: DataFrame) -> DataFrame:
    """Specialties by their share of all flags."""
    flagged = mart.groupBy("specialty").agg(count_if(F.col("is_outlier_any_mad")).alias("flagged_mad"))
    total = flagged.agg(F.sum("flagged_mad")).scalar()
    return flagged.select(
        "specialty", "flagged_mad", pct(F.col("flagged_mad"), total).alias("pct_of_flags")
    ).orderBy(F.col("flagged_mad").desc(), "specialty")


def rule_comparison(mart: DataFrame, config: OutlierConfig = OutlierConfig()) -> DataFrame:
    """Both rules side by side: threshold, flagged entities, rate."""
    rules = (
        ("Classical z-score", config.z_threshold, "zscore"),
        ("Modified z-score", config.mad_threshold, "mad"),
    )
    rows = [
        F.struct(
            F.lit(label).alias("method"),
            F.lit(threshold).alias("threshold"),
            F.col(f"flagged_{rule}").alias("flagged"),
            F.col(f"pct_flagged_{rule}").alias("pct_flagged"),
        )
        for label, threshold, rule in rules
    ]
    return mart.agg(*_flag_summary("total")).select(F.inline(F.array(*rows)))


def flag_rate_by_key(
    population: DataFrame,
    keyings: dict[str, Sequence[str]],
    workspace: Workspace,
    config: OutlierConfig = OutlierConfig(),
    metrics: Sequence[Metric] = METRICS,
) -> DataFrame:
    """The same rules under different grouping keys: groups, scored entities, flag rate.

    Every row takes part once per keying, so that all keyings are covered by the same passes.
    """
    groupings = [
        F.struct(
            F.lit(label).alias("grouping_key"),
            F.array(*[F.col(k).cast("string") for k in keys]).alias("group_values"),
        )
        for label, keys in keyings.items()
    ]
    values = dict.fromkeys(m.value for m in metrics)
    keyed = population.select(*values, F.inline(F.array(*groupings))).filter(
        F.forall("group_values", lambda v: v.isNotNull())
    )
    keys = ("grouping_key", "group_values")
    stats = workspace.write(marts.group_stats(keyed, keys, metrics, workspace, config), "stats")
    counted = stats.groupBy("grouping_key").agg(F.count("*").alias("peer_groups"))
    found = (
        marts.score(keyed, stats, keys, metrics, config, spread=True)
        .groupBy("grouping_key")
        .agg(
            F.count("*").alias("providers"),
            count_if(F.col("is_outlier_any_mad")).alias("flagged_mad"),
            pct(count_if(F.col("is_outlier_any_mad")), F.count("*")).alias("pct_flagged_mad"),
        )
    )
    # A keying without any group of sufficient size is reported as well.
    labels = F.explode(F.array(*[F.lit(label) for label in keyings])).alias("grouping_key")
    every = stats.sparkSession.range(1).select(labels)
    return every.join(counted, "grouping_key", "left").join(found, "grouping_key", "left").select(
        "grouping_key",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("peer_groups", "providers", "flagged_mad")],
        "pct_flagged_mad",
    )


# ---------------------------------------------------------------- ranked lists


def select_metric(mart: DataFrame, metric: str) -> DataFrame:
    """The ranked-list columns for one metric, chosen by its name."""
    chosen = METRIC_BY_VALUE[metric]
    return mart.select(
        "npi",
        "provider_full_name",
        "specialty",
        "state",
        "city",
        "peer_group_n",
        F.col(chosen.peer_n).alias("peer_n_metric"),
        F.col(chosen.value).alias("metric_value"),
        F.col(f"mz_{chosen.name}").alias("modified_z_score"),
    )


def _ranked(
    rows: DataFrame,
    threshold: float,
    min_peer_n: int,
    specialties: Sequence[str] | None,
    states: Sequence[str] | None,
    limit: int,
) -> DataFrame:
    rows = rows.filter((F.col("peer_n_metric") >= min_peer_n) & (F.abs("modified_z_score") >= threshold))
    if specialties:
        rows = rows.filter(F.col("specialty").isin(*specialties))
    if states:
        rows = rows.filter(F.col("state").isin(*states))
    return rows.orderBy(F.abs("modified_z_score").desc_nulls_last(), "npi").limit(limit)


def rank_outliers(
    mart: DataFrame,
    metric: str = "total_drug_cost",
    threshold: float = 3.5,
    min_peer_n: int = 30,
    specialties: Sequence[str] | None = None,
    states: Sequence[str] | None = None,
    limit: int = 1000,
) -> DataFrame:
    """Most extreme entities on one metric; empty filters admit everything."""
    return _ranked(select_metric(mart, metric), threshold, min_peer_n, specialties, states, limit)


def rank_extract(
    extract: DataFrame,
    metric: str = "total_drug_cost",
    threshold: float = 3.5,
    min_peer_n: int = 30,
    specialties: Sequence[str] | None = None,
    states: Sequence[str] | None = None,
    limit: int = 1000,
) -> DataFrame:
    """The same list out of the top-n extract; filters narrow that extract, not the mart."""
    rows = extract.filter(F.col("metric") == metric).drop("metric")
    return _ranked(rows, threshold, min_peer_n, specialties, states, limit)


def drill_down(providers: DataFrame, name: str) -> DataFrame:
    """The headline values of one selected entity, by its display name."""
    return providers.filter(F.col("provider_full_name") == name).select(
        "provider_full_name",
        "specialty",
        "state",
        "city",
        "total_drug_cost",
        "mz_drug_cost",
        "part_d_total_claims",
        "brand_cost_share",
        "total_medicare_payment",
        "peer_group_n",
    )


def top_outliers(mart: DataFrame, n: int = 100) -> DataFrame:
    """Flagged entities by their modified z-score on drug cost."""
    return (
        mart.filter(F.col("outlier_mad_drug_cost") & F.col("total_drug_cost").isNotNull())
        .orderBy(F.col("mz_drug_cost").desc_nulls_last(), "npi")
        .limit(n)
        .select(
            "npi",
            "provider_full_name",
            "specialty",
            "state",
            "city",
            "total_drug_cost",
            F.col("median_drug_cost").alias("peer_median"),
            "peer_group_n",
            F.col("mz_drug_cost").alias("modified_z_score"),
        )
    )


def specialty_top(mart: DataFrame, pattern: str, n: int = 10) -> DataFrame:
    """Leaderboard of the specialties that match a case-insensitive pattern."""
    return (
        mart.filter(F.col("outlier_mad_drug_cost") & F.col("specialty").ilike(pattern))
        .orderBy(F.col("mz_drug_cost").desc_nulls_last(), "npi")
        .limit(n)
        .select("npi", "provider_full_name", "specialty", "state", "total_drug_cost", "mz_drug_cost")
    )


def find_provider(
    mart: DataFrame, dim: DataFrame, npi: str = "", name: str = "", limit: int = 25
) -> DataFrame:
    """Entities by exact key, else by a fragment of the name, with their taxonomy attributes.

    Without either argument nothing matches. ``%`` and ``_`` in the fragment act as wildcards.
    """
    if npi:
        wanted = F.col("npi") == npi
    elif name:
        wanted = F.upper("provider_full_name").like(f"%{name.upper()}%")
    else:
        wanted = F.lit(False)
    found = mart.filter(wanted).orderBy("npi").limit(limit)
    return _with_taxonomy(found, dim)


def _with_taxonomy(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Add the dimension's taxonomy attributes to a short, limited list.

    The planner knows a limited list to be small and broadcasts it to find its entries, so the
    dimension is scanned but not shuffled. The few entries are then joined back.
    """
    attributes = ("nucc_grouping", "nucc_classification", "nucc_specialization")
    entries = dim.select("npi", *attributes).join(rows.select("npi"), "npi")
    return rows.join(entries, "npi", "left").select(*rows.columns, *attributes)


def filter_options(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)


# ---------------------------------------------------------------- extracts


def melt_metrics(
    mart: DataFrame, floor: int = 30, min_score: float = 1.0, metrics: Sequence[Metric] = METRICS
) -> DataFrame:
    """One row per entity and metric that is present, covered and away from the median.

    A single pass over the mart, whatever the number of metrics.
    """
    entries = [
        F.struct(
            F.lit(m.value).alias("metric"),
            F.col(m.peer_n).alias("peer_n_metric"),
            F.col(m.value).cast("double").alias("metric_value"),
            F.col(f"mz_{m.name}").alias("modified_z_score"),
        )
        for m in metrics
    ]
    identity = ("npi", "provider_full_name", "specialty", "state", "city", "peer_group_n")
    return (
        mart.select(*identity, F.inline(F.array(*entries)))
        .filter(
            F.col("metric_value").isNotNull()
            & (F.col("peer_n_metric") >= floor)
            & (F.abs("modified_z_score") >= min_score)
        )
        .select("metric", *identity, "peer_n_metric", "metric_value", "modified_z_score")
    )


def top_n_per_metric(mart: DataFrame, n: int = 1000) -> DataFrame:
    """The ``n`` most extreme entities of every metric."""
    order = [F.abs("modified_z_score").desc_nulls_last(), F.col("npi")]
    return top_n_per(melt_metrics(mart), ["metric"], order, n)


def demo_selection(mart: DataFrame, k: int = 6) -> DataFrame:
    """The ``k`` most extreme flagged entities on drug cost."""
    return (
        mart.filter(F.col("outlier_mad_drug_cost") & F.col("total_drug_cost").isNotNull())
        .orderBy(F.col("mz_drug_cost").desc_nulls_last(), "npi")
        .limit(k)
    )


def demo_providers(mart: DataFrame, dim: DataFrame, k: int = 6) -> DataFrame:
    """Drill-down summary of the selected entities."""
    summary = ["npi", "provider_full_name", "specialty", "taxonomy_code", "state", "city", "peer_group_n"]
    for i, m in enumerate(METRICS):
        summary += [m.value, f"mz_{m.name}"]
        if i == 0:
            summary.append("is_outlier_any_mad")
    return _with_taxonomy(demo_selection(mart, k).select(*summary), dim).orderBy(
        F.col("mz_drug_cost").desc(), "npi"
    )


def distribution_order() -> list[Column]:
    return [F.col("demo_npi"), F.col("series"), F.desc("value")]


def peer_distribution(
    mart: DataFrame, selected: DataFrame, keys: Sequence[str] = PEERS_BY_NAME, ordered: bool = True
) -> DataFrame:
    """Drug cost of each selected entity and of all its peers, as labelled series, in order unless a writer sorts them.

    While ``selected`` is a short, limited list the planner broadcasts it, and the mart is not
    shuffled however large a peer group is. Peers are matched on ``keys``; pass the taxonomy code
    instead of the display name where names are not one-to-one.
    """
    own = selected.select(F.col("npi").alias("demo_npi"), F.col("total_drug_cost").alias("value"))
    peers = mart.filter(F.col("total_drug_cost").isNotNull()).select(
        *keys, F.col("total_drug_cost").alias("value")
    )
    wanted = selected.select(F.col("npi").alias("demo_npi"), *keys)
    matched = peers.join(wanted, list(keys)).select("demo_npi", "value")
    series = labelled_union("series", {"this_provider": own, "peer_group": matched}).select("demo_npi", "series", "value")
    return series.orderBy(*distribution_order()) if ordered else series


def cost_bands(distribution: DataFrame, providers: DataFrame, name: str) -> DataFrame:
    """Number of peers of one selected entity per cost band."""
    chosen = providers.filter(F.col("provider_full_name") == name).select(F.col("npi").alias("demo_npi"))
    return (
        distribution.filter(F.col("series") == "peer_group")
        .join(chosen, "demo_npi")
        .groupBy(cost_band(F.col("value")).alias("cost_band"))
        .agg(F.count("*").alias("peer_count"))
        .orderBy("cost_band")
    )


def peer_position(
    mart: DataFrame,
    selected: DataFrame,
    workspace: Workspace,
    keys: Sequence[str] = PEERS_BY_NAME,
) -> DataFrame:
    """Where each selected entity stands among its peers: median, ratio to it, peers below."""
    series = workspace.write(peer_distribution(mart, selected, keys), "peer_series")
    peers = series.filter(F.col("series") == "peer_group")
    medians = group_medians(peers, ["demo_npi"], ["value"], workspace)
    own = series.filter(F.col("series") == "this_provider").select("demo_npi", F.col("value").alias("own_value"))
    counted = (
        peers.join(own, "demo_npi")
        .groupBy("demo_npi", "own_value")
        .agg(
            F.count("*").alias("n_peers"),
            count_if(F.col("value") < F.col("own_value")).alias("peers_below"),
        )
    )
    return counted.join(medians, "demo_npi").select(
        "demo_npi",
        "own_value",
        "n_peers",
        "peers_below",
        F.col("median_value").alias("peer_median"),
        safe_ratio(F.col("own_value"), F.col("median_value")).alias("ratio_to_median"),
    )


# ---------------------------------------------------------------- opportunity sizing


def brand_share_opportunity(
    mart: DataFrame, keys: Sequence[str] = PEERS_BY_NAME, min_providers: int = 30, n: int = 100
) -> DataFrame:
    """Cost above the peer-median brand mix, summed per cell; the largest cells first."""
    gap = F.col("brand_cost_share") - F.col("median_brand_cost_share")
    excess = F.greatest(gap, F.lit(0.0)) * F.col("total_drug_cost").cast("double")
    return (
        mart.filter(F.col("brand_cost_share").isNotNull())
        .groupBy(*keys)
        .agg(
            F.count("*").alias("providers"),
            F.round(F.sum(excess), 2).alias("total_excess_brand_cost"),
            F.round(F.avg("brand_cost_share"), 3).alias("avg_brand_share"),
            F.round(F.avg("median_brand_cost_share"), 3).alias("peer_median_brand_share"),
        )
        .filter(F.col("providers") >= min_providers)
        .orderBy(F.col("total_excess_brand_cost").desc(), *keys)
        .limit(n)
    )


def _whole(c: Column) -> Column:
    return F.round(c).cast("bigint")


def brand_switch_targets(
    mart: DataFrame,
    min_peers: int = 30,
    min_spend: float = 250_000,
    min_gap: float = 0.10,
    max_score: float = 1000,
    n: int = 200,
) -> DataFrame:
    """Entities with sizeable spend and a brand mix well above their peers, largest amount first.

    Scores beyond ``max_score`` are taken for attribution artefacts and left out.
    """
    share, median = F.col("brand_cost_share"), F.col("median_brand_cost_share")
    gap = share - median
    amount = gap * F.col("total_drug_cost").cast("double")
    eligible = (
        F.col("part_d_prescriber_flag")
        & share.isNotNull()
        & (F.col("peer_n_brand_share") >= min_peers)
        & (F.col("total_drug_cost") >= min_spend)
        & (gap >= min_gap)
        & (F.col("mz_drug_cost").isNull() | (F.col("mz_drug_cost") < max_score))
    )
    return (
        mart.filter(eligible)
        .withColumn("_amount", amount)
        .orderBy(F.col("_amount").desc(), "npi")
        .limit(n)
        .select(
            priority_tier(F.col("_amount")).alias("priority_tier"),
            "npi",
            "provider_full_name",
            "specialty",
            "state",
            "city",
            _whole(F.col("total_drug_cost")).alias("total_drug_cost_usd"),
            _whole(100 * share).alias("brand_share_pct"),
            _whole(100 * median).alias("peer_median_pct"),
            _whole(100 * gap).alias("gap_pts"),
            _whole(F.col("_amount")).alias("sized_opportunity_usd"),
            "peer_group_n",
            talking_point(share, median, F.col("_amount")).alias("talking_point"),
        )
    )


def talking_point(share: Column, median: Column, amount: Column) -> Column:
    """One sentence on the gap, with whole numbers; null when any part is."""
    # Fixed value: the wording of the sentence.
    return F.concat(
        F.lit("Runs "),
        _whole(100 * share),
        F.lit("% brand vs a peer median of "),
        _whole(100 * median),
        F.lit("% for "),
        F.col("specialty"),
        F.lit(" in "),
        F.col("state"),
        F.lit(" (n="),
        F.col("peer_group_n"),
        F.lit("). ~$"),
        _whole(amount),
        F.lit(" shifts to lower-cost equivalents at peer mix."),
    )


def extracts(mart: DataFrame, dim: DataFrame, k: int = 6, n: int = 1000) -> dict[str, DataFrame]:
    """The five serving extracts, under their file names."""
    return {
        "tab1_overview_kpis": overview_kpis(mart),
        f"tab2_outliers_top{n}": top_n_per_metric(mart, n),
        "tab3_demo_providers": demo_providers(mart, dim, k),
        "tab3_demo_peer_dist": peer_distribution(mart, demo_selection(mart, k)),
        "tab4_state_aggregates": state_aggregates(mart),
    }


