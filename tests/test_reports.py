"""Reports and checks: properties that hold for any mart, and crafted violations."""

import pytest
from pyspark.sql import functions as F

from cohortlens.config import METRICS
from cohortlens.demo import inputs
from cohortlens.operators.relational import top_n_per
from cohortlens.plans import marts, metering, quality, reports

FINE_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    """The model at the smallest scale whose peer groups pass the floor."""
    return inputs.build(spark, FINE_DIR)


def test_group_counts_add_up_to_the_mart(model):
    mart = model.mart
    kpis = reports.overview_kpis(mart).collect()[0]
    states = reports.state_aggregates(mart).collect()
    assert sum(r.n_providers for r in states) == kpis.total_providers_in_mart == mart.count()
    assert sum(r.flagged_mad for r in states) == kpis.flagged_mad
    stats = model.peer_group_stats.agg(F.sum("n_providers")).collect()[0][0]
    assert stats == mart.count()
    assert reports.peer_group_count(mart).collect()[0][0] == model.peer_group_stats.count()


def test_composite_is_the_or_of_its_parts(model):
    parts = F.lit(False)
    for m in METRICS:
        parts = parts | F.coalesce(F.col(f"outlier_mad_{m.name}"), F.lit(False))
    assert model.mart.filter(parts != F.col("is_outlier_any_mad")).isEmpty()
    assert quality.check_not_null(model.mart, "is_outlier_any_mad").isEmpty()


def test_melt_is_a_single_pass_and_bounded(model):
    melted = reports.melt_metrics(model.mart)
    assert melted.count() <= 6 * model.mart.count()
    plan = melted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1
    assert "Exchange" not in plan


def test_top_n_is_cut_before_the_shuffle(model):
    plan = reports.top_n_per_metric(model.mart)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    rows = reports.top_n_per_metric(model.mart, 7).groupBy("metric").count().collect()
    assert {r["count"] for r in rows} == {7}


def test_top_n_beyond_sparks_own_cut(model):
    melted = reports.melt_metrics(model.mart)
    order = [F.abs("modified_z_score").desc(), F.col("npi")]
    sliced = top_n_per(melted, ["metric"], order, 1001)
    assert sliced.exceptAll(melted).isEmpty()
    counts = {r.metric: r["count"] for r in melted.groupBy("metric").count().collect()}
    for r in sliced.groupBy("metric").count().collect():
        assert r["count"] == min(1001, counts[r.metric])


def test_ranked_lists_do_not_sort_everything(model):
    for ranked in (reports.top_outliers(model.mart), reports.rank_outliers(model.mart), reports.brand_switch_targets(model.mart)):
        assert "TakeOrderedAndProject" in ranked._jdf.queryExecution().executedPlan().toString()


def test_mart_join_broadcasts_the_small_statistics(model):
    plan = marts.outlier_mart(model.population, model.peer_group_stats)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


def test_every_metric_can_be_ranked(model):
    for m in METRICS:
        rows = reports.rank_outliers(model.mart, m.value, threshold=1.0, limit=5).collect()
        scores = [abs(r.modified_z_score) for r in rows]
        assert len(rows) == 5
        assert scores == sorted(scores, reverse=True)


def test_lookup_by_key_by_name_and_without_either(model):
    wanted = model.mart.agg(F.max("npi")).collect()[0][0]
    found = reports.find_provider(model.mart, model.dim_provider, npi=wanted)
    assert [r.npi for r in found.collect()] == [wanted]
    assert reports.find_provider(model.mart, model.dim_provider, name="CUSTOMER#", limit=25).count() == 25
    assert reports.find_provider(model.mart, model.dim_provider).count() == 0


def test_peer_distribution_holds_every_peer(model):
    demo = reports.demo_selection(model.mart, 2)
    distribution = reports.peer_distribution(model.mart, demo, ("taxonomy_code", "state"))
    counts = {r.demo_npi: r["count"] for r in distribution.filter("series = 'peer_group'").groupBy("demo_npi").count().collect()}
    assert counts == {r.npi: r.peer_n_part_d for r in demo.collect()}


def test_limited_lists_are_broadcast_without_shuffling_the_mart(model):
    distribution = reports.peer_distribution(model.mart, reports.demo_selection(model.mart))
    lookup = model.dim_provider.join(reports.demo_selection(model.mart).select("npi"), "npi")
    for df in (distribution, lookup):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan
        assert "Exchange hashpartitioning" not in plan


def test_position_agrees_with_the_mart(model):
    demo = reports.demo_selection(model.mart, 3)
    keys = ("taxonomy_code", "state")
    position = {r.demo_npi: r for r in reports.peer_position(model.mart, demo, model.workspace, keys).collect()}
    for r in demo.collect():
        assert position[r.npi].peer_median == pytest.approx(r.median_drug_cost)
        assert position[r.npi].peers_below <= position[r.npi].n_peers


def test_talking_point_has_whole_numbers(model):
    text = reports.brand_switch_targets(model.mart, n=1).collect()[0].talking_point
    assert text.startswith("Runs ")
    assert ".0%" not in text
    assert "lower-cost equivalents at peer mix." in text


def test_checks_find_what_is_wrong(spark):
    df = spark.createDataFrame(
        [("1", "a", 0.5), ("1", "b", 1.5), (None, "z", -0.1), ("2", None, None)], "npi string, kind string, share double"
    )
    parent = spark.createDataFrame([("1",)], "npi string")
    assert quality.check_not_null(df, "npi").count() == 1
    assert [tuple(r) for r in quality.check_unique(df, "npi").collect()] == [("1", 2)]
    assert quality.check_accepted(df, "kind", ("a", "b")).count() == 1
    assert quality.check_accepted(df, "kind", ("a",), F.col("share") > 1).count() == 1
    assert [r.npi for r in quality.check_relationships(df, parent, "npi").collect()] == ["2"]
    assert quality.check_unit_interval(df, "share").count() == 2


def test_floor_check_finds_a_flag_on_too_few_peers(model):
    mart = model.mart
    assert quality.check_floor(mart).isEmpty()
    broken = mart.withColumn("peer_n_part_b", F.lit(12)).withColumn("outlier_mad_part_b_payment", F.lit(True))
    assert quality.check_floor(broken).count() == mart.count()


def test_flag_rate_ceiling(model):
    assert quality.check_flag_rate(model.mart).isEmpty()
    assert quality.check_flag_rate(model.mart, 0.0001).count() == 1
    assert quality.flag_rate(model.mart.limit(0)).collect()[0].flag_rate is None


def test_reconciliation_notices_a_wrong_extract(model):
    found = reports.extracts(model.mart, model.dim_provider)
    kpis, states, ranked = (found[n] for n in ("tab1_overview_kpis", "tab4_state_aggregates", "tab2_outliers_top1000"))
    good = {r.check_name: r.ok for r in quality.check_extracts(model.observed["mart"], kpis, states, ranked).collect()}
    assert set(good.values()) == {True}
    bad = quality.check_extracts(
        model.observed["mart"], kpis.withColumn("flagged_mad", F.col("flagged_mad") + 50), states.filter("state <> 'AF'"), ranked.limit(10)
    )
    failed = {r.check_name for r in bad.collect() if not r.ok}
    assert failed == {"mad_rate_follows", "state_rows", "state_flags", "ranked_rows"}


def test_checks_counted_while_tables_are_written(model):
    """Observed counts are those of a scan; only views are scanned for row-level checks."""
    from cohortlens.plans.declared import row_counts
    from cohortlens.plans.model_checks import model_checks

    for name in ("mart", "peer_group_stats", "provider_profile", "part_d_annual", "part_b_annual"):
        counts = row_counts(name, model.config)
        scanned = {r.check_name: r.n_violations for r in quality.summary(getattr(model, name), counts).collect()}
        assert {c: model.observed[name][c] for c in counts} == scanned
    totals = model.mart.agg(*[c.alias(n) for n, c in quality.mart_totals().items()]).first().asDict()
    assert {n: model.observed["mart"][n] for n in totals} == totals
    plan = model_checks(model)._jdf.queryExecution().executedPlan().toString()
    # Once for the references of its own key, and never for its rows.
    assert plan.count("provider_outliers") <= 1


def test_observed_checks_notice_violations(spark, sf_dir):
    from cohortlens.demo import inputs
    from cohortlens.plans.model_checks import model_checks

    broken = inputs.new_build(spark, sf_dir)
    broken.stg_part_d = broken.stg_part_d.withColumn("total_drug_cost", -F.col("total_drug_cost"))
    broken.taxonomy = broken.taxonomy.limit(2)
    found = {r.check_name: r.n_violations for r in model_checks(broken).collect()}
    assert found["unit_interval:part_d_annual.brand_cost_share"] == quality.check_unit_interval(broken.part_d_annual).count()
    assert found["not_null:mart.npi"] == 0
    broken.workspace.drop()


def test_reconciliation_reads_the_mart_for_the_extracts_only(model):
    found = reports.extracts(model.mart, model.dim_provider)
    names = ("tab1_overview_kpis", "tab4_state_aggregates", "tab2_outliers_top1000")
    plan = quality.check_extracts(model.observed["mart"], *[found[n] for n in names])._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan" in line and "provider_outliers" in line for line in plan.splitlines()) <= 3


def test_runway(spark):
    rows = [("2024-01-01 00:00:00", 10.0), ("2024-01-30 00:00:00", 7.0)]
    meter = spark.createDataFrame(rows, "start_time string, credits_used double").withColumn(
        "start_time", F.col("start_time").cast("timestamp_ntz")
    )
    row, = metering.usage_runway(meter, 138.0, "2024-01-31 12:00:00").collect()
    assert tuple(row) == (17.0, 138.0, 121.0, 12.3, 1.0, 121.0)
    idle, = metering.usage_runway(meter, 138.0, "2025-01-31 12:00:00").collect()
    assert idle.days_remaining_at_recent_burn is None


def test_daily_usage_window_starts_at_midnight(spark):
    rows = [("2024-01-01 00:00:00", 1.0), ("2023-12-31 23:59:59", 9.0), ("2024-01-31 11:00:00", 2.0)]
    meter = spark.createDataFrame(rows, "start_time string, credits_used double").select(
        F.col("start_time").cast("timestamp_ntz"), F.lit("w").alias("warehouse_name"), "credits_used",
        (F.col("credits_used") / 2).alias("credits_used_cloud_services"),
    )
    got = [(str(r.usage_date), r.credits) for r in metering.daily_usage(meter, "2024-01-31 12:00:00").collect()]
    assert got == [("2024-01-31 00:00:00", 2.0), ("2024-01-01 00:00:00", 1.0)]


def test_model_checks_cover_the_declared_tests_and_pass(model):
    from cohortlens.plans.declared import DECLARED
    from cohortlens.plans.model_checks import model_checks

    assert sum(len(c.not_null) for c in DECLARED.values()) == 38
    assert sum(len(c.unique) for c in DECLARED.values()) == 8
    assert sum(len(c.accepted) for c in DECLARED.values()) == 4
    assert sum(c.in_dimension for c in DECLARED.values()) == 3
    rows = model_checks(model).collect()
    assert len(rows) == len({r.check_name for r in rows}) == 53 + 3
    assert {r.check_name for r in rows if r.n_violations} == set()


def test_ranking_an_extract_gives_the_live_list(model):
    extract = reports.top_n_per_metric(model.mart)
    for metric in ("total_drug_cost", "brand_cost_share"):
        live = reports.rank_outliers(model.mart, metric, threshold=1.0, limit=50)
        served = reports.rank_extract(extract, metric, threshold=1.0, limit=50)
        assert [r.npi for r in served.collect()] == [r.npi for r in live.collect()]


def test_drill_down_by_name(model):
    providers = reports.demo_providers(model.mart, model.dim_provider)
    name = providers.collect()[0].provider_full_name
    assert [r.provider_full_name for r in reports.drill_down(providers, name).collect()] == [name]
