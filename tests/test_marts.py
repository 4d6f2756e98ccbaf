"""The crafted scoring cases, rollups and the profile's rules."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortlens.config import METRICS, Metric, OutlierConfig
from cohortlens.plans import marts, profile, rollups, staging

# The crafted statistics: (mean, stddev, median, mad) per metric.
SPREAD = {
    "drug_cost": (1500.0, 800.0, 1000.0, 500.0),
    "part_d_claims": (50.0, 20.0, 45.0, 10.0),
    "brand_cost_share": (0.4, 0.1, 0.4, 0.05),
    "avg_cost_per_claim": (50.0, 10.0, 50.0, 5.0),
    "part_b_payment": (0.0, 0.0, 0.0, 0.0),
    "part_b_services": (0.0, 0.0, 0.0, 0.0),
}
CONSTANT = {m.name: (0.0, 0.0, 0.0, 0.0) for m in METRICS} | {"drug_cost": (50000.0, 0.0, 50000.0, 0.0)}


def scored(spark, npi, code, cost, claims, share, per_claim, n, n_metric, statistics):
    population = spark.createDataFrame(
        [(npi, "Name", code, "Specialty", "CA", "LA", True, False, 2023, cost, claims, share, per_claim, None, None, None)],
        """npi string, provider_full_name string, taxonomy_code string, specialty string, state string, city string,
           part_d_prescriber_flag boolean, part_b_provider_flag boolean, part_d_year int, total_drug_cost double,
           part_d_total_claims bigint, brand_cost_share double, avg_cost_per_claim double, part_b_year int,
           total_medicare_payment double, part_b_total_services bigint""",
    )
    row = {
        "canonical_taxonomy_code": code, "state": "CA", "n_providers": n, "n_part_d": n_metric, "n_part_b": 0,
        "n_brand_share_observed": n_metric, "n_avg_cost_per_claim_observed": n_metric, "specialty": "Specialty",
    }
    for name, numbers in statistics.items():
        row.update({f"{s}_{name}": v for s, v in zip(("mean", "stddev", "median", "mad"), numbers, strict=True)})
    stats = spark.createDataFrame([row])
    return marts.outlier_mart(population, stats).collect()[0]


def test_extreme_entity_is_flagged(spark):
    row = scored(spark, "1000000001", "TAX01", 100000.0, 100, 0.5, 1000.0, 100, 100, SPREAD)
    assert row.mz_drug_cost == pytest.approx(0.6745 * 99000 / 500)
    assert row.outlier_mad_drug_cost is True
    assert row.is_outlier_any_mad is True


def test_no_spread_gives_no_score_and_no_flag(spark):
    row = scored(spark, "2000000002", "TAX02", 50000.0, 50, 0.4, 1000.0, 50, 50, CONSTANT)
    assert row.mz_drug_cost is None
    assert row.outlier_mad_drug_cost is None
    assert row.is_outlier_any_mad is False


def test_thin_coverage_suppresses_the_flag_but_not_the_score(spark):
    row = scored(spark, "3000000003", "TAX03", 100000.0, 100, 0.5, 1000.0, 100, 20, SPREAD)
    assert row.mz_drug_cost == pytest.approx(0.6745 * 99000 / 500)
    assert row.outlier_mad_drug_cost is False
    assert row.is_outlier_any_mad is False


def _group(spark, workspace, size):
    rows = [(str(i), "g", float(i % 7)) for i in range(size)] + [("x", None, 1.0)]
    df = workspace.write(spark.createDataFrame(rows, "npi string, g string, v double"), "population")
    return df, (Metric("v", "v", "n_v", "v"),)


@pytest.mark.parametrize(("size", "groups"), [(30, 1), (29, 0)])
def test_group_floor(spark, workspace, size, groups):
    df, metrics = _group(spark, workspace, size)
    assert marts.group_stats(df, ["g"], metrics, workspace).count() == groups


def test_scoring_keeps_the_population_and_tighter_thresholds_flag_less(spark, workspace):
    df, metrics = _group(spark, workspace, 60)
    stats = workspace.write(marts.group_stats(df, ["g"], metrics, workspace), "stats")
    flagged = []
    for threshold in (0.5, 1.0, 1.5, 3.5):
        rows = marts.score(df, stats, ["g"], metrics, OutlierConfig(z_threshold=threshold, mad_threshold=threshold))
        assert rows.count() == 60
        flagged.append(rows.filter("is_outlier_any_mad or is_outlier_any_zscore").count())
    assert flagged == sorted(flagged, reverse=True)
    assert flagged[0] > 0


def _part_d(spark, rows):
    columns = "npi string, specialty string, state string, claims int, cost decimal(18,2), brand string, generic string"
    df = spark.createDataFrame(rows, columns)
    return df.select(
        "npi",
        F.lit(2023).alias("data_year"),
        F.col("specialty").alias("prescriber_specialty_text"),
        F.col("state").alias("prescriber_state"),
        F.lit("city").alias("prescriber_city"),
        F.col("claims").cast("bigint").alias("total_claims"),
        F.lit(1).cast("decimal(18,2)").alias("total_30day_fills"),
        F.col("cost").alias("total_drug_cost"),
        F.lit(30).cast("bigint").alias("total_day_supply"),
        staging.drug_kind(F.col("brand"), F.col("generic")).alias("drug_kind"),
        F.col("generic").alias("generic_name"),
        F.col("brand").alias("brand_name"),
    )


def test_part_d_rollup(spark):
    cost = Decimal
    rows = [
        ("1", "Cardiology", "CA", 10, cost("100.00"), "Brandol", "aspirin"),
        ("1", "Cardiology", "CA", 30, cost("300.00"), "ASPIRIN", "aspirin"),
        ("1", "Surgery", "NV", 30, cost("50.00"), " ", "other"),
        ("1", None, None, None, cost("1.00"), "Brandol", None),
        ("2", "Surgery", "NY", 5, cost("0.00"), "Brandol", "aspirin"),
        (None, "Surgery", "NY", 5, cost("7.00"), "Brandol", "aspirin"),
    ]
    got = {r.npi: r for r in rollups.part_d_annual(_part_d(spark, rows)).collect()}
    assert set(got) == {"1", "2"}
    one, two = got["1"], got["2"]
    assert (one.total_claims, one.total_drug_cost) == (70, Decimal("451.00"))
    # Both heaviest rows carry 30 claims; the greater attribute decides, column by column.
    assert (one.prescriber_specialty_text, one.prescriber_state) == ("Surgery", "NV")
    assert (one.distinct_generics, one.distinct_brands) == (2, 3)
    assert (one.brand_claims, one.generic_claims) == (10, 30)
    assert (one.brand_drug_cost, one.generic_drug_cost) == (Decimal("101.00"), Decimal("300.00"))
    assert one.brand_cost_share == pytest.approx(101 / 451)
    assert two.brand_cost_share is None
    assert two.avg_cost_per_claim == 0.0


def test_rollup_combines_before_every_shuffle(spark):
    rows = [("1", "Cardiology", "CA", 10, Decimal("1.00"), "b", "g")]
    plan = rollups.part_d_annual(_part_d(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum") > 0
    # No exchange carries rows that were not aggregated first.
    lines = [line.strip(" +-:") for line in plan.splitlines()]
    for here, below in zip(lines, lines[1:], strict=False):
        if here.startswith("Exchange"):
            assert "Aggregate" in below, below


def test_part_b_rollup_keeps_individuals_and_rebuilds_totals(spark):
    rows = [
        ("1", "I", "99213", 3, "10.5000"),
        ("1", "I", "99213", 2, None),
        ("1", "I", "99214", 1, "4.0000"),
        ("9", "O", "99214", 1, "4.0000"),
    ]
    df = spark.createDataFrame(rows, "npi string, provider_entity_code string, hcpcs_code string, n int, a string")
    average = F.col("a").cast("decimal(18,4)")
    stg = df.select(
        "npi", "provider_entity_code", "hcpcs_code",
        F.lit(2023).alias("data_year"),
        *[F.lit("x").alias(c) for c in ("provider_specialty_text", "provider_state", "provider_city")],
        *[F.col("n").cast("bigint").alias(c) for c in staging.PART_B_COUNTS],
        *[average.alias(c) for c in staging.PART_B_AVERAGES],
    )
    row, = rollups.part_b_annual(stg).collect()
    assert (row.npi, row.total_services, row.distinct_hcpcs) == ("1", 6, 2)
    assert row.total_medicare_payment == Decimal("35.5000")
    assert row.payment_to_allowed_ratio == 1.0
    assert row.avg_medicare_payment_per_service == pytest.approx(35.5 / 6)


def _sources(spark):
    registry = spark.createDataFrame(
        [
            ("1", "Ann", "Lee", "207R", "CA", "Fresno", "Physician"),
            ("2", None, "Poe", "999X", "", "", "Other"),
            ("3", None, None, None, None, None, "Other"),
        ],
        """npi string, provider_first_name string, provider_last_name string, primary_taxonomy_code string,
           practice_state string, practice_city string, specialty_grouping string""",
    ).select("*", *[F.lit(None).cast("string").alias(c) for c in ("provider_credentials", "provider_sex_code", "practice_zip5")])
    part_d = spark.createDataFrame(
        [("2", " ", "TX", "EL PASO"), ("4", "Surgery", "", "DENVER")],
        "npi string, prescriber_specialty_text string, prescriber_state string, prescriber_city string",
    ).select("*", *[F.lit(None).cast("double").alias(c) for c in ("data_year", "total_drug_cost", "total_claims", "brand_cost_share", "avg_cost_per_claim")])
    part_b = spark.createDataFrame(
        [("2", "Dentist", "NV", "RENO"), ("4", None, "CO", None)],
        "npi string, provider_specialty_text string, provider_state string, provider_city string",
    ).select("*", *[F.lit(None).cast("double").alias(c) for c in ("data_year", "total_medicare_payment", "total_services")])
    seed = spark.createDataFrame(
        [("207R", "g", "c", None, "Internal Medicine")],
        "taxonomy_code string, grouping string, classification string, specialization string, display_name string",
    )
    return registry, part_d, part_b, seed


def test_profile_fallbacks(spark):
    got = {r.npi: r for r in profile.profile_with_facts(*_sources(spark)).select(*profile.PROFILE_COLUMNS).collect()}
    assert set(got) == {"1", "2", "3", "4"}
    assert (got["1"].specialty, got["1"].state, got["1"].city) == ("Internal Medicine", "CA", "Fresno")
    # Blank claim specialty is skipped; an empty registry state falls through, an empty city does not.
    assert (got["2"].specialty, got["2"].state, got["2"].city) == ("Dentist", "TX", "")
    assert (got["3"].specialty, got["3"].state, got["3"].city) == ("Other", None, None)
    assert (got["4"].specialty, got["4"].state, got["4"].city) == ("Surgery", "CO", "Denver")
    assert got["4"].canonical_taxonomy_code is None
    flags = {k: (r.is_in_nppes, r.is_part_d_prescriber, r.is_part_b_provider) for k, r in got.items()}
    assert flags == {
        "1": (True, False, False), "2": (True, True, True), "3": (True, False, False), "4": (False, True, True),
    }


def test_dimension_names(spark):
    dim = profile.dim_provider(profile.profile_with_facts(*_sources(spark)).select(*profile.PROFILE_COLUMNS))
    assert {r.npi: r.provider_full_name for r in dim.collect()} == {"1": "Ann Lee", "2": "Poe", "3": "3", "4": "4"}
