"""Column functions on crafted values."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortlens import functions as fn
from cohortlens.operators.relational import dominant, histogram, top_n_per


def values(spark, expression, rows, schema):
    """The expression's value for each row, in order."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_try_to_int_rounds_half_up_and_forgives(spark):
    rows = [("12.5",), ("12.4999999",), ("-12.5",), ("7",), ("*",), ("",), ("1,234",), (None,), ("1e3",), ("9" * 30,)]
    assert values(spark, fn.try_to_int(F.col("c")), rows, "c string") == [
        13, 12, -13, 7, None, None, None, None, 1000, None,
    ]


def test_try_to_dec_is_null_when_out_of_range(spark):
    rows = [("12.345",), ("abc",), ("1" * 17,), (" 5 ",)]
    assert values(spark, fn.try_to_dec(F.col("c"), 18, 2), rows, "c string") == [
        Decimal("12.35"), None, None, Decimal("5.00"),
    ]


@pytest.mark.parametrize(
    ("brand", "generic", "kind"),
    [
        ("Aspirin", "ASPIRIN", "generic"),
        ("Brandol", "aspirin", "brand"),
        ("Brandol", None, "brand"),
        ("   ", "aspirin", None),
        ("", None, None),
        (None, "aspirin", None),
    ],
)
def test_drug_kind(spark, brand, generic, kind):
    got = values(spark, fn.drug_kind(F.col("b"), F.col("g")), [(brand, generic)], "b string, g string")
    assert got == [kind]


def test_null_tokens_trim_and_leave_other_types_alone(spark):
    df = spark.createDataFrame([(" * ", "NULL", 1), ("", " x ", None), (None, "null", 3)], "a string, b string, n int")
    assert [tuple(r) for r in fn.null_if_tokens(df).collect()] == [
        (None, None, 1), (None, "x", None), (None, "null", 3),
    ]


def test_null_tokens_with_odd_names_and_tokens(spark):
    df = spark.createDataFrame([("it's", "-")], "`a b` string, `c.d` string")
    assert [tuple(r) for r in fn.null_if_tokens(df, ("it's", "#")).collect()] == [(None, "-")]


def test_first_nonblank_and_full_name(spark):
    rows = [(" ", "b"), ("", " "), (None, None), ("a ", "b")]
    assert values(spark, fn.first_nonblank(F.col("x"), F.col("y")), rows, "x string, y string") == [
        "b", None, None, "a",
    ]
    names = [("ANN", "LEE"), (None, "LEE"), ("ANN", None), (" ", ""), (None, None)]
    got = values(spark, fn.full_name(F.col("f"), F.col("l"), F.lit("77")), names, "f string, l string")
    assert got == ["ANN LEE", "LEE", "ANN", "77", "77"]


def test_specialty_grouping_prefixes(spark):
    rows = [("207R00000X",), ("208D00000X",), ("363L",), ("171100000X",), ("193",), ("12",), (None,)]
    assert values(spark, fn.specialty_grouping(F.col("c")), rows, "c string") == [
        "Physician", "Physician", "Advanced Practice", "Other Service Provider", "Group", "Other", "Other",
    ]


def test_safe_ratio_guards_the_denominator(spark):
    rows = [(1, 2), (1, 0), (1, -4), (None, 2), (1, None)]
    assert values(spark, fn.safe_ratio(F.col("n"), F.col("d")), rows, "n int, d int") == [0.5, None, None, None, None]


def test_scores_without_spread_are_null(spark):
    rows = [(5.0, 0.0), (5.0, None), (5.0, 2.0), (None, 2.0)]
    schema = "v double, s double"
    assert values(spark, fn.zscore(F.col("v"), F.lit(1.0), F.col("s")), rows, schema) == [None, None, 2.0, None]
    got = values(spark, fn.modified_zscore(F.col("v"), F.lit(1.0), F.col("s")), rows, schema)
    assert got == [None, None, pytest.approx(0.6745 * 2), None]


def test_flag_is_three_valued_and_the_threshold_counts(spark):
    rows = [(3.5, 30), (-3.5, 30), (3.4999, 30), (9.0, 29), (None, 30), (None, 29), (9.0, None)]
    flag = fn.gated_flag(F.col("s"), 3.5, F.col("n"), 30)
    assert values(spark, flag, rows, "s double, n int") == [True, True, False, False, None, False, None]


def test_composite_is_never_null(spark):
    rows = [(None, None), (None, True), (False, None), (False, False)]
    assert values(spark, fn.any_of([F.col("a"), F.col("b")]), rows, "a boolean, b boolean") == [
        False, True, False, False,
    ]


def test_bands_and_tiers(spark):
    rows = [(999.99,), (1000.0,), (99_999.0,), (1e6,), (1e7,)]
    assert values(spark, F.left(fn.cost_band(F.col("c")), F.lit(1)), rows, "c double") == ["1", "2", "3", "5", "6"]
    rows = [(1e6,), (999_999.0,), (250_000.0,), (249_999.0,)]
    assert values(spark, F.left(fn.priority_tier(F.col("c")), F.lit(6)), rows, "c double") == [
        "Tier 1", "Tier 2", "Tier 2", "Tier 3",
    ]
    rows = [(-10.0,), (3.5,), (3.4,), (None,)]
    assert values(spark, fn.severity_band(F.col("c")), rows, "c double") == ["extreme", "elevated", "typical", None]


def test_dominant_breaks_ties_and_skips_missing_weights(spark):
    rows = [("k", "a", 5), ("k", "b", 5), ("k", "z", None), ("m", None, 9), ("m", "c", 1), ("n", "d", None)]
    df = spark.createDataFrame(rows, "k string, attribute string, weight int")
    got = {r.k: r.a for r in df.groupBy("k").agg(dominant("attribute", "weight").alias("a")).collect()}
    assert got == {"k": "b", "m": None, "n": None}


@pytest.mark.parametrize("threshold", ["1000", "1"])
def test_top_n_per_is_the_same_with_and_without_slices(spark, threshold):
    df = spark.range(500).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 101).alias("v"), "id")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
    try:
        got = top_n_per(df, ["g"], [F.col("v").desc(), F.col("id")], 5).collect()
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    rows = sorted(((i % 3, -(i * 7 % 101), i) for i in range(500)))
    expected = {r for g in range(3) for r in [x for x in rows if x[0] == g][:5]}
    assert {(r.g, -r.v, r.id) for r in got} == expected


def test_histogram_counts_every_value_once(spark):
    df = spark.createDataFrame([("a", -0.1), ("a", 0.0), ("a", 0.49), ("a", 0.5), ("b", None)], "s string, v double")
    got = {(r.s, r.bin_start): r.n for r in histogram(df, "v", 0.5, ["s"]).collect()}
    assert got == {("a", -0.5): 1, ("a", 0.0): 2, ("a", 0.5): 1}


def test_fixed_values_are_what_they_were_agreed_to_be():
    """Literals, so that a changed constant cannot pass with its twin in SQL, which takes some from the package."""
    from cohortlens.functions import labels

    assert labels.SPECIALTY_GROUPINGS == {
        "171": "Other Service Provider",
        "174": "Other Service Provider",
        "193": "Group",
        "207": "Physician",
        "208": "Physician",
        "291": "Laboratory",
        "333": "Supplier",
        "363": "Advanced Practice",
    }
    assert [limit for limit, _ in labels.COST_BANDS] == [1_000, 10_000, 100_000, 1_000_000, 10_000_000]
    assert [label for _, label in labels.COST_BANDS] + [labels.TOP_COST_BAND] == [
        "1 · <$1k",
        "2 · $1k–10k",
        "3 · $10k–100k",
        "4 · $100k–1M",
        "5 · $1M–10M",
        "6 · ≥$10M",
    ]
    assert labels.PRIORITY_TIERS == ((1_000_000, "Tier 1 (>=$1M)"), (250_000, "Tier 2 ($250k-$1M)"))
    assert (labels.EXTREME_SCORE, labels.ELEVATED_SCORE, labels.LOWEST_TIER) == (10.0, 3.5, "Tier 3 (<$250k)")
