"""Exact medians and MADs against a brute-force computation."""

import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.operators.robust import group_medians, robust_stats, with_group_median


def brute(rows):
    groups = {}
    for key, value in rows:
        groups.setdefault(key, [])
        if value is not None:
            groups[key].append(float(value))
    out = {}
    for key, found in groups.items():
        if not found:
            out[key] = (None, None)
            continue
        median = statistics.median(found)
        out[key] = (median, statistics.median(abs(v - median) for v in found))
    return out


def check(spark, workspace, rows, **options):
    df = workspace.write(spark.createDataFrame(rows, "k string, v double"), "rows")
    got = {
        r.k: (r.median_v, r.mad_v, r.n)
        for r in robust_stats(df, ["k"], ["v"], workspace, extra=[F.count("*").alias("n")], **options).collect()
    }
    expected = brute(rows)
    assert set(got) == set(expected)
    for key, (median, mad) in expected.items():
        assert got[key][0] == (None if median is None else pytest.approx(median, rel=1e-12, abs=1e-12))
        assert got[key][1] == (None if mad is None else pytest.approx(mad, rel=1e-9, abs=1e-9))


def test_small_groups(spark, workspace):
    rows = [("one", 4.0), ("two", 1.0), ("two", 2.0), ("same", 7.0), ("same", 7.0), ("same", 7.0)]
    rows += [("none", None), ("mixed", None), ("mixed", -3.0), ("mixed", 1e12), ("mixed", 0.0)]
    check(spark, workspace, rows)


def test_skewed_heavy_tailed_groups(spark, workspace):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("k"),
        F.when(F.col("id") % 7 == 0, F.round(F.rand(1) * 5)).otherwise(F.exp(F.randn(2) * 3)).alias("v"),
    )
    rows = [(r.k, r.v) for r in df.collect()]
    check(spark, workspace, rows)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_too_many_groups_to_broadcast(spark, workspace, no_broadcast, monkeypatch):
    from cohortlens.operators import joins

    monkeypatch.setattr(joins, "MAX_HOT_GROUPS", 4)
    rows = [("hot", float((i * 7919) % 1013)) for i in range(600)]
    rows += [(str(i % 90), float(i % 17)) for i in range(1200)]
    check(spark, workspace, rows)


def test_rows_of_oversized_groups_meet_in_several_tasks(spark, workspace, no_broadcast, monkeypatch):
    from cohortlens.operators import joins

    monkeypatch.setattr(joins, "MAX_HOT_GROUPS", 4)
    rows = spark.range(900, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("k"), "id"
    )
    groups = workspace.write(rows.groupBy("k").agg(F.count("*").alias("n")), "groups")
    joined = joins.join_groups(rows, groups, ["k"], "n")
    assert sorted(joined.columns) == ["id", "k", "n"]
    assert joined.count() == 900 and joined.select("id").distinct().count() == 900
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tasks = joined.withColumn("task", F.spark_partition_id()).groupBy("k").agg(F.count_distinct("task").alias("t"))
    found = {r.k: r.t for r in tasks.collect()}
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found.pop(-1) > 1 and set(found.values()) == {1}


def test_only_missed_groups_are_read_again(spark, workspace, monkeypatch):
    """A sketch that misses in one group costs a search in that group only."""
    from cohortlens.operators import robust

    rows = [(str(i % 300), float(i % 97)) for i in range(3000)] + [("bad", float(i)) for i in range(400)]
    df = workspace.write(spark.createDataFrame(rows, "k string, v double"), "rows")
    true_pass = robust._first_pass

    def poor(*args):
        near = true_pass(*args)
        off = F.when(F.col("k") == "bad", F.transform("near_v", lambda x: x + 150)).otherwise(F.col("near_v"))
        return near.withColumn("near_v", off)

    monkeypatch.setattr(robust, "_first_pass", poor)
    read = []
    true_join = robust.join_groups
    monkeypatch.setattr(robust, "join_groups", lambda r, g, k, s: read.append(g.count()) or true_join(r, g, k, s))
    got = {r.k: (r.median_v, r.mad_v) for r in robust_stats(df, ["k"], ["v"], workspace, accuracy=1000).collect()}
    expected = brute(rows)
    assert {k: pytest.approx(v) for k, v in expected.items()} == got
    # Once all groups for medians, once for deviations; every further reading is of the missed one.
    assert read.count(301) == 2 and set(read) == {301, 1}


def test_infinite_groups_are_final_at_once(spark, workspace, monkeypatch):
    rows = [(str(i % 50), float(i)) for i in range(1000)] + [("inf", float("inf"))] * 50 + [("nan", float("nan"))] * 50
    df = workspace.write(spark.createDataFrame(rows, "k string, v double"), "rows")
    names = []
    write = type(workspace).write
    monkeypatch.setattr(type(workspace), "write", lambda self, d, name: names.append(name) or write(self, d, name))
    got = {r.k: r.median_v for r in group_medians(df, ["k"], ["v"], workspace).collect()}
    assert names == ["brackets", "medians"]
    assert got["inf"] == float("inf") and got["0"] == statistics.median(float(i) for i in range(0, 1000, 50))


def test_many_groups_are_hashed(spark, workspace):
    """No aggregate falls back to sorting while the package computes over many groups."""
    from cohortlens.operators import robust

    before = spark.conf.get(robust._FALLBACK)
    with robust.many_groups(spark):
        assert int(spark.conf.get(robust._FALLBACK)) >= 10_000
    assert spark.conf.get(robust._FALLBACK) == before
    rows = [(str(i % 1500), float((i * 31) % 977)) for i in range(9000)]
    check(spark, workspace, rows)


@pytest.mark.parametrize("accuracy", [2, 3, 20])
def test_poor_sketches_are_noticed_and_widened(spark, workspace, accuracy):
    rows = [("a", float((i * 37) % 1009)) for i in range(1009)] + [("b", float(i * i)) for i in range(400)]
    check(spark, workspace, rows, accuracy=accuracy)


def test_true_infinities_end_the_search(spark, workspace):
    rows = [("a", float("inf"))] * 3 + [("a", 1.0)]
    df = workspace.write(spark.createDataFrame(rows, "k string, v double"), "rows")
    assert group_medians(df, ["k"], ["v"], workspace).collect()[0].median_v == float("inf")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.sampled_from("xyz"), st.floats(-1e6, 1e6, allow_nan=False) | st.none()), min_size=1, max_size=60
    )
)
def test_any_rows(spark, workspace, rows):
    check(spark, workspace, rows)


def test_mad_ignores_a_shift(spark, workspace):
    base = spark.range(999).select(F.lit("k").alias("k"), (F.col("id") * F.col("id") % 211).cast("double").alias("v"))
    df = workspace.write(base.withColumn("w", F.col("v") + 5000), "rows")
    row = robust_stats(df, ["k"], ["v", "w"], workspace).collect()[0]
    assert row.mad_v == row.mad_w
    assert row.median_w == row.median_v + 5000


def test_having_drops_groups_before_the_later_passes(spark, workspace):
    rows = [("big", float(i)) for i in range(10)] + [("small", 1.0)]
    df = workspace.write(spark.createDataFrame(rows, "k string, v double"), "rows")
    got = robust_stats(df, ["k"], ["v"], workspace, extra=[F.count("*").alias("n")], having=F.col("n") >= 5).collect()
    assert [(r.k, r.n, r.median_v, r.mad_v) for r in got] == [("big", 10, 4.5, 2.5)]


def test_group_median_on_every_row(spark, workspace):
    rows = [("a", 1.0), ("a", 5.0), ("b", 2.0), (None, 9.0)]
    df = workspace.write(spark.createDataFrame(rows, "k string, v double"), "rows")
    got = {(r.k, r.v): r.median_v for r in with_group_median(df, ["k"], ["v"], workspace).collect()}
    assert got == {("a", 1.0): 3.0, ("a", 5.0): 3.0, ("b", 2.0): 2.0, (None, 9.0): None}


def test_rows_are_not_shuffled(spark, workspace):
    """Each pass shuffles one combined row per group and task, never the rows themselves."""
    from cohortlens.operators import robust

    df = workspace.write(spark.range(1000).select((F.col("id") % 5).alias("k"), F.rand().alias("v")), "rows")
    near = workspace.write(robust._first_pass(df, ["k"], ["v"], (), 10_000, 2.0), "near")
    plan = robust._second_pass(df, near, ["k"], ["v"], True, 10_000, 2.0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in plan
    assert plan.index("partial_percentile(") > plan.index("Exchange hashpartitioning")
