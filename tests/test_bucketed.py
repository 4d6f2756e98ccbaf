"""Tables in buckets of the entity: joins, profile and key checks over them shuffle nothing."""

import pytest

from cohortlens.demo import inputs
from cohortlens.plans import profile, quality, rollups
from cohortlens.session import Workspace, input_bytes, small_tasks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def unbroadcast(spark):
    """As for tables beyond every broadcast limit."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    built = inputs.new_build(spark, sf_dir)
    yield built
    built.workspace.drop()


def test_the_join_chain_shuffles_no_written_table(spark, model, unbroadcast):
    tables = model.registry, model.part_d_annual, model.part_b_annual
    joined = profile.profile_with_facts(*tables, model.taxonomy.limit(0))
    assert "Exchange hashpartitioning(npi" not in plan(joined)
    assert plan(joined).count("Bucketed: true") >= 7
    everyone = set()
    for t in tables:
        everyone |= {r.npi for r in t.select("npi").collect()}
    found = [r.npi for r in joined.select("npi").collect()]
    assert len(found) == len(set(found)) and set(found) == everyone


def test_key_checks_shuffle_nothing(spark, model, unbroadcast):
    model.profile_with_facts
    for df in (model.part_d_annual, model.dim_provider):
        assert "Exchange hashpartitioning" not in plan(quality.check_unique(df, "npi"))
    for child in (model.fct_part_d, model.fct_part_b):
        orphans = quality.check_relationships(child, model.dim_provider, "npi")
        assert "Exchange" not in plan(orphans) and orphans.isEmpty()


def test_rollup_reads_the_detail_once(spark, sf_dir):
    detail = inputs.new_build(spark, sf_dir).stg_part_d.select(*rollups.PART_D_INPUTS)
    text = plan(rollups.part_d_annual(detail))
    assert text.count("FileScan") == plan(detail).count("FileScan")
    assert "Join" not in text.split("Generate")[0] and "Expand" not in text


def test_buckets_are_dropped_with_their_run(spark, workspace):
    rows = workspace.write_bucketed(spark.range(100).selectExpr("cast(id as string) as npi", "id"), "t", "npi")
    assert rows.count() == 100 and "Exchange hashpartitioning" not in plan(rows.groupBy("npi").count())
    name, = workspace._tables
    other = Workspace(spark)
    other.drop()
    assert spark.catalog.tableExists(name)
    workspace.drop()
    assert not spark.catalog.tableExists(name)


def test_a_registry_without_ids(spark, model):
    """Entries without an id are one entity with nothing but that."""
    registry = model.registry.limit(3).unionByName(model.registry.limit(4).selectExpr("cast(null as string) as npi", *[f"{c}" for c in profile.REGISTRY_INPUTS[1:]]))
    empty = model.part_d_annual.limit(0), model.part_b_annual.limit(0)
    rows = profile.profile_with_facts(registry, *empty, model.taxonomy).collect()
    unknown = [r for r in rows if r.npi is None]
    assert len(rows) == 4 and len(unknown) == 1
    assert not unknown[0].is_in_nppes and unknown[0].specialty == "Unknown" and unknown[0].provider_first_name is None


SETTINGS = (
    "spark.sql.files.maxPartitionBytes",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
)


def test_rollups_run_in_small_tasks(spark, sf_dir, monkeypatch):
    """What a task of the wide aggregates takes in does not depend on the planner's 64 MB and more."""
    before = [spark.conf.get(name, None) for name in SETTINGS]
    seen = {}
    write = Workspace.write_bucketed

    def recorded(self, df, name, *args, **options):
        seen[name] = [int(spark.conf.get(setting)) for setting in SETTINGS]
        return write(self, df, name, *args, **options)

    monkeypatch.setattr(Workspace, "write_bucketed", recorded)
    built = inputs.new_build(spark, sf_dir)
    built.profile_with_facts
    built.workspace.drop()
    assert {"part_d_annual", "part_b_annual", "registry", "provider_profile"} == seen.keys()
    assert set(map(tuple, seen.values())) == {(8 << 20, 8 << 20, 4)}
    assert [spark.conf.get(name, None) for name in SETTINGS] == before


def test_partitions_grow_with_the_input(spark, sf_dir):
    assert input_bytes(spark.read.parquet(f"{sf_dir}/orders.parquet"), spark.read.parquet(f"{sf_dir}/orders.parquet")) > 30_000
    assert input_bytes(spark.range(3)) == 0
    with small_tasks(spark, 33 << 20), small_tasks(spark, 0):
        assert spark.conf.get(SETTINGS[2]) == "20"
    with pytest.raises(ZeroDivisionError), small_tasks(spark, 0):
        1 / 0
    assert spark.conf.get(SETTINGS[2], None) is None
