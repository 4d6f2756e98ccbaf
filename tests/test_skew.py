"""The whole model when one entity owns a third of the detail and one peer group half of the entities."""

import duckdb
import pytest

from compare import compare, engine

SOURCE = "/root/testdata/sf0.01"
QUERIES = [
    "part_d_annual",
    "part_b_annual",
    "dominant_attr",
    "distinct_counts",
    "provider_profile",
    "peer_group_stats",
    "outlier_mart",
    "top_n_per_metric",
    "peer_distribution",
    "peer_position",
    "brand_share_opportunity",
    "key_comparison",
    "window_median",
]


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    """The driver's tables with one hot customer, one hot order, one hot part and one hot peer group."""
    target = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    changed = {
        "orders": "* replace (case when o_orderkey % 3 = 0 then 7 else o_custkey end as o_custkey)",
        "customer": """* replace (case when c_custkey % 2 = 0 then 'BUILDING' else c_mktsegment end as c_mktsegment,
                       case when c_custkey % 2 = 0 then 3 else c_nationkey end as c_nationkey)""",
        "lineitem": """* replace (case when l_linenumber % 3 = 0 then 5 else l_partkey end as l_partkey,
                       case when l_suppkey % 3 = 0 then 8 else l_orderkey end as l_orderkey)""",
    }
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        columns = changed.get(name, "*")
        connection.execute(f"copy (select {columns} from '{SOURCE}/{name}.parquet') to '{target}/{name}.parquet'")
    connection.close()
    return str(target)


@pytest.fixture(scope="module")
def other_engine(skewed_dir):
    connection = engine(skewed_dir)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", QUERIES)
def test_skewed_inputs(spark, other_engine, skewed_dir, name):
    assert compare(spark, other_engine, name, skewed_dir) == ""


def test_without_any_broadcast(spark, other_engine, skewed_dir):
    """Tables beyond every broadcast limit give the same mart."""
    from cohortlens.demo import inputs

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    saved = dict(inputs._builds)
    inputs._builds.clear()
    try:
        assert compare(spark, other_engine, "outlier_mart", skewed_dir) == ""
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        inputs._builds.clear()
        inputs._builds.update(saved)
