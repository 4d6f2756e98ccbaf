import collections

import numpy as np
import pytest
from cohortlens.llm import negatives as ng
from compare import compare, engine
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as contract

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, id string, vector string, dim string"


def brute(rows, positives=5, negatives=3, share=50):
    """Rows of the contract by comparing all, in whole numbers of Python."""
    taking = set()
    for i, v, label in rows:
        if i is None or label is None or v is None or None in v or not all(np.isfinite(v)):
            continue
        taking.add((i, label, tuple(int(np.floor(256 * x)) for x in v)))
    result = collections.Counter()
    for i, label, a in taking:
        if i % share:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v, strict=True)), j, k) for j, k, v in taking if j != i and len(v) == len(a)]
        scored.sort()
        for score, positive, _ in [s for s in scored if s[2] == label][:positives]:
            window = [s for s in scored if s[2] != label and 50 * -score <= 100 * -s[0] <= 95 * -score]
            for rank, (value, other, _) in enumerate(window[:negatives], 1):
                result[i, positive, rank, other, -score, -value] += 1
    return result


def found(spark, rows, **options):
    table = spark.createDataFrame([(i, v, k, "a", "b", "c", "d") for i, v, k in rows], SCHEMA).repartition(3)
    anchors = F.col("id") % options.pop("share", 50) == 0
    return collections.Counter(tuple(r) for r in ng.mine(table, anchors, **options).select(*ng.RESULT).collect())


def vectors(seed, n, dim=16, labels=4, scale=1.0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)) * scale
    return [(i, v, int(k)) for i, (v, k) in enumerate(zip(x.tolist(), rng.integers(0, labels, n), strict=True))]


@pytest.mark.parametrize("options", [{}, {"values_per_shard": 500}, {"values_per_shard": 900, "anchors_per_block": 3}])
def test_plain_rows_agree_with_brute_force(spark, options):
    rows = vectors(1, 600)
    expected = brute(rows, share=25)
    assert len(expected) > 200
    assert found(spark, rows, share=25, **options) == expected


@pytest.mark.parametrize("options", [{}, {"values_per_shard": 300, "anchors_per_block": 2}])
def test_ties_copies_and_odd_rows(spark, options):
    """Few distinct scores, a vector that a third of the rows share, repeated rows and ids, rows that take no part."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.integers(-1, 2, 6) / 4], int(rng.integers(0, 3))) for i in range(200)]
    rows += [(i, [0.5, 0.25, 0.0, 0.0, 0.0, -0.25], i % 3) for i in range(200, 300)]
    rows += [(50, [0.5] * 6, 1)] * 40 + [(50, [0.25] * 6, 2), (50, [0.5] * 6, 0), (51, [0.5] * 6, 1)] * 2
    rows += [(100, None, 1), (None, [0.5] * 6, 1), (150, [0.5] * 6, None), (0, [None] * 6, 1), (0, [float("nan")] * 6, 1)]
    rows += [(350, [float("inf")] + [0.5] * 5, 1), (400, [], 1), (401, [], 1), (402, [], 2), (450, [0.5] * 5, 1), (451, [0.5] * 5, 1)]
    rows += [(452, [0.25] * 5, 2), (500, [0.0] * 6, 1), (501, [0.0] * 6, 2), (-50, [0.3] * 6, 1)]
    expected = brute(rows)
    assert found(spark, rows, **options) == expected
    assert {50, 400, 450, -50} <= {r[0] for r in expected}


def test_fewer_rows_than_asked_for(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.0], 1), (2, [0.8, 0.1], 2), (3, [0.1, 0.0], 2), (50, [0.0, 1.0], 7)]
    assert found(spark, rows) == brute(rows) == {(0, 1, 1, 2, 256 * 230, 256 * 204): 1}


def test_large_components_stay_exact(spark):
    rows = vectors(3, 200, dim=4, labels=2, scale=30_000.0)
    expected = brute(rows, share=20)
    assert max(r[5] for r in expected) > 2**45 and found(spark, rows, share=20) == expected
    huge = [(0, [1e300, -1e300], 1), (1, [1e300, 0.0], 1), (2, [1e299, 1.0], 2)]
    assert all(abs(r[4]) < 2**63 for r in found(spark, huge))


def test_empty_tables(spark):
    assert found(spark, []) == found(spark, [(1, [0.5], 1), (2, [0.5], 1)]) == collections.Counter()
    assert found(spark, [(50, [0.5], None)]) == collections.Counter()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6))
def test_scan_keeps_what_is_needed_and_scores_exactly(seed):
    rng = np.random.default_rng(seed)
    dim, n = int(rng.integers(1, 40)), int(rng.integers(1, 60))
    values = rng.integers(-50, 51, (n, dim)).astype(np.int32) * (2**20 if seed % 5 == 0 else 1)
    shard = ng.Shard(dim, np.arange(n).tobytes(), np.zeros(n, np.int64).tobytes(), np.ascontiguousarray(values.T).tobytes())
    anchor = rng.integers(-50, 51, dim) * (2**20 if seed % 5 == 0 else 1)
    exact = values.astype(np.int64) @ anchor
    bound = int(np.median(exact))
    seen = []

    def needed(lower, upper):
        seen.append(len(lower))
        assert (lower <= upper).all()
        return upper >= bound

    rows, scores = shard.scan(anchor, np.arange(n), needed)
    assert (scores == exact[rows]).all()
    assert set(np.flatnonzero(exact >= bound)) == set(rows.tolist())
    assert seen == sorted(seen, reverse=True)


def test_scan_reads_less_where_dimensions_differ(spark):
    """Most of an anchor's weight in few dimensions: the bitmap is nearly empty long before the last one."""
    rng = np.random.default_rng(2)
    values = (rng.standard_normal((4000, 64)) * np.geomspace(300, 1, 64)).astype(np.int32)
    shard = ng.Shard(64, np.arange(4000).tobytes(), np.zeros(4000, np.int64).tobytes(), np.ascontiguousarray(values.T).tobytes())
    left = []
    first = ng.First(5)

    def needed(lower, upper):
        left.append(len(lower))
        return upper >= ng.kth(lower, 5)

    rows, scores = shard.scan(values[7].astype(np.int64), np.arange(4000), needed)
    first.add(scores, rows)
    exact = values.astype(np.int64) @ values[7].astype(np.int64)
    assert first.scores.tolist() == sorted(exact.tolist(), reverse=True)[:5]
    assert left[0] == 4000 and left[3] < 200


@given(st.integers(-(10**6), 10**6), st.integers(-(10**6), 10**6))
def test_bounds_are_the_contracts(positive, negative):
    low, high = ng.bounds(positive)
    assert (low <= negative <= high) == (50 * positive <= 100 * negative <= 95 * positive)


def test_query_agrees_with_its_twin(spark, sf_dir):
    connection = engine(sf_dir)
    assert compare(spark, connection, "op13_bond_hard_negatives", sf_dir) == ""
    connection.close()
    assert contract.queries()["op13_bond_hard_negatives"](spark, sf_dir).count() > 100
