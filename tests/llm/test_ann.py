import collections

import numpy as np
import pytest
from cohortlens.llm import ann
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, rank string, score string"


def brute(rows, k=20):
    """Nearest ids and scores of every query, comparing all."""
    usable = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and None not in v]
    usable = [(i, v) for i, v in usable if np.isfinite(v).all() and v.any()]
    result = {}
    for i, q in usable:
        if i % 20 == 0:
            hits = [(-float((v * q).sum()), j) for j, v in usable if j != i and len(v) == len(q)]
            result[i] = [(j, -s) for s, j in sorted(hits)[:k]]
    return result


def found(spark, rows, **options):
    table = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], SCHEMA)
    result = collections.defaultdict(list)
    for r in ann.nearest(table, F.col("vec_id") % 20 == 0, **options).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(result[r.query_id]) + 1
        result[r.query_id].append((r.vec_id, r.score))
    return result


def vectors(seed, n, dim=16, scale=1.0):
    x = np.random.default_rng(seed).standard_normal((n, dim)).astype(np.float32) * np.float32(scale)
    return [(i, [float(c) for c in v]) for i, v in enumerate(x)]


def recall(result, expected):
    hits = [len({j for j, _ in result[q]} & {j for j, _ in near}) / max(1, len(near)) for q, near in expected.items()]
    return float(np.mean(hits))


@pytest.mark.parametrize("options", [{}, {"rows_per_shard": 300, "queries_per_block": 7}])
def test_recall_and_exact_scores(spark, options):
    rows = vectors(1, 1500)
    result, expected = found(spark, rows, **options), brute(rows)
    assert set(result) == set(expected) and all(len(r) == 20 for r in result.values())
    assert recall(result, expected) >= 0.9
    by = dict(rows)
    for q, near in result.items():
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        assert all(s == pytest.approx(float(np.dot(np.array(by[q]), np.array(by[j]))), abs=1e-12) for j, s in near)


def test_lengths_count_for_inner_product(spark):
    rows = [(i, [c * (1 + i % 7) for c in v]) for i, v in vectors(2, 800)]
    assert recall(found(spark, rows), brute(rows)) >= 0.9


def test_share_of_one_is_exact(spark):
    rows = vectors(3, 300)
    result, expected = found(spark, rows, share=32.0), brute(rows)
    assert {q: [j for j, _ in near] for q, near in result.items()} == {q: [j for j, _ in near] for q, near in expected.items()}


def test_common_vector_ties_go_to_the_smallest_ids(spark):
    rows = [(i, [1.0, 0.5, 0.0]) for i in range(400)] + [(1000 + i, [0.0, 0.0, 1.0 + i]) for i in range(5)]
    result = found(spark, rows, rows_per_shard=50)
    assert [j for j, _ in result[40]] == list(range(20))
    assert [j for j, _ in result[0]] == list(range(1, 21))


def test_what_takes_no_part(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(20, None), (40, []), (60, [0.0, 0.0]), (80, [1.0, None]), (100, [nan, 1.0]), (120, [1.0, inf]), (None, [1.0, 1.0])]
    good = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [-1.0, 0.5]), (140, [3.0, 1.0, 1.0]), (3, [1.0, 1.0, 0.0]), (1, [2.0, 1.0])]
    result = found(spark, bad + good)
    assert set(result) == {0, 140}
    assert [j for j, _ in result[0]] == [1, 1, 2] and [j for j, _ in result[140]] == [3]


def test_empty_and_lonely(spark):
    assert not found(spark, []) and not found(spark, [(20, [1.0])])


def test_ascent_stops_at_the_first_depth_that_holds_enough():
    x = np.random.default_rng(4).standard_normal((500, 8))
    forest = ann.Forest(x, trees=4, bits=16)
    strings = forest._strings(x[:20], np.zeros(20))
    low, high = forest.intervals(strings, 60)
    for i in range(20):
        counts = []
        for depth in range(17):
            shift = np.uint64(16 - depth)
            counts.append(sum(int((forest.sorted[t] >> shift == strings[t, i] >> shift).sum()) for t in range(4)))
        depth = max(d for d in range(17) if counts[d] >= 60)
        assert (high - low)[:, i].sum() == counts[depth]


SEVERAL = [{}, {"rows_per_shard": 12, "queries_per_block": 3}]


@pytest.mark.parametrize("options", SEVERAL)
def test_many_rows_of_the_querys_own_id(spark, options):
    rows = [(0, [1.0, 0.5])] * 30 + [(i, [1.0, 0.5]) for i in range(1, 26)] + [(40, [0.5, 0.5])] * 25
    assert found(spark, rows, **options)[0] == brute(rows)[0] == [(i, 1.25) for i in range(1, 21)]
    assert {j for j, _ in found(spark, rows, **options)[40]} == {0}


@pytest.mark.parametrize("options", SEVERAL)
def test_equal_scores_of_distinct_vectors_go_by_smaller_id(spark, options):
    rows = [(0, [1.0] + [0.0] * 15)] + [(i, [0.5] + [float(j == i % 15) * i for j in range(15)]) for i in range(64, 0, -1)]
    assert found(spark, rows, **options)[0] == brute(rows)[0]
    assert [j for j, _ in brute(rows)[0]] == list(range(1, 21))


def test_the_index_is_not_copied_for_blocks(spark):
    rows = vectors(9, 400)
    assert found(spark, rows, queries_per_block=2) == found(spark, rows)
