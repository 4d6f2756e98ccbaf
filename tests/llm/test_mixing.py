import collections

import pytest
from cohortlens.llm import mixing
from compare import compare, engine
from llm_samples import document, prose

MIX = ["doc_id", "size", "source", "source_size", "target", "copies", "taken"]


def targets(sizes, weights=mixing.WEIGHTS, repeats=mixing.REPEATS):
    """Water filling, one round per source that reaches its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, result, free = sum(sizes.values()), {}, list(order)
    while free:
        left = total - sum(result.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > repeats * sizes[s]]
        if not over:
            return result | share
        for s in over:
            result[s] = repeats * sizes[s]
            free.remove(s)
    return result


def test_mix_comes_near_its_targets(odd_docs):
    rows = mixing.mix(odd_docs).select(MIX).collect()
    sizes = collections.Counter()
    words = collections.Counter((r.doc_id, len((r.text or "").split())) for r in odd_docs.collect())
    assert words == collections.Counter((r.doc_id, r["size"]) for r in rows)
    for r in rows:
        sizes[r.source] += r["size"]
    expected = targets(sizes)
    taken, largest = collections.Counter(), collections.Counter()
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
        assert r.taken == r.copies * r["size"] <= 3 * r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    assert sum(taken.values()) <= sum(sizes.values())
    assert all(abs(taken[s] - expected[s]) <= max(largest.values()) for s in sizes)


def test_reruns_agree_however_rows_lie(odd_docs):
    first = sorted(map(str, mixing.mix(odd_docs).select(MIX).collect()))
    assert first == sorted(map(str, mixing.mix(odd_docs.repartition(7)).select(MIX).collect()))


@pytest.mark.parametrize("digits,slices", [(1, 1), (2, 7), (3, 8192)])
def test_slices_do_not_matter(odd_docs, monkeypatch, digits, slices):
    expected = sorted(map(str, mixing.mix(odd_docs).select(MIX).collect()))
    monkeypatch.setattr(mixing, "SHUFFLE_DIGITS", digits)
    monkeypatch.setattr(mixing, "TIME_SLICES", slices)
    assert sorted(map(str, mixing.mix(odd_docs).select(MIX).collect())) == expected


def test_small_sources_stop_at_their_limit(spark):
    rows = [document(i, prose(i, 100), source="a") for i in range(2)]
    rows += [document(10 + i, prose(i, 100), source="b") for i in range(50)]
    docs = spark.createDataFrame([r[:4] for r in rows], "doc_id long, text string, lang string, source string")
    by = {r.source: r for r in mixing.mix(docs).collect()}
    assert by["a"].target == 600 and by["b"].target == 4600
    assert all(r.copies == 3 for r in mixing.mix(docs).filter("source = 'a'").collect())


def test_mixed_rows_repeat_documents(odd_docs):
    rows = mixing.mixed_rows(odd_docs)
    assert rows.columns == odd_docs.columns
    words = sum(len((r.text or "").split()) for r in rows.collect())
    assert words == sum(r.taken for r in mixing.mix(odd_docs).collect())


def test_rows_of_one_key_and_size_are_told_apart_by_their_texts(spark):
    rows = [(7, prose(i, 40), "b") for i in range(200)] + [(None, prose(300 + i, 40), "b") for i in range(50)]
    rows += [(i, prose(900 + i, 40), "a") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    marks = docs.select("doc_id", mixing.shuffle_mark("doc_id", "text").alias("at")).distinct().filter("doc_id = 7")
    assert marks.selectExpr(f"left(at, {mixing.SHUFFLE_DIGITS})").distinct().count() > 150
    sent = [sorted(map(str, mixing.mixed_rows(docs.repartition(n)).collect())) for n in (1, 6)]
    assert sent[0] == sent[1] and 0 < sum("source='b'" in r for r in sent[0]) < 250


def test_empty_and_wordless_tables(no_docs, spark):
    assert mixing.mix(no_docs).isEmpty() and mixing.mixed_rows(no_docs).isEmpty()
    blank = spark.createDataFrame([(1, " ", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r["size"], r.taken, r.target) for r in mixing.mix(blank).collect()] == [(0, 0, 0.0)] * 2


def test_main_path_is_native(odd_docs):
    assert "Python" not in mixing.mix(odd_docs)._jdf.queryExecution().executedPlan().toString()


def test_query_agrees_with_its_twin(spark, sf_dir):
    connection = engine(sf_dir)
    assert compare(spark, connection, "op8_source_mixing", sf_dir) == ""
    connection.close()
