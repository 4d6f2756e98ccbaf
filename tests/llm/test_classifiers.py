import collections

import numpy as np
import pytest
from cohortlens.llm import features, linear, quality, toxicity
from llm_samples import document, prose
from pyspark.sql import functions as F

INSULTS = "idiot moron scum trash".split()


def junk(i):
    words = prose(i, 120).split()
    return [
        " ".join(w + "%%%" for w in words),
        " ".join(w.upper() + "!!" for w in words),
        " ".join(w for w in words[:6] for _ in range(20)),
        " | ".join(words),
    ][i % 4]


@pytest.fixture(scope="module")
def corpus(spark):
    rows, labels = [], []
    for i in range(240):
        bad, toxic = i % 6 == 0, i % 5 == 0
        text = junk(i) if bad else prose(i, 60 + i % 90)
        if toxic:
            at = len(text) // 2
            text = f"{text[:at]} {INSULTS[i % 4]} {text[at:]}"
        rows.append(document(i, text, source=f"s{i % 3}"))
        if i < 160:
            labels.append((i, int(not bad), int(toxic), "clash"))
    docs = spark.createDataFrame([r[:7] for r in rows], "doc_id long, text string, lang string, source string, n long, p string, kept string")
    return docs.repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


def site():
    return {"host": F.col("source"), "path": F.col("lang")}


def test_quality_of_documents_without_labels(corpus):
    rows = quality.judged(*corpus, **site()).collect()
    assert sorted(r.doc_id for r in rows) == list(range(240))
    assert all(r.kept == (r.doc_id % 6 != 0) for r in rows)
    assert all(0 < r.score < 1 and 0 < r.host_rate < 1 and 0 < r.path_rate < 1 for r in rows)


def test_sites_move_undecided_documents(spark):
    """Equal texts are judged by where they are; a small site stays near the global rate."""
    good, bad = prose(1, 100), " ".join(w + "%%%" for w in prose(1, 100).split())
    rows = [(i, bad, "bad", "x") for i in range(60)] + [(100 + i, good, "good", "x") for i in range(60)] + [(300, good, "new", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, 0) for i in range(40)] + [(100 + i, 1) for i in range(40)], "doc_id long, quality int")
    found = {r.doc_id: r for r in quality.judged(docs, labels, **site()).collect()}
    assert found[0].path_rate < 0.2 and found[100].path_rate > 0.8
    assert 0.3 < found[300].path_rate < 0.9


def test_keep_good_returns_whole_rows(corpus):
    docs, labels = corpus
    kept = quality.keep_good(docs, labels, **site())
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(240) if i % 6]


def test_odd_rows_do_not_break_the_classifiers(odd_docs, odd_labels, no_docs):
    keys = collections.Counter(r.doc_id for r in odd_docs.collect())
    assert collections.Counter(r.doc_id for r in quality.judged(odd_docs, odd_labels, **site()).collect()) == keys
    assert collections.Counter(r.doc_id for r in toxicity.toxic(odd_docs, odd_labels).collect()) == keys
    assert quality.judged(no_docs, odd_labels, **site()).isEmpty()
    assert toxicity.toxic(no_docs, odd_labels).isEmpty()
    nothing = odd_labels.limit(0)
    assert all(r.kept for r in quality.judged(odd_docs, nothing, **site()).collect())
    assert collections.Counter(r.doc_id for r in toxicity.toxic(odd_docs, nothing).collect()) == keys


def test_chain_finds_insults(corpus):
    rows = toxicity.toxic(*corpus).collect()
    assert rows[0].asDict().keys() == {"doc_id", "p_quality", "p_toxic", "is_toxic"}
    wrong = [r.doc_id for r in rows if r.is_toxic != (r.doc_id % 5 == 0)]
    assert len(wrong) <= 2
    assert sum(r.p_quality > 0.5 for r in rows if r.doc_id % 6) > 190


def test_later_links_see_out_of_fold_predictions():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 2))
    first = (x[:, 0] > 0).astype(float)
    second = ((x[:, 1] > 0) & (first > 0)).astype(float)
    n = len(x)
    examples = toxicity.Examples(np.zeros(n + 1, dtype=int), np.zeros(0, dtype=int), x, np.stack([first, second], axis=1), np.arange(n) % 5)
    chain, threshold = toxicity.fit_chain(examples, 0)
    assert [len(w) for w in chain] == [3, 4]
    p = toxicity.run_chain(chain, np.zeros(n + 1, dtype=int), np.zeros(0, dtype=int), x)
    assert ((p[:, 0] > 0.5) == first).mean() > 0.97 and ((p[:, 1] > threshold) == second).mean() > 0.9


def test_training_is_bounded(corpus, spark):
    _, labels = corpus
    assert quality.sampled(labels, "doc_id", ["quality"], 30).count() == 30


def test_newton_and_gradient_agree():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((500, 3))
    y = (x @ [1.0, -2.0, 0.5] + 0.3 + rng.logistic(size=500) > 0).astype(float)
    newton = linear.fit(x, y, penalty=0.01)
    gradient = linear.fit_sparse(np.zeros(501, dtype=int), np.zeros(0, dtype=int), x, y, 0, steps=2000)
    assert newton == pytest.approx(gradient, abs=0.05)
    assert linear.fit(x, np.ones(500))[:-1].tolist() == [0, 0, 0]


@pytest.mark.parametrize("text", [None, "", " \n", "a", "A!! B!!", "x x x x", "1 2 3", "line\nline\n\n"])
def test_shapes_are_finite(text):
    assert np.isfinite(features.shape(text)).all()


def test_word_beginnings():
    def count(text):
        return sum(map(len, features.buckets_of(text, 3, 6, 1 << 20)))

    # "ab" as a whole; abc as beginning and whole; abcdefgh: 3, 4, 5 and 6 letters.
    assert [count(t) for t in ("ab", "abc", "abcdefgh", "", "%%")] == [1, 2, 4, 0, 0]
    assert count("abc abc") == 4
