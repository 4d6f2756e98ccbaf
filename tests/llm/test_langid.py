import collections

import numpy as np
import pytest
from cohortlens.llm import langid
from llm_samples import crc, document, prose

WORDS = {
    "en": "the house of stone and a river with bread for the cat".split(),
    "de": "das haus aus stein und ein fluss mit brot über die katze für".split(),
    "fr": "la maison en pierre et une rivière avec du pain pour le chat".split(),
}


def corpus(n):
    return [document(i, prose(i, 20 + i % 40, WORDS[lang]), lang) for i in range(n) for lang in [sorted(WORDS)[i % 3]]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [r[:4] for r in corpus(150)] + [(900, None, "en", "a"), (901, "123 %%% !", "en", "a"), (902, "", None, None)]
    rows += [(903, prose(1, 30, WORDS["de"]), None, None), (None, prose(2, 30, WORDS["fr"]), "fr", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)


def test_held_out_documents_are_recognized(docs):
    rows = langid.identify(docs).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert collections.Counter(r.doc_id for r in rows) == collections.Counter(list(truth))
    for r in rows:
        assert r.held_out == (crc("" if r.doc_id is None else r.doc_id) % 3 == 1)
        assert 0 <= r.score <= 1
        if r.doc_id in (900, 901, 902):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    judged = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert judged and all(r.lang_pred == truth[r.doc_id] for r in judged)
    assert {r.lang_pred for r in rows if r.doc_id == 903} == {"de"}


def test_held_out_labels_are_not_learned(spark):
    rows = [r[:3] for r in corpus(60)]
    secret = [(i, t, "xx" if crc(i) % 3 == 1 else lang) for i, t, lang in rows]
    docs = spark.createDataFrame(secret, "doc_id long, text string, lang string")
    assert "xx" not in {r.lang_pred for r in langid.identify(docs).collect()}


def test_counts_are_those_of_every_text(docs):
    found = {(r.lang, r.bucket): r.n for r in langid.count_grams(docs.filter("lang is not null"), text="text", lang="lang").collect()}
    expected = collections.Counter()
    for r in docs.filter("lang is not null").collect():
        expected[r.lang, -1] += 1
        for part in langid.grams(langid.letters(r.text or "")):
            expected.update((r.lang, int(b)) for b in part)
    assert found == expected


def test_batches_score_as_single_texts_do():
    texts = [prose(i, 5 + 40 * i, WORDS["de"]) for i in range(6)] + ["", None, "é", "a b", "%%"]
    chance = np.random.default_rng(1).random((2, langid.BUCKETS)).astype(np.float32)
    sums, sizes = langid.score_texts(texts, chance)
    for i, text in enumerate(texts):
        parts = langid.grams(langid.letters(text or ""))
        assert sizes[i] == sum(map(len, parts))
        assert sums[i] == pytest.approx(sum(chance[:, p].astype(float).sum(axis=1) for p in parts) if parts else [0, 0])


@pytest.mark.parametrize("text,stream", [("", ""), ("!?", ""), ("Ab", " ab "), (" É-b\n", " é b "), ("a1b", " a b ")])
def test_streams(text, stream):
    assert "".join(map(chr, langid.letters(text))) == stream


def test_nothing_to_learn_from(no_docs, spark):
    assert langid.identify(no_docs).isEmpty()
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.identify(docs).collect()] == [("und", 0.0)]


@pytest.mark.parametrize("most", [1, 7, 50, 10_000])
def test_slices_end_between_words(most):
    texts = [prose(5, 400), "x" * 200, "", "a", "été,Ärger\n" * 40, "one " + "y" * 120 + " two", "12 34 " * 30]
    for text in texts:
        parts = list(langid.sliced(text, most))
        assert "".join(parts) == text and all(parts)
        whole = bytes(langid.letters(text).astype("<u4")).decode("utf-32-le").split()
        assert [w for p in parts for w in bytes(langid.letters(p).astype("<u4")).decode("utf-32-le").split()] == whole
        assert all(len(p) <= max(most, 200) for p in parts)


def test_words_across_the_cut_of_a_long_text_are_seen(monkeypatch):
    from cohortlens.llm import features

    text = prose(6, 3000) + " insult " + prose(7, 3000)
    expected = [np.sort(np.concatenate(features.buckets_of(text, 3, 6, 1 << 14))).tolist()]
    for most in (len(prose(6, 3000)) + 4, 1000):
        monkeypatch.setattr(langid, "SLICE", most)
        expected.append(np.sort(np.concatenate(features.buckets_of(text, 3, 6, 1 << 14))).tolist())
    assert expected[0] == expected[1] == expected[2]
