import collections
import math

import numpy as np
import pytest
from cohortlens.llm import lm
from llm_samples import crc, prose


def words_of(text):
    return lm.lowered(text).split()


@pytest.mark.parametrize("frequent", [300_000, 10, 0])
def test_base_agrees_with_brute_force(odd_docs, frequent):
    rows = lm.score(odd_docs, frequent=frequent).collect()
    docs = odd_docs.collect()
    counts = collections.Counter()
    for r in docs:
        if crc("" if r.doc_id is None else r.doc_id) % 10:
            counts.update([*words_of(r.text), b""])
    total, kinds = sum(counts.values()), len(counts)
    expected = collections.defaultdict(list)
    for r in docs:
        tokens = [*words_of(r.text), b""]
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in tokens)
        expected[r.doc_id, len(tokens), sum(counts[t] > 0 for t in tokens)].append(base)
    for r in rows:
        left = expected[r.doc_id, r.n_tokens, r.n_known]
        assert any(abs(r.base_score - b) <= 1e-9 * max(1, abs(b)) for b in left)
        assert r.train_tokens == total and r.held_out == (crc("" if r.doc_id is None else r.doc_id) % 10 == 0)
        assert r.score < 0
    assert len(rows) == len(docs)


def test_scores_do_not_depend_on_how_rows_lie(odd_docs):
    def scores(docs):
        return sorted(((r.doc_id or -1, r.n_tokens), round(r.score, 3)) for r in lm.score(docs).collect())

    assert [s[0] for s in scores(odd_docs)] == [s[0] for s in scores(odd_docs.repartition(5))]
    for (_, a), (_, b) in zip(scores(odd_docs), scores(odd_docs.repartition(5)), strict=True):
        assert a == pytest.approx(b, rel=1e-3)


def test_model_prefers_what_it_learned(spark):
    rows = [(i, prose(i, 120)) for i in range(80)]
    held = [i for i in range(200, 400) if crc(i) % 10 == 0][:6]
    rows += [(held[0], prose(900, 120)), (held[1], prose(900, 120)[::-1]), (held[2], "qzxv kjwq " * 60)]
    found = {r.doc_id: r for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    natural, backward, noise = (found[i] for i in held[:3])
    assert natural.score > backward.score > noise.score
    bits = -natural.score / math.log10(2) / len(prose(900, 120))
    assert bits < 2.5


def test_bits_per_byte_follow_from_the_score(odd_docs):
    left = collections.Counter((r.doc_id, len(lm.lowered(r.text)) + 1) for r in odd_docs.collect())
    for r in lm.score(odd_docs).collect():
        size = round(-r.score / math.log10(2) / r.bits_per_byte)
        assert left[r.doc_id, size] > 0
        left[r.doc_id, size] -= 1
    assert not +left


def test_probabilities_of_all_bytes_add_up_to_one():
    rng = np.random.default_rng(0)
    zeros = rng.integers(0, 50, lm.TABLE_START[-1]).astype(np.float32)
    ones = rng.integers(0, 50, lm.TABLE_START[-1]).astype(np.float32)
    observed = rng.integers(1, 50, (2, 256 * lm.CELLS)).astype(float)
    observed[1] += observed[0]
    model = lm.frozen(zeros, ones, lm.initial_weights(), lm.refined_map(observed))
    context = int.from_bytes(b"hello", "big") << 8
    grams = np.array([context | b for b in range(256)], dtype=np.uint64)
    assert np.exp(lm.costs(grams, model)).sum() == pytest.approx(1.0, abs=1e-4)


def test_blocks_hold_every_gram_of_every_text(monkeypatch):
    monkeypatch.setattr(lm, "BLOCK", 16)
    texts = [b"", b"a", b"abcdefghij", b"x" * 50, b"hello world"]
    found = collections.defaultdict(list)
    for grams, owner, start in lm.blocks(enumerate(texts)):
        for o, part in zip(owner, np.split(grams, start[1:]), strict=True):
            found[int(o)] += part.tolist()
    for i, text in enumerate(texts):
        data = bytes(lm.GRAM - 1) + text + b"\0"
        assert found[i] == [int.from_bytes(data[k : k + lm.GRAM], "big") for k in range(len(text) + 1)]


def test_memo_returns_what_the_model_does():
    rng = np.random.default_rng(1)
    zeros = rng.integers(0, 9, lm.TABLE_START[-1]).astype(np.float32)
    model = lm.frozen(zeros, zeros[::-1].copy(), lm.initial_weights(), lm.refined_map(np.zeros((2, 256 * lm.CELLS))))
    memo = lm.Memo(model)
    grams = rng.integers(0, 1 << 47, 3000, dtype=np.uint64)
    for _ in range(2):
        assert memo(grams) == pytest.approx(lm.costs(grams, model), rel=1e-5)


def test_frequent_words_are_bounded(spark):
    table = spark.createDataFrame([(bytes([97 + i]), 10 - i // 3) for i in range(12)], "word binary, n long")
    assert len(lm.frequent_words(table, 12)) == 12
    assert set(lm.frequent_words(table, 7)) == {bytes([97 + i]) for i in range(6)}
    assert lm.frequent_words(table, 2) == {} and lm.frequent_words(table.limit(0), 5) == {}


def test_empty_table_and_nothing_to_learn(no_docs, spark):
    assert lm.score(no_docs).isEmpty()
    held = next(i for i in range(100) if crc(i) % 10 == 0)
    row = lm.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0) and row.score < 0
    assert row.base_score == pytest.approx(3 * math.log10(0.1 / 0.1))


def counters_by_hand(counts, gram, order, bit):
    """Zeros and ones that follow the same ``order`` bytes and the same bits of the last byte."""
    found = [0, 0]
    for other, n in counts.items():
        same = (other >> 8) % (1 << 8 * order) == (gram >> 8) % (1 << 8 * order) and (other & 255) >> (8 - bit) == (gram & 255) >> (8 - bit)
        found[(other >> (7 - bit)) & 1] += n * same
    return found


def test_no_two_contexts_share_a_counter():
    """More contexts than the largest fixed table had places: each one's counter holds its own grams only."""
    rng = np.random.default_rng(4)
    grams = np.unique(rng.integers(0, 1 << 48, 600_000, dtype=np.uint64))
    n = np.arange(len(grams)) % 5
    ends, at = np.unique(grams.astype(np.int64) & 0xFFFFFF, return_inverse=True)
    shard = lm.Shard(grams, n, lm.Short(ends, np.bincount(at, n)))
    nodes = len(np.unique(shard.slots[5]))
    assert nodes > 1 << lm.TABLE_BITS[5]
    # Random contexts of five bytes are nearly all met once, by one gram.
    assert (shard.zeros + shard.ones)[shard.slots[5][:, 0]].mean() == pytest.approx(n.mean(), rel=0.01)


def test_counters_agree_with_brute_force():
    rng = np.random.default_rng(5)
    grams = np.unique([int.from_bytes(bytes(rng.choice(list(b"ab c\xc3"), 6).tolist()), "big") for _ in range(150)]).astype(np.uint64)
    n = rng.integers(0, 6, len(grams))
    ends, at = np.unique(grams.astype(np.int64) & 0xFFFFFF, return_inverse=True)
    shard = lm.Shard(grams, n, lm.Short(ends, np.bincount(at, n)))
    counts = dict(zip(grams.tolist(), n.tolist(), strict=True))
    for i in range(0, len(grams), 7):
        for order in range(lm.ORDERS):
            for bit in range(8):
                slot = shard.slots[order][i, bit]
                assert [shard.zeros[slot], shard.ones[slot]] == counters_by_hand(counts, int(grams[i]), order, bit)


@pytest.mark.parametrize("frequent_grams", [50, 0])
def test_grams_that_are_not_broadcast_are_joined(odd_docs, frequent_grams):
    def scores(**more):
        return sorted((r.doc_id or -1, r.n_tokens, round(r.score, 2)) for r in lm.score(odd_docs, **more).collect())

    for a, b in zip(scores(), scores(frequent_grams=frequent_grams), strict=True):
        assert a == pytest.approx(b, rel=1e-3)


def test_weights_do_not_depend_on_the_size_of_arrow_batches(spark):
    docs = spark.createDataFrame([(i, prose(i, 60)) for i in range(30)], "doc_id long, text string").repartition(2)

    def scores():
        return sorted((r.doc_id, r.score) for r in lm.score(docs).collect())

    usual, name = scores(), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, 100)
    try:
        small = scores()
    finally:
        spark.conf.set(name, before)
    for (_, a), (_, b) in zip(usual, small, strict=True):
        assert a == pytest.approx(b, rel=1e-5)
