import collections
import hashlib
import random
import re

import numpy as np
import pytest
from cohortlens.llm import decontaminate as dc
from compare import compare, engine
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_samples import DOCS, document, prose

import __spark_entry__ as contract

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(dc.UPPER, dc.LOWER)
ITEMS = "item_id long, text string, doc_id string, window string, items string"


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, size=10):
    """Rows by trying every window at every word of every document."""
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[i : i + size])].add("" if item is None else str(item))
    result = []
    for doc, text in docs:
        w, hit, held = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i : i + n]))
                if found:
                    hit.update(range(i, i + n))
                    held |= found
        result.append((doc, len(w), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest(), bool(hit)))
    return collections.Counter(result)


def found(spark, docs, items, **options):
    table = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in items], ITEMS)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return collections.Counter(tuple(r) for r in dc.contaminated(docs, table, **options).select(*columns).collect())


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


VOCABULARY = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho".split()
# Whole items, overlapping ones, one below the size, one of one word, equal ones, odd characters, none.
ODD_ITEMS = [
    *[(i, prose(100 + i, 30, VOCABULARY)) for i in range(6)],
    (10, prose(100, 30, VOCABULARY)[40:]),
    (11, "Tiny Item, of five WORDS"),
    (12, "q"),
    (13, "éü ñandú straße"),
    (14, ""),
    (15, None),
    (16, " -- !! "),
    (None, prose(130, 12, VOCABULARY)),
    (2, prose(131, 15, VOCABULARY)),
    (17, prose(102, 30, VOCABULARY)),
    (18, "x" * 300),
]


def odd_texts():
    texts = ["", None, "q", "qq q' Q-q", "tiny item of five words tiny item of five words", "tiny item of five wordss"]
    texts += ["ÉÜ ÑANDÚ", "éü ñandú straße\néü  ÑandÚ", "x" * 300, "x" * 299, "x" * 301]
    for i in range(6):
        base = prose(100 + i, 30, VOCABULARY)
        cut = base.split()
        texts += [base, f"lead {base.upper()} tail", " ".join(cut[:9]), " ".join(cut[5:15]), "\n".join(cut[3:20]) + "s", f"a{base}"]
        texts.append(" . ".join([prose(i, 50, VOCABULARY), base, prose(i + 1, 50, VOCABULARY), base[:90], base]))
    texts.append(prose(7, 20_000, VOCABULARY) + " " + prose(103, 30, VOCABULARY))
    return texts


@pytest.mark.parametrize("options", [{}, {"set_bytes": 2000}, {"size": 3}])
def test_odd_rows_agree_with_brute_force(spark, odd_docs, options):
    texts = odd_texts()
    rows = [document(i, t) for i, t in enumerate(texts)] + [document(None, texts[14]), document(3, texts[12]), document(3, texts[12])]
    docs = spark.createDataFrame(rows, DOCS).repartition(3).unionAll(odd_docs)
    expected = brute(pairs(docs), ODD_ITEMS, options.get("size", 10))
    assert found(spark, docs, ODD_ITEMS, **options) == expected
    assert sum(expected.values()) == docs.count() and any(r[5] for r in expected)


def test_chunks_cut_between_texts(spark, monkeypatch):
    monkeypatch.setattr(dc, "CHUNK_BYTES", 100)
    monkeypatch.setattr(dc, "SEGMENTS", 3)
    docs = spark.createDataFrame([document(i, t) for i, t in enumerate(odd_texts())], DOCS).coalesce(1)
    assert found(spark, docs, ODD_ITEMS) == brute(pairs(docs), ODD_ITEMS)


def test_a_passage_that_a_third_of_all_documents_hold(spark):
    passage = prose(100, 30, VOCABULARY)
    rows = [document(i % 50, f"{prose(i, 20)} {passage}") for i in range(200)] + [document(7, passage)] * 200
    docs = spark.createDataFrame(rows + [document(i, prose(i, 40)) for i in range(200)], DOCS).repartition(5)
    items = [(i, passage) for i in range(60)] + ODD_ITEMS
    expected = brute(pairs(docs), items)
    assert found(spark, docs, items) == expected
    assert found(spark, docs, items, set_bytes=3000) == expected


def test_empty_tables(spark, no_docs, odd_docs):
    assert found(spark, no_docs, ODD_ITEMS) == collections.Counter()
    for items in ([], [(1, None), (2, "")]):
        assert found(spark, odd_docs, items) == brute(pairs(odd_docs), items)


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6))
def test_search_finds_every_occurrence(seed):
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdé"
    word = lambda most: "".join(rng.choice(letters) for _ in range(rng.randint(1, most)))
    patterns = sorted({" ".join(word(rng.choice([1, 3, 30])) for _ in range(rng.randint(1, 6))).encode() for _ in range(rng.randint(1, 40))})
    body = [word(4) for _ in range(rng.randint(0, 300))]
    for p in rng.sample(patterns, min(5, len(patterns))):
        body.insert(rng.randint(0, len(body)), p.decode())
    text = b"\n" + " ".join(body).encode() + b"\n"
    places, number = dc.occurrences(dc.compiled(patterns), text)
    expected = {
        (m.start() + 1, i)
        for i, p in enumerate(patterns)
        for m in re.finditer(rb"(?=[ \n]" + re.escape(p) + rb"[ \n])", text)
    }
    got = list(zip(places.tolist(), number.tolist(), strict=True))
    assert set(got) == expected and len(got) == len(expected)


def test_shifts_skip_most_places():
    patterns = [prose(i, 10, VOCABULARY).encode() for i in range(50)]
    tables = dc.compiled(patterns)
    read = sum((band["shifts"][np.arange(1 << band["bits"])] == 0).sum() for band in tables["bands"])
    assert 0 < read <= 50
    assert all(band["shifts"].max() == band["shortest"] - 7 for band in tables["bands"])


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 10)), min_size=1, max_size=20))
def test_covered_is_the_size_of_the_union(spans):
    first, n = np.array(spans).T
    assert dc.covered(first, n) == len({k for a, m in spans for k in range(a, a + m)})


def test_windows_are_merged_over_items(spark):
    items = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in ODD_ITEMS], ITEMS)
    rows = {r.window: r["items"] for r in dc.windows(items).collect()}
    assert rows["q"] == ["12"] and rows["tiny item of five words"] == ["11"]
    assert rows[" ".join(prose(102, 30, VOCABULARY).split()[:10])] == ["17", "2"]
    assert all(w.count(" ") <= 9 for w in rows)


def test_query_agrees_with_its_twin(spark, sf_dir):
    connection = engine(sf_dir)
    assert compare(spark, connection, "op12_wu_manber_decontamination", sf_dir) == ""
    connection.close()
    assert contract.queries()["op12_wu_manber_decontamination"](spark, sf_dir).filter("contaminated").count() > 0
