import collections
import itertools
import re

import numpy as np
import pytest
from cohortlens.llm import audit
from compare import compare, engine
from llm_samples import DOCS, document, prose
from pyspark.sql import functions as F

import __spark_entry__ as contract

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["part", "filter_order", "step", *audit.MEASURES]


def fails(text):
    """A to D of one text."""
    text = text or ""
    words = WORD.findall(text)
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        "D": re.search(r"[#$%&*|]", text) is not None,
    }


def brute(docs, labels):
    """The audit by walking every document through every order; ``docs`` are (id, text, part)."""
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    bad = {i for i, _, t in labels if t == 1 and i is not None}
    result = {}
    for part in {p or "" for _, _, p in docs}:
        count = collections.Counter()
        for i, text, p in docs:
            if (p or "") != part:
                continue
            failed = {f for f, x in fails(text).items() if x}
            if i is not None and i > least[text or ""]:
                failed.add("E")
            for order in itertools.permutations("ABCDE"):
                name = "".join(order)
                first = next((f for f in order if f in failed), None)
                for step, f in enumerate(order, 1):
                    seen = order[: step - 1]
                    count[name, step, "kept"] += not failed & set(order[:step])
                    count[name, step, "removed"] += f == first
                    count[name, step, "redundant"] += f in failed and bool(failed & set(seen))
                    count[name, step, "unique_fails"] += failed == {f}
                    count[name, step, "good_lost"] += f == first and i in good
                    count[name, step, "toxic_lost"] += f == first and i in bad
                if first:
                    count[first, "shapley"] += 1
        for order in itertools.permutations("ABCDE"):
            name = "".join(order)
            for step, f in enumerate(order, 1):
                values = [count[name, step, m] for m in audit.MEASURES[:-1]] + [count[f, "shapley"]]
                result[part, name, step] = tuple(values)
    return result


def rows_of(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.collect()]


def found(docs, labels):
    rows = [tuple(r) for r in audit.audit(docs, labels).select(*COLUMNS).collect()]
    result = {r[:3]: r[3:] for r in rows}
    assert len(result) == len(rows)
    return result


def test_odd_rows_agree_with_brute_force(odd_docs, odd_labels):
    expected = brute(rows_of(odd_docs), [tuple(r) for r in odd_labels.collect()])
    assert found(odd_docs, odd_labels) == expected
    assert {part for part, _, _ in expected} == {"", "a", "b"}


def test_hot_text_and_hot_key(spark):
    """One text and one key hold a third of all rows each; copies lie in all parts."""
    wide = " ".join(f"w{i}" for i in range(250))
    texts = [wide, wide + " $", wide.upper(), prose(1, 250), prose(2, 20), "", None, "A b", prose(3, 220) + " #"]
    rows = [document(i, wide, source=f"s{i % 5}") for i in range(100)]
    rows += [document(7, texts[i % len(texts)], source=None if i % 3 else f"s{i % 4}") for i in range(100)]
    rows += [document(200 + i, texts[i % len(texts)], source=f"s{i % 3}") for i in range(60)]
    rows += [document(None, wide, source="s1"), document(None, wide, source="s1")]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(250)] + [(7, 1, 0), (7, 0, 1), (None, 1, 1), (999, 1, 1)]
    docs = spark.createDataFrame(rows, DOCS).repartition(7)
    judged = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert found(docs, judged) == brute(rows_of(docs), labels)


@pytest.mark.parametrize(
    "text",
    ["", " \n\t", "a " * 399 + "a", " ".join(f"w{i % 100}" for i in range(200)), " ".join(f"w{i % 99}" for i in range(200))]
    + ["A" + "b" * 49, "A" + "b" * 48, "é" * 49 + "A", "É" * 10, "x|y", "x\\y^", "a b c", "\x1c\x85 a A", "Aa aA AA aa"],
)
def test_failures_at_the_bounds(spark, text):
    row = audit.failures(spark.createDataFrame([(1, text, "a")], "doc_id long, text string, source string")).first()
    assert {f: row[f] for f in "ABCD"} == fails(text)


def test_failures_can_be_filtered(odd_docs):
    report = audit.failures(odd_docs)
    expected = sum(r.A and not r.B for r in report.collect())
    assert report.filter("A and not B").count() == expected > 0


def test_contraction_adds_up_what_it_selects():
    tensors = np.random.default_rng(1).integers(0, 9, (3, 2, 2, 2, 2, 2, 2))
    got = audit.contracted(tensors)
    assert got.shape == (3, 2, 3, 3, 3, 3, 3)
    assert (got[:, :, 0, 1, 2, 2, 0] == tensors[:, :, 0, 1, :, :, 0].sum(axis=(2, 3))).all()
    assert (got[:, :, 2, 2, 2, 2, 2] == tensors.sum(axis=(2, 3, 4, 5, 6))).all()


def test_counts_balance(odd_docs, odd_labels):
    rows = audit.audit(odd_docs, odd_labels).toPandas()
    by_order = rows.sort_values("step").groupby(["part", "filter_order"])
    totals = {p: sum((r.source or "") == p for r in odd_docs.collect()) for p in ("", "a", "b")}
    for (part, _), steps in by_order:
        assert len(steps) == 5 and steps["removed"].sum() + steps["kept"].iloc[-1] == totals[part]
        assert steps["shapley"].sum() == 120 * steps["removed"].sum()


def test_many_parts_in_one_batch(spark):
    docs = spark.createDataFrame([document(i, "$" * (i % 2), source=f"p{i}") for i in range(600)], DOCS).coalesce(1)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = audit.audit(docs, labels)
    assert rows.count() == 600 * 600 and rows.filter("good_lost + toxic_lost > 0").isEmpty()
    assert rows.filter("filter_order = 'DABCE' and step = 1").agg(F.sum("removed")).first()[0] == 300


def test_empty_tables(no_docs, odd_docs, odd_labels):
    assert audit.audit(no_docs, odd_labels).isEmpty()
    assert found(odd_docs, odd_labels.limit(0)) == brute(rows_of(odd_docs), [])


def test_query_agrees_with_its_twin(spark, sf_dir):
    connection = engine(sf_dir)
    assert compare(spark, connection, "op11_filter_audit", sf_dir) == ""
    connection.close()
    rows = contract.queries()["op11_filter_audit"](spark, sf_dir)
    assert rows.count() == 20 * 600
