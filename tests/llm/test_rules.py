import collections
import re

import pytest
from cohortlens.llm import rules
from compare import compare, engine
from llm_samples import prose
from pyspark.sql import functions as F

import __spark_entry__ as contract

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    words = WORD.findall(text or "")
    windows = list(zip(words, words[1:], words[2:]))
    count = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_measures_agree_with_brute_force(odd_docs):
    found = rules.rules_report(odd_docs).collect()
    expected = collections.Counter()
    for row in odd_docs.collect():
        m = measures(row.text)
        expected[(row.doc_id, *m, m[0] < 50 or 100 * m[4] > 50 * m[0])] += 1
    assert collections.Counter(tuple(r)[:7] for r in found) == expected
    assert not any(r.kept and r.base_failed for r in found)


@pytest.mark.parametrize(
    "text", ["a b c a b c", "a a a a", "a b c d", "a b", "x\nx\n\nx \ny\ny", "# * $ % & | < >", "a b c a b c a b", ""]
)
def test_measures_of_small_texts(spark, text):
    row = rules.rules_report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert tuple(row)[1:6] == measures(text)


def test_keep_returns_the_rows_that_pass_unchanged(odd_docs):
    kept = rules.keep(odd_docs)
    assert kept.columns == odd_docs.columns
    passed = collections.Counter(r.doc_id for r in rules.rules_report(odd_docs).filter("kept").collect())
    assert collections.Counter(r.doc_id for r in kept.collect()) == passed
    assert kept.exceptAll(odd_docs).isEmpty()


@pytest.mark.parametrize("condition", ["kept", "n_words > 100 and n_repeat_words >= 0", "base_failed or n_symbols = 0"])
def test_the_report_can_be_filtered_and_joined(spark, condition):
    texts = [(1, prose(1, 30_000)), (2, prose(2, 300)), (3, "word " * 5_000), (4, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    report = rules.rules_report(docs)
    expected = {r.doc_id for r in spark.createDataFrame(report.collect(), report.schema).filter(condition).collect()}
    assert {r.doc_id for r in report.filter(condition).collect()} == expected
    assert {r.doc_id for r in docs.join(report.filter(condition), "doc_id").collect()} == expected


def test_prose_stays_and_junk_goes(spark):
    good = prose(1, 200)
    junk = {
        2: " ".join(w + "%%%" for w in good.split()),
        3: " | ".join("zxcv qwer uiop".split() * 40 + [str(i) for i in range(100)]),
        4: " ".join(w.upper() + "!!" for w in good.split()),
        5: "word " * 100,
    }
    docs = spark.createDataFrame([(1, good), *junk.items()], "doc_id long, text string")
    assert [r.doc_id for r in rules.keep(docs).collect()] == [1]


def test_empty_table_and_plan(no_docs, odd_docs):
    assert rules.rules_report(no_docs).isEmpty() and rules.keep(no_docs).isEmpty()
    plan = rules.rules_report(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("Exchange RoundRobin", "") and "Python" not in plan


def test_query_agrees_with_its_twin(spark, sf_dir):
    connection = engine(sf_dir)
    assert compare(spark, connection, "op7_quality_rules", sf_dir) == ""
    connection.close()


def test_thresholds_bound_ratios(spark):
    rule = rules.Rule("r", "n", "d", low=0.1, high=0.5)
    rows = spark.createDataFrame([(1, 0), (1, 2), (1, 3), (1, 20)], "n int, d int").select(F.expr("*"), rule.holds().alias("ok"))
    assert [r.ok for r in rows.collect()] == [False, True, True, False]
    assert contract.queries()["op7_quality_rules"]
