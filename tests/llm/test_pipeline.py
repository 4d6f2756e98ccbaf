import collections

import corpus_pipeline
import pytest
from cohortlens.llm import mixing, quality, rules, simhash
from cohortlens.llm.queries import QUERIES, TWINS
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What every stage returned, written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    results = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name.replace(" ", "-"))
        stage(spark, results[-1], sf_dir).write.parquet(path)
        results.append(spark.read.parquet(path))
    return results


def ids(df):
    return collections.Counter(r.doc_id for r in df.select("doc_id").collect())


def test_every_stage_does_what_its_operator_decides(stages, spark, sf_dir):
    docs, good, regular, distinct, mixed, packed = stages
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality.judged(docs, labels, host=F.col("source"), path=F.col("lang"))
    assert ids(good) == ids(judged.filter("kept"))
    assert ids(regular) == ids(rules.rules_report(good).filter("kept"))
    assert ids(distinct) == ids(simhash.near_duplicates(regular).filter("doc_id = component_id"))
    copies = {r.doc_id: r.copies for r in mixing.mix(distinct).collect() if r.copies}
    assert ids(mixed) == copies
    assert ids(packed.filter("piece = 0")) == copies
    assert all(df.schema.names == docs.schema.names for df in (good, regular, distinct, mixed))
    # Something happens in every stage, and clean documents stay.
    counts = [df.count() for df in stages[:4]]
    assert counts == sorted(counts, reverse=True) and counts[0] > counts[1] > counts[2] >= counts[3] > 0
    clean = labels.filter("quality = 1").join(docs, "doc_id")
    assert good.join(clean, "doc_id", "left_semi").count() >= 0.99 * clean.count()


def test_run_returns_the_last_stage(stages, spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, found.select(keys).collect())) == sorted(map(tuple, stages[-1].select(keys).collect()))


@pytest.mark.parametrize("number", range(5))
def test_stages_take_empty_and_odd_tables(spark, sf_dir, number, odd_docs, no_docs):
    name, stage = corpus_pipeline.STAGES[number]
    assert stage(spark, no_docs, sf_dir).isEmpty(), name
    result = stage(spark, odd_docs, sf_dir)
    assert number == 4 or result.columns == odd_docs.columns
    assert result.count() > 0


def test_all_thirteen_are_registered():
    assert [q.split("_")[0] for q in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(TWINS) <= set(QUERIES) and list(corpus_pipeline.QUERIES) == ["pipeline"]
