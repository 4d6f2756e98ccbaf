"""From raw documents to packed sequences: five stages, each one operator applied to all that is left.

Every stage but the last returns the columns it was given. ``run`` writes what a stage returns and
hands the next one the written table, so that no stage repeats the work of another.

Nulls, empty and very long texts, ties, repeated rows, empty tables and further columns are handled as the operators
say: a null or empty text is judged by its site in the first stage and fails the second one's base rule;
repeated rows are one group of the third.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import mixing, packing, quality, rules, simhash
from cohortlens.llm.queries import table, tokenizer_path
from cohortlens.session import Workspace

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents that it rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), host=F.col("source"), path=F.col("lang"))


def regular_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that break one go."""
    return rules.keep(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates: one document of each group stays."""
    return simhash.keep_first(docs)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: documents come as often as their source's target asks for, some not at all."""
    return mixing.mixed_rows(docs)


def packed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: one row per piece of a document, with its sequence and place."""
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_documents),
    ("quality rules", regular_documents),
    ("SimHash near-dedup", distinct_documents),
    ("mixing sources to target weights", mixed_documents),
    ("best-fit packing", packed_documents),
]

# The first stage fits a classifier and the last one a tokenizer's ids, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    workspace = Workspace(spark)
    docs = table(spark, sf_dir, "documents")
    *before, (_, last) = STAGES
    for number, (_, stage) in enumerate(before):
        docs = workspace.write(stage(spark, docs, sf_dir), f"stage-{number}")
    return last(spark, docs, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"pipeline": run}
