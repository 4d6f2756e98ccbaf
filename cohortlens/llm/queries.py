"""The contract's queries: thin wrappers that apply an operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from . import ann, audit, decontaminate, html_text, langid, lm, mixing, negatives, packing, quality, rules, simhash, toxicity
from .twins import TWINS

__all__ = ["QUERIES", "TWINS"]

# Name of the public tokenizer's file; its folder is asked of the package that brings it.
TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_prefix_forest_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op4_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.judged(docs, labels, host=F.col("source"), path=F.col("lang"))


def op5_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.rules_report(table(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_host_suffix_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_context_mixing_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_bond_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, label=changed)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_prefix_forest_search,
        op2_language_id,
        op3_simhash_near_dedup,
        op4_site_quality,
        op5_toxicity_chain,
        op6_pattern_packing,
        op7_quality_rules,
        op8_source_mixing,
        op9_host_suffix_text,
        op10_context_mixing_scores,
        op11_filter_audit,
        op12_wu_manber_decontamination,
        op13_bond_hard_negatives,
    )
}
