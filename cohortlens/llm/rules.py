"""Quality rules: a threshold table compiled into one projection of built-in functions.

``measured`` computes what the rules look at, ``verdict`` turns the threshold table into a single
boolean column. No user function, no shuffle: every row is decided on its own.

Defined results: a null text has no words and fails the base rule, as does an empty one; repeated
rows are decided alike; a ratio over nothing counts as 0. Further columns, also ones that carry the
names used here, are not read; ``keep`` returns them unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import GAP, WHITE_SPACE, WORD

# The symbols that the contract counts.
SYMBOLS = "#*$%&|<>"

# Frequent function words of the four languages of the corpus; prose has plenty, lists and junk few.
STOP_WORDS = (
    *("the", "of", "and", "to", "in", "is", "that", "for", "it", "was", "on", "are", "as", "with", "be"),
    *("der", "die", "und", "den", "von", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht", "ein"),
    *("de", "la", "le", "et", "les", "des", "est", "un", "une", "du", "dans", "qui", "que", "pour", "pas"),
    *("el", "en", "y", "los", "se", "del", "las", "por", "con", "no", "su", "para", "al", "lo", "como"),
)


@dataclass(frozen=True)
class Rule:
    """``low <= numerator / denominator <= high``; an absent bound is not checked."""

    name: str
    numerator: str
    denominator: str
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        ratio = F.col(self.numerator) / F.greatest(F.col(self.denominator), F.lit(1))
        bounds = [F.lit(True)]
        if self.low is not None:
            bounds.append(ratio >= self.low)
        if self.high is not None:
            bounds.append(ratio <= self.high)
        result = bounds[0]
        for bound in bounds[1:]:
            result = result & bound
        return result


# The threshold table. Lengths in code points, ratios per word or per line.
THRESHOLDS = (
    Rule("mean word length", "word_chars", "n_words", low=2.0, high=14.0),
    Rule("symbols per word", "n_symbols", "n_words", high=0.3),
    Rule("exclamation marks per word", "n_exclaims", "n_words", high=0.5),
    Rule("stop words per word", "n_stop_words", "n_words", low=0.02),
    Rule("repeated lines per line", "n_dup_lines", "n_lines", high=0.5),
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(rows: DataFrame, text: Column, *, carry: str = "*") -> DataFrame:
    """``carry`` of ``rows`` as a struct, ``_row``, and the measures of ``text`` as another, ``_m``."""
    carried = rows.select(F.struct(carry).alias("_row"), F.coalesce(text, F.lit("")).alias("_text"))
    split = carried.select(
        "_row",
        "_text",
        F.array_remove(F.split("_text", GAP), "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD)).alias("_lines"),
        F.array_remove(F.split(F.lower(F.translate("_text", ".,;:", "")), GAP), "").alias("_plain"),
    )
    n = F.size("_words")
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
            lambda i: F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = split.withColumn("_windows", windows)
    # Only a text with a repeated window pays for the sort that finds its places.
    any_twice = F.size(F.array_distinct("_windows")) < F.size("_windows")
    ordered = hashed.withColumn(
        "_sorted",
        F.when(any_twice, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    placed = ordered.withColumn(
        "_places",
        F.transform(
            F.filter(
                "_sorted",
                lambda x, k: F.coalesce(x["h"] == F.get("_sorted", k - 1)["h"], F.lit(False))
                | F.coalesce(x["h"] == F.get("_sorted", k + 1)["h"], F.lit(False)),
            ),
            lambda x: x["i"],
        ),
    )
    covered = F.size(
        F.array_union(
            F.array_union("_places", F.transform("_places", lambda p: p + 1)),
            F.transform("_places", lambda p: p + 2),
        )
    )

    def without(characters: str) -> Column:
        return F.length(F.translate("_text", characters, ""))

    values = {
        "n_words": F.size("_words"),
        "word_chars": without(WHITE_SPACE),
        "n_symbols": F.length("_text") - without(SYMBOLS),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.coalesce(F.when(F.col("_places").isNotNull(), covered), F.lit(0)),
        "n_exclaims": F.length("_text") - without("!"),
        "n_lines": F.size("_lines"),
        "n_stop_words": F.size(F.filter("_plain", lambda w: w.isin(*sorted(set(STOP_WORDS))))),
    }
    measures = F.struct(*[v.cast("long").alias(k) for k, v in values.items()])
    # A generator is a barrier: a predicate on a measure would else be pushed below the projections above and
    # repeat them, lambdas included, for every mention of a measure.
    return placed.select("_row", F.explode(F.array(measures)).alias("_m"))


def base_failed() -> Column:
    """The rule that the contract fixes, over the measures as columns."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def verdict(table: tuple[Rule, ...] = THRESHOLDS) -> Column:
    """All rules of the table at once."""
    result = F.lit(True)
    for rule in table:
        result = result & rule.holds()
    return result


def rules_report(
    docs: DataFrame, table: tuple[Rule, ...] = THRESHOLDS, *, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: its key, the measures of the contract, ``base_failed`` and ``kept``."""
    rows = measured(docs.select(key, text), F.col(text), carry=key)
    flat = rows.select(F.col("_row")[key].alias(key), "_m.*")
    return flat.select(
        key,
        *MEASURES,
        base_failed().alias("base_failed"),
        (~base_failed() & verdict(table)).alias("kept"),
    )


def keep(docs: DataFrame, table: tuple[Rule, ...] = THRESHOLDS, *, text: str = "text") -> DataFrame:
    """The documents that pass, with the columns they came with."""
    rows = measured(docs, F.col(text)).select("_row", "_m.*")
    passes = ~base_failed() & verdict(table)
    return rows.filter(passes).select("_row.*")
