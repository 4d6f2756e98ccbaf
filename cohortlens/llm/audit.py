"""Filter interaction audit: what each of five filters removes in every order, from one table of counts.

A document fails or passes each filter whatever the others do, so that all 120 orders follow from the number of
documents per part and pattern of failures: a contingency tensor of shape 2x2x2x2x2 per part, once for all documents,
once for the good and once for the toxic ones. ``contracted`` adds "all" as a third choice to every axis with one
``einsum``; what a step removes is then the entry with "pass" along the filters before it, "fail" along its own and
"all" along those after it.

How it scales. One scan of the texts measures them natively and leaves a row of some 60 bytes each: key, part, digest
of the text, bits of the filters that look at one text. Equal rows are counted before anything is joined. Copies are told by SHA-256:
the smallest key of each text is found by an aggregate combined on the map side and joined back on (digest, key), so that
a text that a third of all documents share is not one group of a join. Tensors, 32 counts a part, are built by two
aggregates combined on the map side; numpy contracts them in batches of parts. Nothing goes to the driver.

Defined results: a null text is an empty one: it fails A and passes B, C, D, and E unless a smaller key has an empty text, too. Rows of one key and
text are not copies of one another (no key is smaller); rows without key are compared with none and pass E. A null
part is the empty string. A document is good (toxic) if any row of ``labels`` with its key says so; repeated labels
count once, those without key not at all. Repeated documents count as often as they come. An empty table has no
part and gives no rows. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Workspace
from .text import words_of

FILTERS = "ABCDE"
# Choices along an axis of the tensor: rows of (passing, failing) counts to add up.
PASS, FAIL, ALL = 0, 1, 2
CHOICES = np.array([[1, 0], [0, 1], [1, 1]])
# What is counted, each in a tensor of its own.
COUNTS = ("n", "good", "toxic")
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
PARTS_PER_BATCH = 256


def failures(docs: DataFrame, *, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Per document ``key``, ``part``, the text's ``digest`` and booleans ``A`` to ``D``: fails that filter."""
    carried = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    split = carried.select("*", words_of(F.col("text")).alias("words"))
    n_words, n_distinct = F.size("words"), F.size(F.array_distinct("words"))
    fails = F.struct(
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
        (n_words < 200).alias("A"),
        (100 * n_distinct < 50 * n_words).alias("B"),
        (100 * F.regexp_count("text", F.lit("[A-Z]")) > 2 * F.length("text")).alias("C"),
        F.col("text").rlike(r"[#$%&*|]").alias("D"),
    )
    # A generator is a barrier: predicates on a filter would else repeat the split for each mention.
    return split.select("key", "part", F.explode(F.array(fails)).alias("_f")).select("key", "part", "_f.*")


def pattern(fails: list[Column]) -> Column:
    """Place in the flattened tensor, the first filter being the slowest axis."""
    places = [F.when(f, F.lit(1 << (len(fails) - 1 - i))).otherwise(F.lit(0)) for i, f in enumerate(fails)]
    return sum(places[1:], places[0])


def counted(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    part: str = "source",
    workspace: Workspace | None = None,
) -> DataFrame:
    """Per ``part`` and ``pattern`` of failures that occurs: documents ``n``, of these ``good`` and ``toxic``."""
    workspace = workspace or Workspace(docs.sparkSession)

    def says(column: str) -> Column:
        return F.coalesce(F.max(F.col(column) == 1), F.lit(False))

    judged = (
        labels.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(says("quality").alias("is_good"), says("toxic").alias("is_toxic"))
    )
    rows = failures(docs, key=key, text=text, part=part).groupBy("key", "part", "digest", *FILTERS[:4])
    labelled = workspace.write(rows.agg(F.count("*").alias("rows")).join(judged, "key", "left"), "labelled")
    firsts = labelled.filter(F.col("key").isNotNull()).groupBy("digest").agg(F.min("key").alias("key"))
    marked = labelled.join(firsts.withColumn("is_first", F.lit(True)), ["digest", "key"], "left")
    is_copy = F.col("key").isNotNull() & F.col("is_first").isNull()

    def total(condition: str) -> Column:
        return F.sum(F.when(F.col(condition), F.col("rows")).otherwise(0))

    fails = [F.col(f) for f in FILTERS[:4]] + [is_copy]
    return marked.groupBy("part", pattern(fails).alias("pattern")).agg(
        F.sum("rows").alias("n"), total("is_good").alias("good"), total("is_toxic").alias("toxic")
    )


def contracted(tensors: np.ndarray) -> np.ndarray:
    """Counts for every choice of pass, fail or all along each filter: (part, count, 2, ...) to (part, count, 3, ...)."""
    return np.einsum("pkabcde,va,wb,xc,yd,ze->pkvwxyz", tensors, *[CHOICES] * 5, optimize=True)


def steps() -> pd.DataFrame:
    """All orders and their steps, with each step's filter and the choices that select what it looks at.

    Choices are places in the flattened contraction: ``removed``, ``kept``, ``failing`` and ``only``.
    """
    rows = []
    for order in permutations(range(len(FILTERS))):
        for i, own in enumerate(order):
            before = order[:i]

            def place(own_choice: int, earlier: int, later: int) -> int:
                choice = [earlier if axis in before else later for axis in range(len(FILTERS))]  # noqa: B023
                choice[own] = own_choice  # noqa: B023
                return int(np.ravel_multi_index(choice, (3,) * len(FILTERS)))

            rows.append(
                {
                    "filter_order": "".join(FILTERS[j] for j in order),
                    "step": i + 1,
                    "own": own,
                    "kept": place(PASS, PASS, ALL),
                    "removed": place(FAIL, PASS, ALL),
                    "failing": place(FAIL, ALL, ALL),
                    "only": place(FAIL, PASS, PASS),
                }
            )
    return pd.DataFrame(rows)


def measures(tensors: np.ndarray, plan: pd.DataFrame) -> dict[str, np.ndarray]:
    """The audit's counts, each of shape (part, step of the plan)."""
    flat = contracted(tensors).reshape(len(tensors), len(COUNTS), -1)
    removed = flat[:, 0, plan["removed"]]
    own = plan["own"].to_numpy()
    per_filter = np.stack([removed[:, own == f].sum(axis=1) for f in range(len(FILTERS))], axis=1)
    return {
        "kept": flat[:, 0, plan["kept"]],
        "removed": removed,
        "redundant": flat[:, 0, plan["failing"]] - removed,
        "unique_fails": flat[:, 0, plan["only"]],
        "good_lost": flat[:, 1, plan["removed"]],
        "toxic_lost": flat[:, 2, plan["removed"]],
        "shapley": per_filter[:, own],
    }


def _audit_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    plan = steps()
    for batch in batches:
        for start in range(0, len(batch), PARTS_PER_BATCH):
            parts = batch.iloc[start : start + PARTS_PER_BATCH]
            tensors = np.zeros((len(parts), len(COUNTS), 2 ** len(FILTERS)), dtype=np.int64)
            for i, cells in enumerate(parts["cells"]):
                for cell in cells:
                    tensors[i, :, cell["pattern"]] = [cell[c] for c in COUNTS]
            found = measures(tensors.reshape(len(parts), len(COUNTS), *[2] * len(FILTERS)), plan)
            yield pd.DataFrame(
                {
                    "part": np.repeat(parts["part"].to_numpy(dtype=object), len(plan)),
                    "filter_order": np.tile(plan["filter_order"].to_numpy(dtype=object), len(parts)),
                    "step": np.tile(plan["step"].to_numpy(dtype=np.int32), len(parts)),
                    **{m: found[m].ravel() for m in MEASURES},
                }
            )


def audit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    part: str = "source",
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row per part, order and step of the filters, zeros included."""
    cells = counted(docs, labels, key=key, text=text, part=part, workspace=workspace)
    # At most one cell per pattern, 32 a part.
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("pattern", *COUNTS)).alias("cells"))
    schema = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES)
    return parts.mapInPandas(_audit_parts, schema)
