"""Toxicity by a classifier chain.

The chain predicts label columns one after the other; every link is a logistic regression over the text's features
and the probabilities of all earlier links. In training, a later link sees earlier probabilities as they were
predicted out of fold, by models that had not seen the document, so that it learns how far to trust them.

Features are the presence of words' beginnings (3 to 6 letters; shorter words as a whole) and the shape of
the text. Of all hashed beginnings those enter that tell a category's rows from the others best (likelihood ratio of
their document counts). Presence rather than frequency: one insult in a long text counts as it does in a short one.

How it scales. The chain is fitted on ``TRAINING_ROWS`` labelled documents at most, those whose ids hash lowest;
their word beginnings are counted in tasks, their selected features, a bounded table, come to the driver. Scoring reads whole
texts once in tasks, with the weights broadcast (a table of ``BUCKETS`` entries); nothing is shuffled.

Defined results: a text without letters is judged by its shape; without labels of both kinds a link predicts their smoothed
rate. Rows with a null label in any category are not used in training. Rows are decided on their own, repeated ones alike.
An empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Workspace
from . import linear
from .features import SHAPE, buckets_of, shape
from .quality import sampled
from .text import objects

TRAINING_ROWS = 20_000
FOLDS = 5
ROWS_PER_TASK = 2500
LOW, HIGH = 3, 6
BUCKETS = 1 << 20
SELECTED = 1024
THRESHOLDS = (0.2, 0.5)


@dataclass
class Examples:
    """Training rows: selected binary features in compressed rows, shapes, labels, folds."""

    indptr: np.ndarray
    indices: np.ndarray
    shapes: np.ndarray
    labels: np.ndarray
    fold: np.ndarray

    def rows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Compressed rows of the chosen examples."""
        sizes = np.diff(self.indptr)[chosen]
        indptr = np.r_[0, np.cumsum(sizes)]
        at = np.arange(indptr[-1]) - np.repeat(indptr[:-1], sizes) + np.repeat(self.indptr[:-1][chosen], sizes)
        return indptr, self.indices[at]


def predicted(indptr: np.ndarray, indices: np.ndarray, dense: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Probabilities of one link."""
    width = len(weights) - dense.shape[1] - 1
    owner = np.repeat(np.arange(len(dense)), np.diff(indptr))
    sums = np.bincount(owner, weights[indices], minlength=len(dense))
    return linear.sigmoid(sums + dense @ weights[width:-1] + weights[-1])


def fit_chain(examples: Examples, width: int, folds: int = FOLDS) -> tuple[list[np.ndarray], float]:
    """Weights of every link, in order, and the threshold of the last one.

    A link's dense features are the shape and earlier log-odds.
    """
    dense = examples.shapes
    everything = np.arange(len(dense))
    chain, threshold = [], 0.5
    for link in range(examples.labels.shape[1]):
        y = examples.labels[:, link]
        chain.append(linear.fit_sparse(*examples.rows(everything), dense, y, width))
        unseen = np.zeros(len(y))
        for fold in range(folds):
            inside, outside = everything[examples.fold == fold], everything[examples.fold != fold]
            weights = linear.fit_sparse(*examples.rows(outside), dense[outside], y[outside], width)
            unseen[inside] = predicted(*examples.rows(inside), dense[inside], weights)
        dense = np.hstack([dense, linear.logit(unseen)[:, None] / 4])
        threshold = best_threshold(unseen, y)
    return chain, threshold


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Where out-of-fold predictions give the best F1, halfway between the two next to the cut, within bounds."""
    if len(y) == 0 or y.min() == y.max():
        return 0.5
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    cut = int(np.argmax(2 * hits / (np.arange(1, len(y) + 1) + y.sum())))
    below = p[order[cut + 1]] if cut + 1 < len(y) else 0.0
    return float(np.clip((p[order[cut]] + below) / 2, *THRESHOLDS))


def run_chain(chain: list[np.ndarray], indptr: np.ndarray, indices: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """Probabilities of all links, each fed with those before it."""
    result = []
    for weights in chain:
        p = predicted(indptr, indices, dense, weights)
        result.append(p)
        dense = np.hstack([dense, linear.logit(p)[:, None] / 4])
    return np.stack(result, axis=1)


def document_counts(rows: DataFrame, categories: Sequence[str]) -> DataFrame:
    """``bucket``, ``n`` and per category the number of its documents that hold the bucket."""
    width = len(categories) + 1

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros((width, BUCKETS), dtype=np.int32)
        present = np.zeros(BUCKETS, dtype=bool)
        for batch in batches:
            for value, *labels in zip(batch["text"], *(batch[c] for c in categories), strict=True):
                for found in buckets_of(value, LOW, HIGH, BUCKETS):
                    present[found] = True
                held = np.flatnonzero(present)
                present[held] = False
                counts[0, held] += 1
                for i, label in enumerate(labels):
                    if label > 0:
                        counts[i + 1, held] += 1
        used = np.flatnonzero(counts[0])
        yield pd.DataFrame({"bucket": used} | {f"n{i}": counts[i, used] for i in range(width)})

    names = [f"n{i}" for i in range(width)]
    schema = "bucket long, " + ", ".join(f"{n} long" for n in names)
    return rows.mapInPandas(counted, schema).groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names])


def telling(counts: DataFrame, totals: Sequence[int], most: int) -> list[int]:
    """Per category the buckets that its rarer side holds more often, by likelihood ratio.

    What the frequent side shares is in most documents; it would fill the rows and tell little.
    """

    def part(seen, expected):
        return F.when((seen > 0) & (expected > 0), seen * F.log(seen / expected)).otherwise(0.0)

    chosen: dict[int, None] = {}
    for i, positive in enumerate(totals[1:], start=1):
        negative = totals[0] - positive
        if not positive or not negative:
            continue
        n = F.col("n0").cast("double")
        a = F.col(f"n{i}").cast("double") if positive <= negative else n - F.col(f"n{i}")
        rare, rest = min(positive, negative), max(positive, negative)
        b, c, d = n - a, rare - a, rest - (n - a)
        share = n / totals[0]
        ratio = part(a, share * rare) + part(b, share * rest) + part(c, (1 - share) * rare) + part(d, (1 - share) * rest)
        more = counts.filter(a > share * rare).select("bucket", ratio.alias("ratio"))
        best = more.orderBy(F.desc("ratio"), "bucket").limit(most)
        chosen.update(dict.fromkeys(r["bucket"] for r in best.collect()))
    return list(chosen)


def present_features(place: np.ndarray, text: str | None) -> np.ndarray:
    """Selected features that a text holds, given each bucket's place, or -1."""
    hits = [places[places >= 0] for found in buckets_of(text, LOW, HIGH, BUCKETS) for places in (place[found],)]
    return np.unique(np.concatenate(hits)) if hits else np.zeros(0, dtype=place.dtype)


def train(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    workspace: Workspace,
    *,
    key: str = "doc_id",
    text: str = "text",
    most: int = TRAINING_ROWS,
    selected: int = SELECTED,
    folds: int = FOLDS,
):
    """Scaling, bucket places and chain, as plain arrays, from at most ``most`` labelled documents."""
    names = [f"label{i}" for i in range(len(categories))]
    known = sampled(labels, key, list(categories), most).toDF("key", *names)
    joined = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(known), "key")
    # One text for each labelled id, so that the bound holds for what is trained on.
    rows = workspace.write(joined.groupBy("key", *names).agg(F.min("text").alias("text")), "training")
    rows = rows.repartition(max(1, most // ROWS_PER_TASK), "key")
    totals = rows.agg(F.count("*"), *[F.coalesce(F.sum((F.col(n) > 0).cast("int")), F.lit(0)) for n in names]).first()
    counts = workspace.write(document_counts(rows, names), "counts")
    buckets = telling(counts, totals, selected)
    place = np.full(BUCKETS, -1, dtype=np.int32)
    place[buckets] = np.arange(len(buckets))
    sent = docs.sparkSession.sparkContext.broadcast(place)

    @F.pandas_udf("features array<int>, shape array<double>")
    def described(texts: pd.Series) -> pd.DataFrame:
        features = [present_features(sent.value, t) for t in texts]
        return pd.DataFrame({"features": features, "shape": [shape(t) for t in texts]}, index=texts.index)

    ordered = rows.select("key", *names, described("text").alias("d")).select("key", *names, "d.*")
    found = ordered.toArrow().to_pandas().sort_values("key", kind="stable")
    features = [np.asarray(f, dtype=np.int64) for f in found["features"]]
    shapes = np.array(found["shape"].tolist(), dtype=float).reshape(-1, len(SHAPE))
    scale = linear.Standard(shapes)
    examples = Examples(
        np.r_[0, np.cumsum([len(f) for f in features], dtype=np.int64)],
        np.concatenate([np.zeros(0, dtype=np.int64), *features]),
        scale(shapes),
        (found[names].to_numpy() > 0).astype(float),
        np.arange(len(found)) % folds,
    )
    return scale.mean, scale.scale, place, fit_chain(examples, len(buckets), folds)


def detect(docs: DataFrame, model, categories: Sequence[str], *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``p_<category>`` for every category from the whole text, and ``is_<category>`` of the last one."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mean, deviation, place, (chain, _) = sent.value
        for batch in batches:
            features = [present_features(place, t) for t in batch["text"]]
            shapes = np.array([shape(t) for t in batch["text"]]).reshape(-1, len(SHAPE))
            indptr = np.r_[0, np.cumsum([len(f) for f in features], dtype=np.int64)]
            indices = np.concatenate([np.zeros(0, dtype=np.int64), *features]).astype(np.int64)
            p = run_chain(chain, indptr, indices, np.clip((shapes - mean) / deviation, -12, 12))
            yield objects(pd.DataFrame({"key": batch["key"]} | {f"p{i}": p[:, i] for i in range(p.shape[1])}))

    # Keys travel as text: a null among numbers would make pandas take them for floats.
    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    schema = "key string, " + ", ".join(f"p{i} double" for i in range(len(categories)))
    judged_rows = rows.mapInPandas(judged, schema).withColumn("key", F.col("key").cast(kind))
    found = judged_rows.toDF(key, *[f"p_{c}" for c in categories])
    last = categories[-1]
    return found.withColumn(f"is_{last}", F.col(f"p_{last}") >= model[3][1])


def toxic(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str] = ("quality", "toxic"),
    *,
    key: str = "doc_id",
    text: str = "text",
    workspace: Workspace | None = None,
    **options,
) -> DataFrame:
    """Per document: key, ``p_<category>`` in chain order, and ``is_<category>`` of the last link."""
    workspace = workspace or Workspace(docs.sparkSession)
    model = train(docs, labels, categories, workspace, key=key, text=text, **options)
    return detect(docs, model, categories, key=key, text=text)
