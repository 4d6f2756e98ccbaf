"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

Three steps. A document classifier, logistic regression over the shape of the whole text, gives every
document evidence: the log-odds it adds to the base rate of its training rows. Grouped aggregation of the
classifier's probabilities gives each path of a host, each host and the corpus a rate of good documents;
a path's rate is shrunk toward its host's and a host's toward the global one, the more the fewer
documents it has. The strengths of both priors are estimated from the spread of the rates by the
method of moments. The last step adds a document's evidence to the log-odds of its path's posterior, from which
the document's own share has been taken out.

How it scales. The classifier is fitted on ``TRAINING_ROWS`` labelled rows at most, those whose ids
hash lowest; everything else covers all documents. Texts are read once, in tasks; what is shuffled are a few numbers per
document. Sums per path are combined before their shuffle, so that a host with a third of all documents is
one more row per task; hosts and the global moments are sums over paths. Paths come back to their documents by a join
over small rows that may be split where a path is large.

Defined results: a text that is null or has no words has a shape of zeros and is judged by it and its site; a null host or
path is a site of its own; without labels the evidence is 0 for all, and everything is kept. Documents labelled more
than once count as often in training; null labels don't. Repeated rows are judged alike. An empty table gives no
rows. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Workspace
from . import linear
from .features import SHAPE, shape

TRAINING_ROWS = 20_000
THRESHOLD = 0.5

# Bounds of the priors' strengths, in documents.
WEAKEST, STRONGEST = 1.0, 1_000.0


def shapes(docs: DataFrame, key: str, text: str, *carried: Column) -> DataFrame:
    """``key``, the carried columns and ``shape``."""

    @F.pandas_udf("array<double>")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shape(t) for t in texts], index=texts.index)

    return docs.select(F.col(key).alias("key"), *carried, measured(F.col(text)).alias("shape"))


def sampled(labels: DataFrame, key: str, columns: list[str], most: int) -> DataFrame:
    """At most ``most`` labelled rows, those whose ids hash lowest; a bound on whatever is made of them."""
    known = labels.select(F.col(key).alias("key"), *columns)
    for column in (F.col("key"), *map(F.col, columns)):
        known = known.filter(column.isNotNull())
    return known.orderBy(F.xxhash64("key"), "key", *columns).limit(most)


def learn(shaped: DataFrame, labels: DataFrame, *, key: str, label: str, most: int) -> tuple[linear.Standard, np.ndarray]:
    """Scaling and weights of the document classifier."""
    rows = shaped.join(F.broadcast(sampled(labels, key, [label], most)), "key").select("key", "shape", label)
    # A labelled id may have several rows: those that stay are the same in every run.
    found = rows.orderBy(F.xxhash64("key"), "key", "shape", label).limit(most).toArrow().to_pandas()
    x = np.array(found["shape"].tolist(), dtype=float).reshape(-1, len(SHAPE))
    y = found[label].to_numpy(dtype=float)
    standard = linear.Standard(x)
    return standard, linear.fit(standard(x), y)


def evidence(scale: linear.Standard, weights: np.ndarray) -> Column:
    """Log-odds of the classifier as an expression over ``shape``."""
    terms = F.lit(float(weights[-1]))
    for i in range(len(SHAPE)):
        value = (F.get("shape", F.lit(i)) - float(scale.mean[i])) / float(scale.scale[i])
        terms = terms + F.greatest(F.least(value, F.lit(12.0)), F.lit(-12.0)) * float(weights[i])
    return F.greatest(F.least(terms, F.lit(30.0)), F.lit(-30.0))


def strength(groups: DataFrame, rate: Column, prior: Column) -> float:
    """Number of documents the prior is worth, by the method of moments over groups of ``n`` documents.

    Around its prior ``m`` a rate over ``n`` documents varies by ``m (1 - m) (1 / n + spread)``.
    """
    variance = prior * (1 - prior)
    sums = groups.filter((F.col("n") >= 2) & (variance > 0)).agg(
        F.sum(F.col("n") * (rate - prior) * (rate - prior) / variance).alias("seen"),
        F.count("*").cast("double").alias("groups"),
        F.sum("n").alias("documents"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
    ).first()
    if not sums["groups"]:
        return STRONGEST
    # Expected: groups + spread * documents.
    spread = (sums["seen"] - sums["groups"]) / sums["documents"]
    return float(np.clip(1 / spread if spread > 0 else STRONGEST, WEAKEST, STRONGEST))


def judged(
    docs: DataFrame,
    labels: DataFrame,
    *,
    host: Column,
    path: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    most: int = TRAINING_ROWS,
    threshold: float = THRESHOLD,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Per document: key, ``doc_score``, ``host_rate``, ``path_rate``, ``score`` and ``kept``."""
    workspace = workspace or Workspace(docs.sparkSession)
    shaped = workspace.write(shapes(docs, key, text, host.alias("host"), path.alias("path")), "shapes")
    model = fit_sites(shaped, labels, workspace, key=key, label=label, most=most)
    found = model.judge(shaped, threshold)
    return found.select(F.col("key").alias(key), "doc_score", "host_rate", "path_rate", "score", "kept")


@dataclass(frozen=True)
class SiteModel:
    """Document classifier, base rate, and the rates of all sites."""

    scale: linear.Standard
    weights: np.ndarray
    base: float
    path_strength: float
    sites: DataFrame

    def judge(self, shaped: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
        """``shaped`` (``host``, ``path``, ``shape`` and more) with scores and verdict."""
        scored = shaped.withColumn("odds", evidence(self.scale, self.weights))
        scored = scored.withColumn("doc_score", 1 / (1 + F.exp(-F.col("odds"))))
        same = F.col("host").eqNullSafe(F.col("host_")) & F.col("path").eqNullSafe(F.col("path_"))
        placed = scored.join(self.sites, same)
        # A path's posterior without the document itself.
        others = F.col("path_good") - F.col("doc_score") + self.path_strength * F.col("host_rate")
        rate = others / (F.col("path_n") - 1 + self.path_strength)
        # The classifier's log-odds hold its base rate; what is left without it is the evidence of the text.
        prior = F.greatest(F.least(F.col("path_rate"), F.lit(1 - 1e-6)), F.lit(1e-6))
        odds = F.col("odds") - float(linear.logit(np.array(self.base))) + F.log(prior) - F.log1p(-prior)
        judged_rows = placed.withColumn("path_rate", rate).withColumn("score", 1 / (1 + F.exp(-odds)))
        return judged_rows.withColumn("kept", F.col("score") >= threshold)


def fit_sites(shaped: DataFrame, labels: DataFrame, workspace: Workspace, *, key: str, label: str, most: int) -> SiteModel:
    """The classifier from labelled rows, the sites' rates from all rows of ``shaped``."""
    scale, weights = learn(shaped, labels, key=key, label=label, most=most)
    scored = workspace.write(
        shaped.select("host", "path", evidence(scale, weights).alias("odds")).withColumn(
            "p", 1 / (1 + F.exp(-F.col("odds")))
        ),
        "scored",
    )
    paths = workspace.write(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("good")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    base = (total["good"] + 0.5) / (total["n"] + 1.0) if total["n"] else 0.5
    rate = F.col("good") / F.col("n")
    host_strength = strength(hosts, rate, F.lit(base))
    host_rates = workspace.write(
        hosts.select(
            F.col("host").alias("host_"),
            ((F.col("good") + host_strength * base) / (F.col("n") + host_strength)).alias("host_rate"),
        ),
        "hosts",
    )
    in_hosts = paths.join(host_rates, F.col("host").eqNullSafe(F.col("host_")))
    path_strength = strength(in_hosts, rate, F.col("host_rate"))
    sites = in_hosts.select(
        "host_", F.col("path").alias("path_"), F.col("n").alias("path_n"), F.col("good").alias("path_good"), "host_rate"
    )
    return SiteModel(scale, weights, base, path_strength, workspace.write(sites, "sites"))


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    *,
    host: Column,
    path: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    most: int = TRAINING_ROWS,
    threshold: float = THRESHOLD,
    workspace: Workspace | None = None,
) -> DataFrame:
    """The documents judged good, with the columns they came with.

    Whole documents only meet the table of sites; their shapes are computed once more rather than joined to them.
    """
    workspace = workspace or Workspace(docs.sparkSession)
    sites = (host.alias("host"), path.alias("path"))
    model = fit_sites(
        workspace.write(shapes(docs, key, text, *sites), "shapes"), labels, workspace, key=key, label=label, most=most
    )
    rows = shapes(docs, key, text, *sites, F.struct("*").alias("_row"))
    return model.judge(rows, threshold).filter("kept").select("_row.*")
