"""The model's own checks: what must hold for every table after a build."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortlens.operators.relational import union_all
from cohortlens.plans import quality
from cohortlens.plans.build import Build
from cohortlens.plans.declared import DECLARED, SAME_ROWS, row_counts

MAX_FLAG_RATE = 0.08


def model_checks(build: Build) -> DataFrame:
    """Every declared check with its number of violations; all are zero for a sound build.

    Row-level checks were counted when the tables were written; those of views share one scan a table. Uniqueness and references
    on the entity are joins and aggregates over tables in buckets of it.
    """
    summaries, known = [], {}
    for name, checks in DECLARED.items():
        df = getattr(build, name)
        counts = row_counts(name, build.config)
        observed = build.observed.get(SAME_ROWS.get(name, name))
        if observed is None:
            summaries.append(quality.summary(df, counts))
        else:
            known |= {check: observed[check] for check in counts}
        for c in checks.unique:
            summaries.append(quality.count_violations(f"unique:{name}.{c}", quality.check_unique(df, c)))
        if checks.in_dimension:
            orphans = quality.check_relationships(df, build.dim_provider, "npi")
            summaries.append(quality.count_violations(f"reference:{name}.npi", orphans))
    totals = build.observed["mart"]
    too_many = totals["rows"] > 0 and totals["flagged"] / totals["rows"] >= MAX_FLAG_RATE
    known["flag_rate:mart"] = int(too_many)
    summaries.append(build.workspace.spark.createDataFrame(list(known.items()), "check_name string, n_violations long"))
    return union_all(summaries)
