"""Column functions; all of them stay inside the JVM."""

from cohortlens.functions.labels import cost_band, drug_kind, priority_tier, severity_band, specialty_grouping
from cohortlens.functions.numeric import count_if, pct, safe_ratio, try_to_dec, try_to_int, weighted_total
from cohortlens.functions.scoring import any_of, gated_flag, is_outlier, modified_zscore, zscore
from cohortlens.functions.text import first_nonblank, full_name, null_if_tokens, nonblank

__all__ = [
    "any_of", "cost_band", "count_if", "drug_kind", "first_nonblank", "full_name", "gated_flag",
    "is_outlier", "modified_zscore", "nonblank", "null_if_tokens", "pct", "priority_tier",
    "safe_ratio", "severity_band", "specialty_grouping", "try_to_dec", "try_to_int",
    "weighted_total", "zscore",
]
