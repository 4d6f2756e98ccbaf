"""The whole model as a set of tables that build on each other.

Detail rows are read once per rollup; whatever several later steps read is written once, in buckets of
the entity where they join by it: the chain of joins, the profile and the checks on the key shuffle none of these tables again. A table is
built when it is first asked for, so a report pays only for what it needs.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, Observation

from cohortlens.config import OutlierConfig
from cohortlens.plans import marts, profile, rollups, staging
from cohortlens.plans.declared import observed_counts
from cohortlens.session import Workspace, input_bytes, small_tasks


class Build:
    """Tables derived from the three raw sources and the taxonomy seed."""

    def __init__(
        self,
        workspace: Workspace,
        raw_part_d: DataFrame,
        raw_part_b: DataFrame,
        raw_registry: DataFrame,
        taxonomy: DataFrame,
        config: OutlierConfig = OutlierConfig(),
        data_year: int = 2023,
    ):
        self.workspace = workspace
        self.taxonomy = taxonomy
        self.config = config
        # Per written table, what was counted on its rows while they were written.
        self.observed: dict[str, dict[str, int]] = {}
        self.stg_part_d = staging.stg_part_d(raw_part_d, data_year)
        self.stg_part_b = staging.stg_part_b(raw_part_b, data_year)
        self.stg_registry = staging.stg_registry(raw_registry)
        self._inputs = (raw_part_d, raw_part_b, raw_registry)

    @cached_property
    def _input_bytes(self) -> int:
        return input_bytes(*self._inputs)

    def _small_tasks(self):
        """The rollups make several wide rows of each detail row: their tasks are kept small."""
        return small_tasks(self.workspace.spark, self._input_bytes)

    def _write(self, df: DataFrame, name: str, write: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """What ``write`` returns for ``df``, and the counts of its declared checks."""
        observation = Observation()
        counts = observed_counts(name, self.config)
        with self._small_tasks():
            table = write(df.observe(observation, *[count.alias(check) for check, count in counts.items()]))
        self.observed[name] = observation.get
        return table

    def _write_by_entity(self, df: DataFrame, name: str) -> DataFrame:
        return self._write(df, name, lambda rows: self.workspace.write_bucketed(rows, name, "npi", dealt=True))

    @cached_property
    def part_d_annual(self) -> DataFrame:
        annual = rollups.part_d_annual(self.stg_part_d.select(*rollups.PART_D_INPUTS))
        return self._write_by_entity(annual, "part_d_annual")

    @cached_property
    def part_b_annual(self) -> DataFrame:
        annual = rollups.part_b_annual(self.stg_part_b)
        return self._write_by_entity(annual, "part_b_annual")

    @cached_property
    def registry(self) -> DataFrame:
        """The registry entries' columns of the profile, by entity."""
        with self._small_tasks():
            return self.workspace.write_bucketed(self.stg_registry.select(*profile.REGISTRY_INPUTS), "registry", "npi")

    @cached_property
    def profile_with_facts(self) -> DataFrame:
        # The sources do not depend on each other: submitted together, one fills the gaps of the other.
        with self._small_tasks(), ThreadPoolExecutor(3) as pool:
            tables = pool.map(lambda name: getattr(self, name), ("registry", "part_d_annual", "part_b_annual"))
            registry, part_d, part_b = tables
        joined = profile.profile_with_facts(registry, part_d, part_b, self.taxonomy)
        return self._write_by_entity(joined, "provider_profile")

    @property
    def provider_profile(self) -> DataFrame:
        return self.profile_with_facts.select(*profile.PROFILE_COLUMNS)

    @property
    def dim_provider(self) -> DataFrame:
        return profile.dim_provider(self.profile_with_facts)

    @property
    def population(self) -> DataFrame:
        """Dimension and facts of every entity: what the statistics and the mart start from."""
        return profile.dim_provider(self.profile_with_facts, keep=profile.FACT_COLUMNS)

    @property
    def fct_part_d(self) -> DataFrame:
        return profile.fct_part_d(self.part_d_annual)

    @property
    def fct_part_b(self) -> DataFrame:
        return profile.fct_part_b(self.part_b_annual)

    @cached_property
    def peer_group_stats(self) -> DataFrame:
        stats = marts.peer_group_stats(self.population, self.taxonomy, self.workspace, self.config)
        return self._write(stats, "peer_group_stats", lambda rows: self.workspace.write(rows, "peer_group_stats"))

    @cached_property
    def mart(self) -> DataFrame:
        scored = marts.outlier_mart(self.population, self.peer_group_stats, self.config)
        return self._write(scored, "mart", lambda rows: self.workspace.write(rows, "provider_outliers"))
