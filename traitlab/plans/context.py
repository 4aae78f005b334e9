"""Per-call context of a registered query: tables, input views, job date."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from .. import constants as C
from ..operators import catalog as cat
from ..operators import features as feat
from ..sources.fixtures import Fixtures
from ..sources.tables import TableSet


class JobContext:
    """Everything a query over one sf directory needs, built lazily once.

    Intermediate results that several steps reuse (the ranked catalog, the
    per-device item lists) are computed once per context.
    """

    def __init__(self, spark: SparkSession, sf_dir: str | None, job_date: int = C.SAMPLE_JOB_DATE,
                 sources: dict[str, str] | None = None):
        """``sources`` maps input views (``app_catalog``, ``user_installs``,
        ``users_info``, ``device_rel``, ``age_device_rel``, ``questionnaire``,
        ``child_stage``, ``age_collect``, ...) to table names, or to paths
        where the value has a slash; other views are derived from the sample
        tables in ``sf_dir``."""
        self.sources = dict(sources or {})
        self.spark = spark
        self.sf_dir = sf_dir
        self.job_date = job_date
        self.tables = TableSet(spark, sf_dir or "")
        self.views = Fixtures(self.tables)

    def view(self, name: str) -> DataFrame:
        if name in self.sources:
            source = self.sources[name]
            return self.spark.read.parquet(source) if "/" in source else self.spark.table(source)
        return self.views[name]

    # --- feature build over the main install table ------------------------

    @cached_property
    def catalog_dedup(self) -> DataFrame:
        return cat.keep_max_installs(cat.catalog_rows(self.view("app_catalog"), self.job_date))

    @cached_property
    def catalog_ranked(self) -> DataFrame:
        return cat.rank_catalog(self.catalog_dedup)

    def items(self, installs_view: str = "user_installs", prefix: str = C.ITEM_PREFIX,
              top_k: int | None = None) -> DataFrame:
        lookup = feat.lookup_for(self.catalog_ranked, prefix, top_k)
        return feat.items_of(self.view(installs_view), self.job_date, lookup)

    @cached_property
    def main_items(self) -> DataFrame:
        return self.items("user_installs", C.ITEM_PREFIX)

    @cached_property
    def features(self) -> DataFrame:
        """(device_id, feature) strings of the main install table."""
        return feat.encode(self.main_items)

    @cached_property
    def parsed(self) -> DataFrame:
        return feat.parse(self.features, C.FEATURE_DIM)
