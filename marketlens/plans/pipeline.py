"""The end-to-end run: raw tables in, curated and operational tables out."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from marketlens.plans.clean import Cleaned, clean_tables
from marketlens.plans.quality import (
    assert_checks, issue_counts, issue_log, quality_metrics, quarantined_records, run_checks,
    run_summary, stamp_loaded,
)
from marketlens.session import Workspace, tune
from marketlens.sources.curated import publish
from marketlens.sources.raw import read_catalog, read_raw


class Run:
    """One cleaning run. Every table is computed on first use and stored in the work folder."""

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], label: str,
                 catalog: DataFrame | None = None):
        tune(spark)
        self.raw = raw
        self.catalog = catalog
        self.workspace = Workspace(spark, label)

    @cached_property
    def cleaned(self) -> Cleaned:
        return clean_tables(self.raw, self.workspace, self.catalog)

    @property
    def curated(self) -> dict[str, DataFrame]:
        return self.cleaned.curated

    @cached_property
    def issue_counts(self) -> DataFrame:
        return self.workspace.stage(issue_counts(self.cleaned), "issue_counts")

    @cached_property
    def issue_log(self) -> DataFrame:
        return issue_log(self.issue_counts)

    @cached_property
    def quality_metrics(self) -> DataFrame:
        return self.workspace.stage(quality_metrics(self.raw, self.curated), "quality_metrics")

    @cached_property
    def quarantined_records(self) -> DataFrame:
        return quarantined_records(self.cleaned, self.workspace)

    @cached_property
    def run_summary(self) -> DataFrame:
        return self.workspace.stage(
            run_summary(self.raw, self.cleaned, self.issue_counts), "run_summary")

    def verify(self) -> None:
        """Raise unless all load assertions hold on the curated tables."""
        assert_checks(run_checks(self.curated))

    def tables(self, loaded: bool = False) -> dict[str, DataFrame]:
        """The curated six plus the four quality and operations tables."""
        summary = stamp_loaded(self.run_summary) if loaded else self.run_summary
        return {
            **self.curated,
            "data_quality_metrics": self.quality_metrics,
            "data_quality_issue_log": self.issue_log,
            "quarantined_records": self.quarantined_records,
            "pipeline_run_summary": summary,
        }


def run(spark: SparkSession, raw_folder: str, out_folder: str, catalog_path: str | None = None,
        verify: bool = True, version: str | None = None) -> Run:
    """CSV extracts in, verified curated and operational Parquet tables published.

    The raw files are parsed once and stored. Readers of the folder see the previous version until
    all tables of this one are written.
    """
    catalog = read_catalog(spark, catalog_path) if catalog_path else None
    landed = Workspace(spark, raw_folder).stage_all(read_raw(spark, raw_folder))
    job = Run(spark, landed, raw_folder, catalog)
    if verify:
        job.verify()
    publish(job.tables(), out_folder, version or uuid.uuid4().hex)
    return job
