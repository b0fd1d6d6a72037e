"""Lazily built pipeline tables for one input directory.

``PipelineTables(spark, sf_dir)`` derives raw events from the driver's
``events`` table and builds Silver and Gold on demand, each once per object.
Everything stays a lazy plan; nothing is collected.  The registered queries
use it so that each query's work grows with the input tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..fixtures import raw_events
from ..operators import bronze, gold, quality, silver
from ..streaming import metrics
from ..session import ensure_utc


class PipelineTables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        ensure_utc(spark)
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def raw_events(self) -> DataFrame:
        return raw_events(self.spark, self.sf_dir)

    @cached_property
    def tagged(self) -> DataFrame:
        return silver.tag_records(self.raw_events)

    @cached_property
    def silver_events(self) -> DataFrame:
        return silver.to_silver(self.tagged)

    @cached_property
    def rejected_events(self) -> DataFrame:
        return silver.rejected_records(self.tagged)

    @cached_property
    def gold_revenue_metrics(self) -> DataFrame:
        return gold.revenue_metrics(self.silver_events)

    @cached_property
    def gold_top_products(self) -> DataFrame:
        return gold.top_products(self.silver_events)

    @cached_property
    def gold_user_segments(self) -> DataFrame:
        return gold.user_segments(self.silver_events)

    @cached_property
    def gold_sales_metrics(self) -> DataFrame:
        """C1 over the whole (bounded) Silver, exact buyer counts."""
        return metrics.sales_metrics(self.silver_events, exact_distinct=True)

    @cached_property
    def gold_dq_reports(self) -> DataFrame:
        return quality.dq_report(self.silver_events)

    @cached_property
    def bronze_events(self) -> DataFrame:
        return bronze.bronze_envelope(bronze.to_payload(self.raw_events))

    @cached_property
    def hours(self) -> DataFrame:
        """The 24 hours of a day (fills hours without revenue)."""
        return self.spark.range(24)

    def get(self, name: str) -> DataFrame:
        return getattr(self, name)

    def bind(self, names: list[str]) -> dict[str, DataFrame]:
        return {n: self.get(n) for n in names}
