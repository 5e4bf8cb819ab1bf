"""One object over a stored root with every query as a method.

Methods return lazy DataFrames: nothing is counted or collected on the way, and each plan starts at
the partitioned files, so platform and date filters prune directories.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from commentflow.operators import dashboard, filters, joins, lengths
from commentflow.schema import PLATFORMS
from commentflow.sources import readers
from commentflow.sources.kept import KeptReports


class CommentStore:
    """Queries over the comments below ``root`` and the processed set below ``processed_root``.

    With ``kept_root``, reports that only count read the tables that loads keep there, not the comments."""

    def __init__(
        self, spark: SparkSession, root: str, processed_root: str | None = None,
        platforms: Sequence[str] = PLATFORMS, kept_root: str | None = None,
    ):
        self.spark, self.root, self.processed_root = spark, root, processed_root
        self.platforms = tuple(platforms)
        self.kept = None if kept_root is None else KeptReports(spark, kept_root)

    def comments(self) -> DataFrame:
        return readers.scan_all(self.spark, self.root, self.platforms)

    def _counted(self) -> DataFrame:
        return self.comments() if self.kept is None else self.kept.counts()

    def _sized(self) -> DataFrame:
        return self.comments() if self.kept is None else self.kept.lengths()

    def _scoped(self, df: DataFrame, platform: str | None) -> DataFrame:
        return df if platform is None else filters.query_by_platform(df, platform, platforms=self.platforms)

    def query_by_label(self, label: int, platform: str | None = None, limit: int | None = None) -> DataFrame:
        return filters.query_by_label(self.comments(), label, platform, limit, self.platforms)

    def query_by_date(
        self, start_date: date | str, end_date: date | str | None = None, platform: str | None = None,
        label: int | None = None,
    ) -> DataFrame:
        return filters.query_by_date(
            self.comments(), start_date, end_date, platform, label, platforms=self.platforms
        )

    def query_by_platform(self, platform: str, label: int | None = None, limit: int | None = None) -> DataFrame:
        return filters.query_by_platform(self.comments(), platform, label, limit, self.platforms)

    def query_by_topic(
        self, topic: str, platform: str | None = None, label: int | None = None, limit: int | None = None
    ) -> DataFrame:
        return filters.query_by_topic(self.comments(), topic, platform, label, limit, self.platforms)

    def query_by_keyword(
        self, keyword: str, platform: str | None = None, label: int | None = None, exact: bool = True,
        limit: int | None = None,
    ) -> DataFrame:
        return filters.query_by_keyword(
            self.comments(), keyword, platform, label, exact, limit, self.platforms
        )

    def label_distribution(self, platform: str | None = None) -> DataFrame:
        return dashboard.label_distribution(self._scoped(self._counted(), platform))

    def daily_count(
        self, start_date: date | str | None = None, end_date: date | str | None = None, platform: str | None = None
    ) -> DataFrame:
        return dashboard.daily_count(self._scoped(self._counted(), platform), start_date, end_date)

    def platform_comparison(self) -> DataFrame:
        return dashboard.platform_comparison(self._counted())

    def topic_stats(self, platform: str | None = None) -> DataFrame:
        return dashboard.topic_stats(self._scoped(self._counted(), platform))

    def keyword_stats(self, platform: str | None = None, top_n: int = 20) -> DataFrame:
        return dashboard.keyword_stats(self._scoped(self._counted(), platform), top_n=top_n)

    def text_length_stats(self, platform: str | None = None) -> DataFrame:
        return lengths.text_length_stats(self._scoped(self._sized(), platform))

    def topic_label_distribution(self, platform: str | None = None) -> DataFrame:
        return dashboard.topic_label_distribution(self._scoped(self._counted(), platform))

    def source_label_distribution(self) -> DataFrame:
        return dashboard.source_label_distribution(self._counted())

    def source_topic_distribution(self) -> DataFrame:
        return dashboard.source_topic_distribution(self._counted())

    def topic_label_heatmap(self) -> DataFrame:
        return dashboard.topic_label_heatmap(self._counted())

    def topic_distribution(self, platform: str | None = None, top_n: int | None = None) -> DataFrame:
        return dashboard.topic_distribution(self._scoped(self._counted(), platform), top_n=top_n)

    def crawl_timeline(self) -> DataFrame:
        return dashboard.crawl_timeline(self._counted(), self.platforms)

    def dashboard_kpis(self) -> DataFrame:
        return dashboard.dashboard_kpis(self._counted())

    def summary(self) -> DataFrame:
        return dashboard.summary_report(self._counted())

    def get_processed_data(self) -> DataFrame | None:
        return None if self.processed_root is None else readers.scan_processed(self.spark, self.processed_root)

    def platform_profile(self) -> DataFrame:
        return dashboard.platform_profile(self.comments())

    def platform_share(self) -> DataFrame:
        return dashboard.platform_share(self._counted())

    def create_views(self, registry: DataFrame | None = None, evaluation: DataFrame | None = None) -> list[str]:
        """Temporary views for SQL users; returns their names.

        The split view needs a processed set, the model views a registry and evaluation table.
        """
        views = {"raw_crawled_data": self.comments(), "v_platform_stats": self.platform_profile()}
        processed = self.get_processed_data()
        if processed is not None:
            views["processed_data"] = processed
            views["v_dataset_split_stats"] = dashboard.dataset_split_stats(processed)
        if registry is not None:
            views["model_registry"] = registry
        if evaluation is not None:
            views["model_evaluation_results"] = evaluation
        if registry is not None and evaluation is not None:
            views["v_model_comparison"] = joins.model_comparison_join(registry, evaluation)
        for name, df in views.items():
            df.createOrReplaceTempView(name)
        return list(views)
