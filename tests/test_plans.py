"""What the plans of the registered queries must and must not contain."""

import os
import re

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from commentflow.operators import inference
from commentflow.plans import scratch, tables
from commentflow.plans.catalog import REGISTRY
from commentflow.plans.tables import Tables

SF_DIR = "/root/testdata/sf0.001"
PYTHON_QUERIES = {"nfc", "preprocess", "preprocess_table"}
STREAMS = {"stream_moderation", "stream_moderation_routed", "stream_ingest_dedup", "stream_daily_count"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.filterwarnings("ignore:no predictions")
@pytest.mark.parametrize("key", [k for k in REGISTRY if k not in STREAMS and not k.startswith(("baseline", "cross_fitted"))])
def test_no_cross_join_and_no_unexpected_python(spark, key):
    plan = plan_of(REGISTRY[key](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if key not in PYTHON_QUERIES:
        assert "EvalPython" not in plan and "InPandas" not in plan and "InArrow" not in plan


@pytest.mark.parametrize("key", ["dedup_prefix80", "dedup_exact_in_group", "ngrams_by_label"])
def test_group_limits_are_applied_before_the_shuffle(spark, key):
    plan = plan_of(REGISTRY[key](spark, SF_DIR))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


@pytest.mark.parametrize("key", ["platform_comparison", "topic_label_heatmap", "daily_count"])
def test_aggregates_read_no_text(spark, key):
    plan = plan_of(REGISTRY[key](spark, SF_DIR))
    assert all("text" not in schema for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    assert "partial_count" in plan


def test_the_model_runs_once_per_row(spark):
    flagged = inference.analyze_text(Tables(spark, SF_DIR).table("documents"), inference.lexicon_factory({"idiot": 1}))
    assert plan_of(flagged.filter("is_target").filter("predicted_label = 1")).count("EvalPython") == 1


def test_top_lists_do_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan_of(REGISTRY["keyword_stats"](spark, SF_DIR))


def test_summary_counts_the_rows_once(spark):
    df = REGISTRY["summary_report"](spark, SF_DIR)
    df.collect()
    assert "ReusedExchange" in plan_of(df)


def test_scratch_is_shared():
    class Conf(dict):
        pass

    class Session:
        class sparkContext:
            applicationId = "app"

        conf = Conf({"spark.sql.warehouse.dir": "s3a://lake/warehouse"})

    assert scratch.scratch_root(Session) == "s3a://lake/warehouse/_scratch/commentflow-app"
    Session.conf["spark.checkpoint.dir"] = "hdfs://shared/"
    assert scratch.scratch_root(Session) == "hdfs://shared/commentflow-app"


def test_the_store_is_written_with_one_shuffle_of_the_texts(spark, tmp_path, monkeypatch):
    """Also where the labels are too many for a broadcast."""
    written = []
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *args, **options: written.append(self._df))
    monkeypatch.setattr(tables, "_STORES", {})
    (tmp_path / "tables").symlink_to(SF_DIR)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        Tables(spark, str(tmp_path / "tables")).store_root()
        plan = plan_of(written[0])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert len(written) == 1 and len(re.findall(r"\bExchange\b", plan)) == 1


def test_dealt_posts_are_the_posts(spark):
    t = Tables(spark, SF_DIR)
    dealt, posts = t.dealt_posts(), t.posts()
    assert dealt.schema == posts.schema
    assert dealt.count() == posts.count() and dealt.exceptAll(posts).isEmpty()


def test_a_load_compares_stored_rows_and_joins_no_labels_again(spark):
    plan = plan_of(REGISTRY["incremental_anti"](spark, SF_DIR))
    assert "labels.parquet" not in plan and "/platform=tiktok" in "".join(REGISTRY["incremental_anti"](spark, SF_DIR).inputFiles())
