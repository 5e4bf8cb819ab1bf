"""Readers and writers on temporary directories."""

import csv
import datetime

import pytest
from pyspark.sql import functions as F

from commentflow.operators import joins
from commentflow.operators.filters import query_by_platform
from commentflow.plans.store import CommentStore
from commentflow.schema import INGEST_CSV_SCHEMA, RAW_SCHEMA, model_registry, topic_keyword_dim
from commentflow.sources import readers, writers

TEXTS = ['plain', 'semi;colon', 'quo"te', "two\nlines", "a,b", "Đồ ăn ngon"]


@pytest.fixture
def export(spark, tmp_path):
    rows = [
        (t, "the_thao", "Bóng đá", f"https://h/video/{i}", "tiktok" if i % 2 else "threads", i % 3)
        for i, t in enumerate(TEXTS)
    ] + [("other", "x", "y", "u", "facebook", 0), ("unlabelled", "x", "y", "u", "tiktok", None)]
    path = str(tmp_path / "export")
    df = spark.createDataFrame(rows, INGEST_CSV_SCHEMA)
    df.write.option("sep", ";").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return path


def test_ingest_writes_partitions_and_reads_back(spark, tmp_path, export):
    root = str(tmp_path / "store")
    writers.ingest_csv(spark, export, root, crawl_date="2026-06-01", multi_line=True)
    writers.ingest_csv(spark, export, root, crawl_date=datetime.date(2026, 6, 2), content_ids=True, multi_line=True)
    df = readers.scan_all(spark, root)
    assert set(df.columns) == {*RAW_SCHEMA.fieldNames(), "platform", "crawl_date"}
    assert sorted(r.text for r in df.filter("crawl_date = '2026-06-01'").collect()) == sorted([*TEXTS, "unlabelled"])
    assert df.select("platform").distinct().count() == 2
    assert df.filter("text = 'unlabelled' and label is null").count() == 2
    assert df.filter("crawl_date = '2026-06-01'").select("id").distinct().count() == len(TEXTS) + 1


def test_content_ids_are_stable(spark, export):
    rows = readers.read_csv(spark, export, multi_line=True)
    first, second = (
        {r.id for r in writers.comments_from_csv(rows, "2026-06-01", content_ids=True).collect()} for _ in range(2)
    )
    assert first == second and len(first) == len(TEXTS) + 1


def test_filters_on_partition_columns_prune_directories(spark, tmp_path, export):
    root = str(tmp_path / "store")
    for day in ("2026-06-01", "2026-06-02", "2026-06-03"):
        writers.ingest_csv(spark, export, root, crawl_date=day, multi_line=True)
    store = CommentStore(spark, root)
    df = store.query_by_date("2026-06-02", platform="tiktok")
    assert len(df.inputFiles()) > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "crawl_date" in filters and "platform" in filters
    read = {r[0] for r in df.select(F.col("_metadata.file_path")).distinct().collect()}
    assert read and all("platform=tiktok/crawl_date=2026-06-02" in f for f in read)
    narrow = store.label_distribution()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<label:bigint>" in narrow


def test_plain_directory_layout_is_read(spark, tmp_path):
    root = tmp_path / "plain"
    day = str(root / "tiktok" / "crawl_date=2026-06-09")
    spark.createDataFrame([("1", "t", "tp", "k", "u", 0)], RAW_SCHEMA).write.parquet(day)
    rows = readers.scan_all(spark, str(root)).collect()
    assert [(r.platform, r.crawl_date) for r in rows] == [("tiktok", datetime.date(2026, 6, 9))]
    assert readers.scan_platform(spark, str(root), "tiktok").count() == 1


@pytest.mark.parametrize("column", ["text", "comment_text"])
def test_crawl_output_with_byte_order_mark(spark, tmp_path, column):
    path = tmp_path / "crawl.csv"
    with path.open("w", newline="", encoding="utf-8-sig") as file:
        writer = csv.writer(file, quoting=csv.QUOTE_ALL)
        writer.writerow([column, "topic", "keyword", "post_url"])
        writer.writerows([t, "the_thao", "Bóng đá", "u"] for t in TEXTS)
    rows = readers.read_crawl_csv(spark, str(path), column, multi_line=True)
    assert rows.columns == ["text", "topic", "keyword", "url"]
    assert sorted(r.text for r in rows.collect()) == sorted(TEXTS)


def test_label_widths_may_differ_between_files(spark, tmp_path):
    for day, kind in (("2026-06-01", "int"), ("2026-06-02", "bigint")):
        df = spark.sql(f"select '1' as id, 't' as text, cast(2 as {kind}) as label")
        df.write.parquet(str(tmp_path / "tiktok" / f"crawl_date={day}"))
    rows = readers.scan_all(spark, str(tmp_path)).filter("label = 2").collect()
    assert [(r.label, r.topic) for r in rows] == [(2, None), (2, None)]


def test_single_line_export_is_read_in_splits(spark, tmp_path):
    path = tmp_path / "lines.csv"
    path.write_text("text;topic;keyword;post_url;source;label\n" + '"a; b";t;k;u;tiktok;1\n' * 1000, encoding="utf-8")
    rows = readers.read_csv(spark, str(path), multi_line=False)
    assert rows.filter("text = 'a; b' and label = 1").count() == 1000


def test_missing_roots(spark, tmp_path):
    with pytest.raises(ValueError, match="no comments"):
        readers.scan_all(spark, str(tmp_path / "nothing"))
    assert readers.scan_processed(spark, str(tmp_path / "nothing")) is None
    with pytest.raises(ValueError, match="unknown platform"):
        query_by_platform(spark.createDataFrame([("tiktok", "1")], "platform string, id string"), "facebook")


def test_csv_export_round_trip(spark, tmp_path):
    path = str(tmp_path / "csv")
    texts = [*TEXTS, "back\\slash\\n", "cr\r\nlf", "\\"]
    df = spark.createDataFrame([(t, "a", "b", "c") for t in texts], "text string, topic string, keyword string, post_url string")
    writers.write_csv_export(df, path)
    writers.write_csv_export(df.filter("text = 'plain'"), path)
    back = readers.read_csv(spark, path, df.schema, sep=",", escaped=True)
    assert sorted(r.text for r in back.collect()) == sorted([*texts, "plain"])


def test_jsonl_inventory_head_and_required_columns(spark, tmp_path):
    path = str(tmp_path / "jsonl")
    spark.createDataFrame([("a",), ("b",)], "texts string").coalesce(1).write.json(path)
    assert sorted(r.text for r in readers.read_jsonl(spark, path).collect()) == ["a", "b"]
    inventory = readers.file_inventory(spark.read.json(path)).collect()
    assert sum(r.row_count for r in inventory) == 2 and all(r.file_size > 0 for r in inventory)
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id int, text string")
    assert [r.text for r in readers.table_head(df, ["text"], 2).collect()] == ["a", "b"]
    with pytest.raises(ValueError, match=r"\['label'\].*\['id', 'text'\]"):
        readers.require_columns(df, ["text", "label"])


def test_topic_plan_has_ten_keywords_per_topic(spark):
    counts = topic_keyword_dim(spark).groupBy("topic").count().collect()
    assert len(counts) == 10 and all(r["count"] == 10 for r in counts)


def test_store_queries_run_end_to_end(spark, tmp_path, export):
    root = str(tmp_path / "store")
    writers.ingest_csv(spark, export, root, crawl_date="2026-06-01", multi_line=True)
    store = CommentStore(spark, root)
    total = len(TEXTS) + 1
    assert store.query_by_label(0).count() + store.query_by_label(1).count() + store.query_by_label(2).count() == len(TEXTS)
    assert store.query_by_topic("THE_THAO", platform="tiktok", limit=2).count() == 2
    assert store.query_by_keyword("bóng", exact=False).count() == len(TEXTS)
    assert store.query_by_keyword("bóng").count() == 0
    assert {r.platform: r.total for r in store.platform_comparison().collect()} == {"threads": 3, "tiktok": 4}
    assert {r.label: r.total for r in store.label_distribution().collect()}[None] == 1
    assert [r.value for r in store.summary().filter("section = 'total'").collect()] == [total]
    kpis = store.dashboard_kpis().first()
    assert (kpis.total_records, kpis.total_labeled, kpis.total_platforms) == (total, total, 2)
    for result in (store.daily_count(), store.topic_stats(), store.keyword_stats(), store.text_length_stats(),
                   store.topic_label_distribution(), store.source_label_distribution(), store.source_topic_distribution(),
                   store.topic_label_heatmap(), store.topic_distribution(), store.crawl_timeline()):
        assert result.count() > 0


def test_views_can_be_queried_with_sql(spark, tmp_path, export):
    root, processed = str(tmp_path / "store"), str(tmp_path / "processed")
    writers.ingest_csv(spark, export, root, crawl_date="2026-06-01", multi_line=True)
    rows = CommentStore(spark, root).comments().filter("label is not null").withColumn("split_set", F.lit("train"))
    rows.write.parquet(processed)
    registry = model_registry(spark, [("m1", "Model", "traditional", "v1")])
    results = spark.createDataFrame([("m1", 0.9), ("m2", 0.8)], "model_id string, accuracy double")
    names = CommentStore(spark, root, processed).create_views(registry, results)
    assert "v_dataset_split_stats" in names and "v_model_comparison" in names
    assert spark.sql("select sum(total_records) from v_platform_stats").first()[0] == len(TEXTS) + 1
    assert spark.sql("select sum(record_count) from v_dataset_split_stats").first()[0] == len(TEXTS)
    assert [r.model_display_name for r in spark.sql("select * from v_model_comparison").collect()] == ["Model"]


def test_both_directory_layouts_are_read(spark, tmp_path):
    row = spark.createDataFrame([("1", "t", "tp", "k", "u", 0)], RAW_SCHEMA)
    row.write.parquet(str(tmp_path / "tiktok" / "crawl_date=2026-06-01"))
    row.write.parquet(str(tmp_path / "platform=tiktok" / "crawl_date=2026-06-02"))
    assert readers.scan_platform(spark, str(tmp_path), "tiktok").count() == 2


def test_content_ids_tell_nulls_and_borders_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", ""), ("", "a"), ("ab", "c"), ("a", "bc")], "x string, y string")
    assert df.select(writers.content_id("x", "y").alias("i")).distinct().count() == 6


def test_stored_digests_spare_the_stored_texts(spark, tmp_path, export):
    root = str(tmp_path / "store")
    writers.ingest_csv(spark, export, root, crawl_date="2026-06-01", multi_line=True)
    new = readers.scan_all(spark, root).limit(3).unionByName(readers.scan_all(spark, root).limit(1).withColumn("text", F.lit("unseen")))
    kept = joins.incremental_anti(new, readers.scan_digests(spark, root))
    assert [r.text for r in kept.collect()] == ["unseen"]
    plan = readers.scan_digests(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<row_digest:binary>" in plan and "sha2" not in plan
