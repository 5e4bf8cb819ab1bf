"""Registered queries: sources, sinks, filters and joins."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from commentflow.operators import dedup, filters, joins
from commentflow.plans.registry import query
from commentflow.plans.scratch import new_dir
from commentflow.plans.store import CommentStore
from commentflow.plans.tables import MODELS, Tables
from commentflow.functions import labels as label_functions
from commentflow.functions.links import path_date
from commentflow.operators import evaluation
from commentflow.operators.sampling import train_test_split
from commentflow.schema import INGEST_CSV_SCHEMA, RAW_SCHEMA, model_registry, topic_keyword_dim
from commentflow.sources import readers, writers
from commentflow.sources.digest_index import DigestIndex, load_unknown

POST_COLUMNS = ("id", "text", "topic", "keyword", "url", "label", "platform", "crawl_date")
_ALL = "id, text, topic, keyword, url, label, platform, crawl_date"
_STORED = "cast(id as varchar) as id, text, topic, keyword, url, cast(label as bigint) as label, platform, crawl_date"
_CUT = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"


# ---- sources and sinks --------------------------------------------------------------------

@query("scan_platform", f"select {_STORED} from posts where platform = 'tiktok'")
def _(t: Tables):
    return readers.scan_platform(t.spark, t.store_root(), "tiktok")


@query("scan_all", f"select {_STORED} from posts")
def _(t: Tables):
    return readers.scan_all(t.spark, t.store_root())


@query("scan_processed", f"select {_STORED}, split_set from split_posts", ("posts", "split_posts"))
def _(t: Tables):
    root = new_dir(t.spark, "processed")
    rows = train_test_split(t.posts(), 20)
    rows.withColumn("id", F.col("id").cast("string")).select(*POST_COLUMNS, "split_set").write.parquet(root)
    return readers.scan_processed(t.spark, root)


def _export(t: Tables, path: str) -> None:
    out = t.posts().select(*[F.col("url" if f == "post_url" else f).alias(f) for f in INGEST_CSV_SCHEMA.fieldNames()])
    writers.write_csv_export(out, path, sep=";")


@query("ingest_csv", "select text, topic, keyword, url, cast(label as bigint) as label, platform, date '2024-07-01' as crawl_date from posts")
def _(t: Tables):
    csv, root = new_dir(t.spark, "export"), new_dir(t.spark, "ingested")
    _export(t, csv)
    writers.ingest_csv(t.spark, csv, root, crawl_date=date(2024, 7, 1), escaped=True)
    return readers.scan_all(t.spark, root).drop("id")


@query("assign_ids", "select md5(concat(length(url), ':', url, coalesce(concat(length(text), ':', text), '-'))) as content_id, url, topic from posts")
def _(t: Tables):
    return writers.assign_ids(t.posts(), "content_id", ("url", "text")).select("content_id", "url", "topic")


@query("read_jsonl", "select text from documents", ())
def _(t: Tables):
    path = new_dir(t.spark, "corpus")
    t.table("documents").select(F.col("text").alias("texts")).write.json(path)
    return readers.read_jsonl(t.spark, path)


@query("require_columns", "select id, text, label from posts")
def _(t: Tables):
    return readers.require_columns(t.posts(), ["id", "text", "label"]).select("id", "text", "label")


@query("write_csv_export", f"select {_CUT} as text, topic, keyword, url as post_url from posts")
def _(t: Tables):
    path = new_dir(t.spark, "csv")
    rows = t.posts().select(filters.strip_space(F.col("text")).alias("text"), "topic", "keyword",
                            F.col("url").alias("post_url"))
    writers.write_csv_export(rows, path)
    return readers.read_csv(t.spark, path, rows.schema, sep=",", escaped=True)


@query("file_inventory")
def _(t: Tables):
    return readers.file_inventory(readers.scan_all(t.spark, t.store_root(), schema=RAW_SCHEMA))


@query("file_inventory_rows", "select platform, crawl_date, count(*) as total from posts group by platform, crawl_date")
def _(t: Tables):
    files = readers.file_inventory(readers.scan_all(t.spark, t.store_root(), schema=RAW_SCHEMA))
    day = path_date(F.col("file_path")).cast("date")
    platform = F.regexp_extract("file_path", "platform=([^/]+)", 1)
    return files.groupBy(platform.alias("platform"), day.alias("crawl_date")).agg(F.sum("row_count").alias("total"))


@query("table_head", "select id, text, topic, label from posts order by id limit 5")
def _(t: Tables):
    return readers.table_head(t.posts(), ["id", "text", "topic", "label"])


# ---- filters ------------------------------------------------------------------------------

@query("query_by_label", f"select {_ALL} from posts where label = 2")
def _(t: Tables):
    return filters.query_by_label(t.posts(), 2).select(*POST_COLUMNS)


@query("query_by_date", f"select {_ALL} from posts where crawl_date between date '2024-02-01' and date '2024-03-15'")
def _(t: Tables):
    return filters.query_by_date(t.posts(), "2024-02-01", "2024-03-15").select(*POST_COLUMNS)


@query("query_by_platform", f"select {_ALL} from posts where platform = 'threads'")
def _(t: Tables):
    return filters.query_by_platform(t.posts(), "threads").select(*POST_COLUMNS)


# The same filters over the partitioned store, with their optional arguments.

def _store(t: Tables) -> CommentStore:
    return CommentStore(t.spark, t.store_root())


@query("store_query_by_platform_label_limit",
       f"select {_STORED} from posts where platform = 'threads' and label = 0 order by cast(id as varchar) limit 100")
def _(t: Tables):
    return _store(t).query_by_platform("threads", label=0, limit=100).select(*POST_COLUMNS)


@query("store_query_by_label_platform", f"select {_STORED} from posts where label = 1 and platform = 'tiktok'")
def _(t: Tables):
    return _store(t).query_by_label(1, platform="tiktok").select(*POST_COLUMNS)


@query("store_query_by_date_platform_label", f"""
select {_STORED} from posts where crawl_date between date '2024-02-01' and date '2024-03-15' and platform = 'tiktok' and label = 0""")
def _(t: Tables):
    return _store(t).query_by_date("2024-02-01", "2024-03-15", platform="tiktok", label=0).select(*POST_COLUMNS)


@query("store_query_by_one_day", f"select {_STORED} from posts where crawl_date = date '2024-02-01'")
def _(t: Tables):
    return _store(t).query_by_date("2024-02-01").select(*POST_COLUMNS)


@query("store_query_by_topic_platform_label", f"select {_STORED} from posts where topic = 'src3' and platform = 'threads' and label = 0")
def _(t: Tables):
    return _store(t).query_by_topic("src3", platform="threads", label=0).select(*POST_COLUMNS)


@query("store_query_by_keyword_platform", f"select {_STORED} from posts where contains(lower(keyword), 'src5') and platform = 'threads'")
def _(t: Tables):
    return _store(t).query_by_keyword("src5", platform="threads", exact=False).select(*POST_COLUMNS)


@query("store_label_distribution_platform",
       "select label, count(*) as total from posts where platform = 'tiktok' group by label")
def _(t: Tables):
    return _store(t).label_distribution(platform="tiktok").select("label", "total")


@query("store_daily_count_range", """
select crawl_date, platform, count(*) as total from posts
where platform = 'tiktok' and crawl_date between date '2024-01-10' and date '2024-02-20' group by crawl_date, platform""")
def _(t: Tables):
    return _store(t).daily_count("2024-01-10", "2024-02-20", platform="tiktok").select("crawl_date", "platform", "total")


@query("store_comment_key", """
with k as (select cast(id as varchar) as id, coalesce(nullif(regexp_extract(url, '/video/(\\d+)', 1), ''), 'unknown') as video from posts)
select id, concat(video, '_', row_number() over (partition by video order by id) - 1) as comment_id from k""".replace("\\\\", "\\"))
def _(t: Tables):
    return dedup.comment_key(_store(t).comments().select("id", "url")).select("id", "comment_id")


@query("query_by_topic", f"select {_ALL} from posts where lower(topic) = 'src3'")
def _(t: Tables):
    return filters.query_by_topic(t.posts(), "SRC3").select(*POST_COLUMNS)


@query("query_by_keyword", f"select {_ALL} from posts where lower(keyword) = 'src5_en'")
def _(t: Tables):
    return filters.query_by_keyword(t.posts(), "Src5_EN").select(*POST_COLUMNS)


@query("query_by_keyword_like", f"select {_ALL} from posts where contains(lower(keyword), '_fr')")
def _(t: Tables):
    return filters.query_by_keyword_like(t.posts(), "_FR").select(*POST_COLUMNS)


@query("filter_source_in", "select id, source, topic from posts where source in ('threads', 'tiktok')")
def _(t: Tables):
    return filters.filter_source_in(t.posts()).select("id", "source", "topic")


@query("top_topics_semi", """
with top as (select topic from posts where topic is not null group by topic order by count(*) desc, topic limit 10)
select id, topic, label from posts where topic in (select topic from top)""")
def _(t: Tables):
    return filters.top_topics_semi(t.posts()).select("id", "topic", "label")


@query("drop_missing_text", f"""
select id, lower({_CUT}) as text from posts where text is not null and {_CUT} <> ''""")
def _(t: Tables):
    return filters.drop_missing_text(t.posts()).select("id", "text")


@query("training_rows", "select text, cast(label as int) as label from posts where text is not null and label is not null")
def _(t: Tables):
    return filters.training_rows(t.posts())


# Short strings to filter: every line of every document.
_LINES = "with lines as (select doc_id, unnest(string_split(text, chr(10))) as text from documents)"


def _lines(t: Tables):
    return t.table("documents").select("doc_id", F.explode(F.split("text", "\n")).alias("text"))


@query("min_length", f"{_LINES} select doc_id, text from lines where length(text) >= 5", ())
def _(t: Tables):
    return filters.min_length(_lines(t), n=5)


@query("drop_ui_labels", f"""{_LINES}
select doc_id, text from lines
where text not in ({", ".join(f"'{c}'" for c in filters.UI_CAPTIONS)})""", ())
def _(t: Tables):
    return filters.drop_ui_labels(_lines(t))


@query("drop_reply_lines", f"{_LINES} select doc_id, text from lines where not starts_with(text, '{filters.REPLY_PREFIX}')", ())
def _(t: Tables):
    return filters.drop_reply_lines(_lines(t))


@query("drop_relative_time", f"""{_LINES}
select doc_id, text from lines where not regexp_matches(text, '{filters.RELATIVE_TIME}')""", ())
def _(t: Tables):
    return filters.drop_relative_time(_lines(t))


@query("drop_counters", f"""{_LINES}
select doc_id, text from lines where not regexp_matches(lower(text), '{filters.COUNTER}')""", ())
def _(t: Tables):
    return filters.drop_counters(_lines(t))


@query("unparsed_rows", "select id, llm as predicted_label, topic from voters where llm = -1 order by id limit 50",
       ("posts", "voters"))
def _(t: Tables):
    return filters.unparsed_rows(t.voters(), "llm").select("id", F.col("llm").alias("predicted_label"), "topic")


@query("drop_unlabelled", "select id, label, topic from posts where label is distinct from -1")
def _(t: Tables):
    return filters.drop_unlabelled(t.posts()).select("id", "label", "topic")


@query("flag_target", "select id, model_a in (1, 2) as is_target from voters", ("posts", "voters"))
def _(t: Tables):
    return t.voters().select("id", label_functions.flag_target(F.col("model_a")).alias("is_target"))


# ---- joins --------------------------------------------------------------------------------

_UNSTORED = f"""
with keyed as (select *, {_CUT} as cut from posts)
select n.id, n.topic, n.keyword, n.url from keyed n
where not exists (select 1 from keyed s where s.label >= 0 and s.cut = n.cut and s.topic = n.topic
                  and s.keyword = n.keyword and s.url = n.url)"""


@query("incremental_anti", _UNSTORED)
def _(t: Tables):
    posts = t.stored_posts()
    root = new_dir(t.spark, "labelled")
    # Splits of the store's files lie in one directory each, so nothing is moved.
    writers.write_comments(posts.filter(F.col("label") >= 0).withColumn("id", F.col("id").cast("string")), root, dealt=True)
    return joins.incremental_anti(posts, readers.scan_digests(t.spark, root)).select("id", "topic", "keyword", "url")


@query("incremental_anti_indexed", _UNSTORED)
def _(t: Tables):
    """An index made of one half of the labelled rows, to which the other half is added as two batches."""
    posts = t.stored_posts()
    labelled = posts.filter(F.col("label") >= 0)
    index = DigestIndex(t.spark, new_dir(t.spark, "digest-index"), rows_per_bucket=1 << 12)
    index.build(joins.digests(labelled.filter(F.col("id") % 4 < 2), joins.STORED_KEY, "text"))
    for batch in (1, 2):
        index.add(load_unknown(labelled.filter(F.col("id") % 4 == batch + 1), index).select(joins.DIGEST), batch)
    return load_unknown(posts, index).select("id", "topic", "keyword", "url")


@query("align_predictions", """
select p.id, p.topic, v.model_a, v.model_b, v.llm from posts p join voters v using (id)""", ("posts", "voters"))
def _(t: Tables):
    votes = t.voters()
    tables = {m: votes.select("id", F.col(m).alias("label")) for m in MODELS}
    return joins.align_predictions(t.posts().select("id", "topic"), tables)


_MODEL_ROWS = """(values ('model_a', 'Model A', 'traditional', 'v1.0'), ('model_b', 'Model B', 'traditional', 'v1.0'),
 ('llm', 'Chat model', 'deep_learning', 'v1.0')) r(model_id, model_display_name, model_type, version)"""


def registry_rows(t: Tables):
    return model_registry(t.spark, [
        ("model_a", "Model A", "traditional", "v1.0"), ("model_b", "Model B", "traditional", "v1.0"),
        ("llm", "Chat model", "deep_learning", "v1.0"),
    ])


def evaluation_rows(t: Tables):
    return evaluation.model_evaluation(t.oof().withColumnRenamed("model", "model_id"))


_EVALUATED = """
with cells as (select model, c, count(*) filter (where label = c and prediction = c) as tp, count(*) filter (where prediction = c) as pred,
                      count(*) filter (where label = c) as act, count(*) as n, count(*) filter (where label = prediction) as ok
               from oof, (select unnest([0, 1, 2]) as c) group by model, c),
scored as (select *, case when pred = 0 then 0 else tp / pred end as p, case when act = 0 then 0 else tp / act end as r,
                  case when pred + act = 0 then 0 else 2 * tp / (pred + act) end as f from cells),
models as (select model as model_id, round(max(ok) / max(n), 4) as accuracy, round(avg(f), 4) as macro_f1,
                  round(sum(f * act) / sum(act), 4) as weighted_f1, round(avg(p), 4) as macro_precision,
                  round(avg(r), 4) as macro_recall, round(max(case when c = 2 then f end), 4) as target_hate_f1,
                  round(max(case when c = 1 then f end), 4) as target_offensive_f1,
                  round(max(case when c = 0 then f end), 4) as target_normal_f1, cast(max(n) as bigint) as total_samples
           from scored group by model)
"""
OOF = ("posts", "voters", "folds", "oof")


@query("model_comparison_join", f"""{_EVALUATED}
select m.model_id, model_display_name, model_type, version, accuracy, macro_f1, weighted_f1, macro_precision, macro_recall,
       target_hate_f1, target_offensive_f1, target_normal_f1, total_samples
from models m join {_MODEL_ROWS} on m.model_id = r.model_id""", OOF)
def _(t: Tables):
    return joins.model_comparison_join(registry_rows(t), evaluation_rows(t)).drop("confusion_matrix")


@query("label_dim_join", """
select p.id, p.label, d.label_name, d.upper_name, d.lower_name, d.registry_name
from posts p left join (values (-1, 'chưa gán nhãn', null, null, null), (0, 'bình thường', 'CLEAN', 'clean', 'normal'),
  (1, 'offensive', 'OFFENSIVE', 'offensive', 'offensive'), (2, 'hate speech', 'HATE', 'hate', 'hate_speech'))
  d(label, label_name, upper_name, lower_name, registry_name) on p.label = d.label""")
def _(t: Tables):
    return joins.label_dim_join(t.posts().select("id", "label"))


@query("topic_keyword_check", """
select topic, keyword, count(*) as row_count from posts
where not (topic = 'src1' and keyword = 'src1_en') group by topic, keyword""")
def _(t: Tables):
    planned = topic_keyword_dim(t.spark).unionByName(
        t.spark.createDataFrame([("src1", "src1_en")], "topic string, keyword string")
    )
    return joins.topic_keyword_check(t.posts(), planned)


# ---- ranking, duplicates, caps ------------------------------------------------------------

@query("dedup_prefix80", """
select id, topic, label from (select *, row_number() over (partition by lower(left(text, 80)) order by id) as rn from posts)
where rn = 1""")
def _(t: Tables):
    return dedup.dedup_prefix80(t.posts().select("id", "text", "topic", "label")).select("id", "topic", "label")


@query("dedup_exact_in_group", f"""
select id, topic, label from (
  select *, row_number() over (partition by topic, {_CUT} order by id) as rn from posts)
where rn = 1""")
def _(t: Tables):
    rows = t.posts().select("id", "text", "topic", "label")
    return dedup.dedup_exact_in_group(rows, ["topic"]).select("id", "topic", "label")


@query("cap_per_group", """
select id, lang, label from (select *, row_number() over (partition by lang order by id) as rn from posts) where rn <= 500""")
def _(t: Tables):
    return dedup.cap_per_group(t.posts().select("id", "lang", "label"), ["lang"])


@query("cap_posts_per_keyword", """
with firsts as (select keyword, url, min(id) as first from posts group by keyword, url),
kept as (select keyword, url from (select *, dense_rank() over (partition by keyword order by first, url) as rk from firsts)
         where rk <= 10)
select id, keyword, url from posts where (keyword, url) in (select (keyword, url) from kept)""")
def _(t: Tables):
    return dedup.cap_posts_per_keyword(t.posts().select("id", "keyword", "url"))


@query("distinct_urls", "select distinct url from posts")
def _(t: Tables):
    return dedup.distinct_urls(t.posts())


@query("comment_key", """
select id, concat(video, '_', row_number() over (partition by video order by id) - 1) as comment_id
from (select id, coalesce(nullif(regexp_extract(url, '/video/(\\d+)', 1), ''), 'unknown') as video from posts)""".replace("\\\\", "\\"))
def _(t: Tables):
    return dedup.comment_key(t.posts().select("id", "url")).select("id", "comment_id")
