"""Registered queries: dashboard and exploratory aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from commentflow.operators import dashboard, exploration, lengths, ngrams
from commentflow.operators.sampling import train_test_split
from commentflow.plans.registry import REGISTRY, query
from commentflow.plans.scratch import new_dir
from commentflow.plans.tables import Tables
from commentflow.sources.kept import KeptReports

_NAME = """case label when -1 then 'chưa gán nhãn' when 0 then 'bình thường' when 1 then 'offensive'
 when 2 then 'hate speech' else 'không xác định' end as label_name"""
_REGISTRY_NAME = "case label when 0 then 'normal' when 1 then 'offensive' when 2 then 'hate_speech' end"
_TOKENS = r"len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> ''))"


def _split(t: Tables):
    return train_test_split(t.posts(), 20)


@query("label_distribution", f"select label, count(*) as total, {_NAME} from posts group by label")
def _(t: Tables):
    return dashboard.label_distribution(t.posts())


@query("daily_count", "select crawl_date, platform, count(*) as total from posts group by all")
def _(t: Tables):
    return dashboard.daily_count(t.posts())


@query("platform_comparison", """
select platform, count(*) as total, count(*) filter (where label = -1) as "chưa_gán_nhãn", count(*) filter (where label = 0) as "bình_thường",
       count(*) filter (where label = 1) as offensive, count(*) filter (where label = 2) as hate_speech from posts group by platform""")
def _(t: Tables):
    return dashboard.platform_comparison(t.posts())


@query("topic_stats", "select topic, platform, count(*) as total from posts group by all")
def _(t: Tables):
    return dashboard.topic_stats(t.posts())


@query("keyword_stats", """
select keyword, platform, count(*) as total from posts group by all order by total desc, keyword, platform limit 20""")
def _(t: Tables):
    return dashboard.keyword_stats(t.posts())


@query("text_length_stats", f"""
select label, platform, count(*) as count, round(avg(length(text)), 4) as mean, round(stddev_samp(length(text)), 4) as stddev,
       cast(min(length(text)) as int) as min, cast(max(length(text)) as int) as max,
       quantile_disc(length(text), 0.25) as q1, quantile_disc(length(text), 0.5) as median,
       quantile_disc(length(text), 0.75) as q3, {_NAME} from posts group by label, platform""")
def _(t: Tables):
    stats = lengths.text_length_stats(t.posts())
    return stats.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


@query("topic_label_distribution", f"select topic, label, count(*) as count, {_NAME} from posts group by topic, label")
def _(t: Tables):
    return dashboard.topic_label_distribution(t.posts())


@query("source_label_distribution", f"select platform, label, count(*) as count, {_NAME} from posts group by platform, label")
def _(t: Tables):
    return dashboard.source_label_distribution(t.posts())


@query("source_topic_distribution", "select platform, topic, count(*) as count from posts group by all")
def _(t: Tables):
    return dashboard.source_topic_distribution(t.posts())


@query("summary_report", """
select 'total' as section, cast(1 as bigint) as rank, 'all' as key, count(*) as value from posts
union all select 'platform', row_number() over (order by platform), platform, count(*) from posts group by platform
union all select 'platform_label', row_number() over (order by concat(platform, '|', label)), concat(platform, '|', label), count(*)
  from posts group by platform, label
union all select 'label', row_number() over (order by cast(label as varchar)), cast(label as varchar), count(*) from posts group by label
union all select * from (
  select 'daily', row_number() over (order by crawl_date desc, concat(crawl_date, '|', platform)) as rn,
         concat(crawl_date, '|', platform), count(*) from posts group by crawl_date, platform) where rn <= 7
union all select * from (
  select 'keyword', row_number() over (order by count(*) desc, concat(keyword, '|', platform)) as rn,
         concat(keyword, '|', platform), count(*) from posts group by keyword, platform) where rn <= 10
union all select * from (
  select 'topic', row_number() over (order by count(*) desc, concat(topic, '|', platform)) as rn,
         concat(topic, '|', platform), count(*) from posts group by topic, platform) where rn <= 10""")
def _(t: Tables):
    return dashboard.summary_report(t.posts())


@query("recent_days", """
select crawl_date, platform, count(*) as total from posts group by all order by crawl_date desc, platform limit 7""")
def _(t: Tables):
    return dashboard.recent_days(t.posts())


@query("dashboard_kpis", """
select count(*) as total_records, count(distinct platform) as total_platforms, count(*) - count(*) filter (where label = -1) as total_labeled,
       count(*) filter (where label = -1) as total_unlabeled,
       round_even((count(*) - count(*) filter (where label = -1)) * 100.0::double / count(*), 1) as labeled_pct,
       round_even(count(*) filter (where label = -1) * 100.0::double / count(*), 1) as unlabeled_pct from posts""")
def _(t: Tables):
    return dashboard.dashboard_kpis(t.posts())


@query("crawl_timeline", """
select strftime(crawl_date, '%Y-%m') as month, count(*) filter (where platform = 'threads') as threads, count(*) filter (where platform = 'tiktok') as tiktok
from posts group by 1""")
def _(t: Tables):
    return dashboard.crawl_timeline(t.posts())


@query("topic_distribution", "select topic, count(*) as total from posts group by topic")
def _(t: Tables):
    return dashboard.topic_distribution(t.posts())


@query("topic_distribution_top", "select topic, count(*) as total from posts group by topic order by total desc, topic limit 10")
def _(t: Tables):
    return dashboard.topic_distribution(t.posts(), top_n=10)


@query("topic_label_heatmap", """
select topic, round_even(count(*) filter (where label = 0) / count(*) * 100.0::double, 1) as binh_thuong,
       round_even(count(*) filter (where label = 1) / count(*) * 100.0::double, 1) as offensive,
       round_even(count(*) filter (where label = 2) / count(*) * 100.0::double, 1) as hate_speech from posts group by topic""")
def _(t: Tables):
    return dashboard.topic_label_heatmap(t.posts())


@query("label_share", f"""
with c as (select label, count(*) as total from posts where label is distinct from -1 group by label)
select label, total, {_NAME}, round_even(total * 100.0::double / sum(total) over (), 1) as pct,
       least(round_even(total * 100.0::double / sum(total) over (), 1), 100.0::double) as bar_pct from c""")
def _(t: Tables):
    return dashboard.label_share(t.posts())


@query("source_label_pivot", """
select platform as source, nullif(count(*) filter (where label = 0), 0) as "bình_thường", nullif(count(*) filter (where label = 1), 0) as offensive,
       nullif(count(*) filter (where label = 2), 0) as hate_speech,
       nullif(count(*) filter (where label is null or label not in (-1, 0, 1, 2)), 0) as "không_xác_định"
from posts where label is distinct from -1 group by platform""")
def _(t: Tables):
    return dashboard.source_label_pivot(t.posts())


@query("boxplot_pivot", f"""
with s as (select label, platform, quantile_disc(length(text), 0.25) as q1, quantile_disc(length(text), 0.5) as median,
                  quantile_disc(length(text), 0.75) as q3, {_NAME} from posts where label is distinct from -1 group by label, platform)
select label_name, max(median) filter (platform = 'threads') as threads_median, max(q1) filter (platform = 'threads') as threads_q1,
       max(q3) filter (platform = 'threads') as threads_q3, max(median) filter (platform = 'tiktok') as tiktok_median,
       max(q1) filter (platform = 'tiktok') as tiktok_q1, max(q3) filter (platform = 'tiktok') as tiktok_q3
from s group by label_name""")
def _(t: Tables):
    return lengths.boxplot_pivot(t.posts())


@query("platform_profile", """
select platform, count(*) as total_records, min(crawl_date) as first_crawled, max(crawl_date) as last_crawled,
       count(*) filter (where lang = 'fr') as language_records, round_even(avg(length(text)), 1) as avg_char_count from posts group by platform""")
def _(t: Tables):
    return dashboard.platform_profile(t.posts(), lang="fr")


@query("dataset_split_stats", f"""
select split_set, platform, {_REGISTRY_NAME} as label_name, count(*) as record_count,
       round_even(avg({_TOKENS}), 1) as avg_token_count
from split_posts where label in (0, 1, 2) group by split_set, platform, label""", ("posts", "split_posts"))
def _(t: Tables):
    return dashboard.dataset_split_stats(_split(t))


@query("dataset_overview", f"""
with s as (select *, {_REGISTRY_NAME} as label_name from split_posts where label in (0, 1, 2)),
tot as (select split_set, count(*) as total_records, round(count(*) / sum(count(*)) over (), 4) as ratio from s group by split_set)
select split_set, total_records, ratio, 'platform' as kind, platform as name, count(*) as records
from s join tot using (split_set) group by all
union all
select split_set, total_records, ratio, 'label', label_name, count(*) from s join tot using (split_set) group by all""",
       ("posts", "split_posts"))
def _(t: Tables):
    return dashboard.dataset_overview_long(_split(t))


@query("platform_share", """
with c as (select platform, count(*) as total from posts group by platform)
select platform, total, cast(round_even(total * 100.0::double / sum(total) over (), 0) as bigint) as share_pct from c""")
def _(t: Tables):
    return dashboard.platform_share(t.posts())


@query("split_sizes", """
select platform, count(*) as total_samples, cast(round(count(*) * 0.8::double) as bigint) as train_samples,
       cast(round(count(*) * (1.0::double - 0.8::double)) as bigint) as test_samples from posts group by platform""")
def _(t: Tables):
    return dashboard.split_sizes(t.posts(), 0.8, ["platform"])


# ---- exploratory analysis -----------------------------------------------------------------

@query("eda_label_counts", """
with c as (select label, count(*) as count from posts where label is not null group by label),
s as (select *, count * 100.0::double / sum(count) over () as share from c)
select label, count, round(share, 4) as pct,
       case when share > 2 then printf('%.1f', round_even(share, 1)) || '%' else '' end as caption from s""")
def _(t: Tables):
    return exploration.eda_label_counts(t.posts())


@query("eda_source_counts", "select source, count(*) as count from posts where source is not null group by source")
def _(t: Tables):
    return exploration.eda_source_counts(t.posts())


@query("eda_topic_counts", "select topic, count(*) as count from posts where topic is not null group by topic")
def _(t: Tables):
    return exploration.eda_topic_counts(t.posts())


def _box_sql(by: str, source: str = "posts") -> str:
    keys = f"{by}, " if by else ""
    group = f"group by {by}" if by else ""
    same = " and ".join(f"h.{k.strip()} = f.{k.strip()}" for k in by.split(",")) if by else "true"
    picked = ", ".join(f"h.{k.strip()}" for k in by.split(",")) + ", " if by else ""
    return f"""
h as (select {keys}length(text) as len from {source} where text is not null),
f as (select *, q1 - 1.5 * (q3 - q1) as low_fence, q3 + 1.5 * (q3 - q1) as high_fence from (
  select {keys}count(*) as count, quantile_cont(len, 0.25) as q1, quantile_cont(len, 0.5) as median,
         quantile_cont(len, 0.75) as q3 from h {group}))
select {picked}f.count, round(q1, 4) as q1, round(median, 4) as median, round(q3, 4) as q3, round(low_fence, 4) as low_fence,
       round(high_fence, 4) as high_fence, cast(min(len) filter (len between low_fence and high_fence) as int) as whisker_low,
       cast(max(len) filter (len between low_fence and high_fence) as int) as whisker_high,
       count(*) filter (where len not between low_fence and high_fence) as outliers
from h join f on {same} group by all"""


def _rounded_box(df):
    return df.withColumns({c: F.round(c, 4) for c in ("q1", "median", "q3", "low_fence", "high_fence")})


@query("length_box_overall", "with " + _box_sql(""))
def _(t: Tables):
    return _rounded_box(lengths.length_box_overall(t.posts()))


@query("length_box_by_label", "with " + _box_sql("label"))
def _(t: Tables):
    return _rounded_box(lengths.length_box_by_label(t.posts()))


@query("length_box_by_source", "with " + _box_sql("source"))
def _(t: Tables):
    return _rounded_box(lengths.length_box_by_source(t.posts()))


@query("length_box_source_label", "with " + _box_sql("source, label"))
def _(t: Tables):
    return _rounded_box(lengths.length_box_source_label(t.posts()))


@query("length_box_topic_label", """with top as (
  select * from posts where topic in (select topic from posts group by topic order by count(*) desc, topic limit 10)),"""
       + _box_sql("topic, label", "top"))
def _(t: Tables):
    return _rounded_box(lengths.length_box_topic_label(t.posts()))


@query("source_label_counts", "select source, label, count(*) as count from posts group by all")
def _(t: Tables):
    return exploration.source_label_counts(t.posts())


@query("topic_label_counts", "select topic, label, count(*) as count from posts group by all")
def _(t: Tables):
    return exploration.topic_label_counts(t.posts())


@query("source_topic_counts", "select source, topic, count(*) as count from posts group by all")
def _(t: Tables):
    return exploration.source_topic_counts(t.posts())


@query("source_label_pct", """
select source, l.label, round(count(*) filter (where p.label = l.label) * 100.0::double / count(*), 4) as percentage
from posts p, (select unnest([-1, 0, 1, 2]) as label) l where source in ('threads', 'tiktok') group by source, l.label""")
def _(t: Tables):
    return exploration.source_label_pct(t.posts())


@query("topic_label_pct", """
select topic, round(count(*) filter (where label = -1) * 100.0::double / count(*), 4) as label_minus_1,
       round(count(*) filter (where label = 0) * 100.0::double / count(*), 4) as label_0,
       round(count(*) filter (where label = 1) * 100.0::double / count(*), 4) as label_1,
       round(count(*) filter (where label = 2) * 100.0::double / count(*), 4) as label_2 from posts group by topic""")
def _(t: Tables):
    return exploration.topic_label_pct(t.posts())


@query("topic_source_label_pct", """
with cells as (select topic, source, l.label, round(count(*) filter (where p.label = l.label) * 100.0::double / count(*), 4) as pct
               from posts p, (select unnest([-1, 0, 1, 2]) as label) l group by topic, source, l.label)
select label, topic, max(pct) filter (source = 'threads') as threads, max(pct) filter (source = 'tiktok') as tiktok
from cells group by label, topic""")
def _(t: Tables):
    return exploration.topic_source_label_pct(t.posts())


@query("median_length_matrix", """
with m as (select source, topic, label, median(length(text)) as med from posts group by all)
select source, topic, max(med) filter (label = -1) as label_minus_1, max(med) filter (label = 0) as label_0,
       max(med) filter (label = 1) as label_1, max(med) filter (label = 2) as label_2 from m group by source, topic""")
def _(t: Tables):
    return lengths.median_length_matrix(t.posts())


@query("share_of_total", """
select topic, label, count(*) as count, round(count(*) * 100.0::double / sum(count(*)) over (partition by topic), 4) as pct
from posts group by topic, label""")
def _(t: Tables):
    shares = exploration.share_of_total(exploration.topic_label_counts(t.posts()), ["topic"])
    return shares.withColumn("pct", F.round("pct", 4))


def _ngram_sql(by: str, sizes: tuple[int, ...]) -> str:
    keys = f"{by}, " if by else ""
    followed = ", ".join(f"lead(w1, {n - 1}) over (partition by id order by pos) as w{n}" for n in range(2, max(sizes) + 1))
    grams = " union all ".join(
        f"select {keys}{n} as n, concat_ws(' ', {', '.join(f'w{i}' for i in range(1, n + 1))}) as ngram from f where w{n} is not null"
        for n in sizes
    )
    return rf"""
with w as (select id, {keys}list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') as words from posts),
e as (select id, {keys}unnest(words) as w1, unnest(range(len(words))) as pos from w),
f as (select *{', ' if followed else ''}{followed} from e),
g as ({grams}),
c as (select {keys}n, ngram, count(*) as count from g group by all)
select {keys}n, ngram, count, cast(rank as int) as rank from (
  select *, row_number() over (partition by {keys}n order by count desc, ngram) as rank from c) where rank <= 20"""


@query("ngrams_global", _ngram_sql("", (1, 2, 3)))
def _(t: Tables):
    return ngrams.ngrams_global(t.posts())


@query("ngrams_by_label", _ngram_sql("label", (1, 2, 3)))
def _(t: Tables):
    return ngrams.ngrams_by_label(t.posts())


@query("ngrams_by_source", _ngram_sql("source", (1, 2, 3)))
def _(t: Tables):
    return ngrams.ngrams_by_source(t.posts())


@query("unigrams_label_source", _ngram_sql("label, source", (1,)))
def _(t: Tables):
    return ngrams.unigrams_label_source(t.posts())


@query("unigrams_topic_label", _ngram_sql("topic, label", (1,)))
def _(t: Tables):
    return ngrams.unigrams_topic_label(t.posts())


# ---- reports from kept tables: the same answers as a full count ---------------------------

def _kept(t: Tables) -> KeptReports:
    """Three loads: posts before March, a third of them without their label; the later posts; the missing labels."""
    posts = t.posts()
    kept = KeptReports(t.spark, new_dir(t.spark, "kept"))
    early = F.col("crawl_date") < F.lit("2024-03-01").cast("date")
    waiting = posts.filter(early & (F.col("id") % 3 == 0))
    unlabelled = waiting.withColumn("label", F.lit(-1))
    kept.load(posts.filter(early & (F.col("id") % 3 != 0)).unionByName(unlabelled), 1)
    kept.load(posts.filter(~early), 2)
    kept.load(waiting, 3, removed=unlabelled)
    return kept


@query("kept_summary_report", REGISTRY["summary_report"].sql, ())
def _(t: Tables):
    return dashboard.summary_report(_kept(t).counts())


@query("kept_dashboard_kpis", REGISTRY["dashboard_kpis"].sql, ())
def _(t: Tables):
    return dashboard.dashboard_kpis(_kept(t).counts())


@query("kept_text_length_stats", REGISTRY["text_length_stats"].sql, ())
def _(t: Tables):
    stats = lengths.text_length_stats(_kept(t).lengths())
    return stats.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})
