"""Registered queries: stored pages, corpus preparation and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from commentflow.operators import corpus, pages
from commentflow.operators.inference import lexicon_column
from commentflow.operators.joins import DIGEST, row_digest
from commentflow.operators.pages import ATTRIBUTE, HREF, LINK
from commentflow.operators.sampling import train_test_split
from commentflow.plans.registry import query
from commentflow.plans.scratch import new_dir, stored
from commentflow.plans.tables import LEXICON, Tables, entities_sql, tokens_sql
from commentflow.streaming import counts, ingest, moderation, routing
from commentflow.streaming.sinks import read_sink

ONCE = {"availableNow": True}


def _anchors_sql(keep: str, cap: str) -> str:
    href = entities_sql("regexp_replace(h, '^[\"'']|[\"'']$', '', 'g')")
    attribute, tokens = ATTRIBUTE.replace("'", "''"), tokens_sql("html")
    return f"""
with t as (select page_id, list_filter({tokens}, lambda t: regexp_matches(t, '{LINK}')) as links from pages),
n as (select page_id, list_transform(links, lambda t: list_filter(regexp_extract_all(t, '{attribute}'), lambda a: regexp_matches(a, '{HREF}'))[1]) as named from t),
a as (select page_id, list_transform(list_filter(named, lambda a: a is not null), lambda a: regexp_replace(a, '{HREF}', '')) as raw from n),
h as (select page_id, list_transform(raw, lambda h: {href}) as hrefs from a),
k as (select page_id, list_filter(hrefs, lambda h: {keep}) as hrefs from h),
e as (select page_id, unnest(hrefs) as href, unnest(range(len(hrefs))) as pos from k),
u as (select page_id, case when starts_with(href, 'http') then href else concat('https://www.tiktok.com', href) end as url, pos from e),
d as (select page_id, url, row_number() over (partition by page_id order by min(pos)) - 1 as position from u group by page_id, url)
select page_id, cast(position as int) as position, url from d{cap}"""


@query("extract_anchors", _anchors_sql("true", ""), ())
def _(t: Tables):
    return pages.extract_anchors(t.table("pages"))


@query("extract_anchors_rooted", _anchors_sql("starts_with(h, '/')", " where position < 10"), ())
def _(t: Tables):
    return pages.extract_anchors(t.table("pages"), pattern="^/", cap=10)


@query("extract_segments", "select page_id, url, cast(position as int) as position, text from segments", ("paragraphs", "segments"))
def _(t: Tables):
    return pages.extract_segments(t.table("pages"))


@query("clean_crawl", "select text, topic, keyword, url from crawl", ("paragraphs", "segments", "crawl"))
def _(t: Tables):
    return pages.clean_crawl(t.table("pages"))


@query("clean_crawl_plain", """
with s as (select * from paragraphs where length(text) >= 3),
once as (select *, row_number() over (partition by url, text order by page_id, position) as r1 from s),
capped as (select *, row_number() over (partition by url order by page_id, position) as r2 from once where r1 = 1),
firsts as (select *, row_number() over (partition by lower(left(text, 80)) order by page_id, position) as r3 from capped where r2 <= 500)
select text, regexp_extract(url, '^https?://([^/?#]+)', 1) as topic, regexp_extract(url, '^https?://[^/?#]+/([^/?#]*)', 1) as keyword, url
from firsts where r3 = 1""", ("paragraphs",))
def _(t: Tables):
    return pages.clean_crawl(t.table("pages"), shortest=3, interface_rules=False)


@query("crawl_totals", "select topic, keyword, url, count(*) as total from crawl group by all", ("paragraphs", "segments", "crawl"))
def _(t: Tables):
    return pages.crawl_totals(pages.clean_crawl(t.table("pages")))


# ---- corpus -------------------------------------------------------------------------------

_WORDS = r"list_slice(list_filter(string_split_regex(text, '\s+'), lambda x: x <> ''), 1, 256)"
_PACKED = f"""
with w as (select id, {_WORDS} as words, row_number() over (order by id) - 1 as rk from posts),
j as (select rk // 1000 as batch, flatten(list(words order by rk)) as toks from w group by 1)"""


@query("tokenize_truncate", f"""
select id, array_to_string({_WORDS}, ' ') as tokens, cast(len({_WORDS}) as int) as token_count from posts""")
def _(t: Tables):
    rows = corpus.tokenize_truncate(t.posts().select("id", "text"))
    return rows.select("id", F.array_join("tokens", " ").alias("tokens"), "token_count")


@query("pack_chunks", f"""
with w as (select id, {_WORDS} as words, row_number() over (order by id) - 1 as rk from posts),
e as (select rk // 1000 as batch, rk, unnest(words) as word, unnest(range(len(words))) as pos from w),
n as (select batch, word, row_number() over (partition by batch order by rk, pos) - 1 as seq from e)
select batch, cast(seq // 256 as int) as block, string_agg(word, ' ' order by seq) as tokens
from n group by batch, seq // 256 having count(*) = 256""")
def _(t: Tables):
    packed = corpus.pack_chunks(t.posts().select("id", "text"))
    return packed.select("batch", "block", F.array_join("tokens", " ").alias("tokens"))


@query("corpus_stats", f"""{_PACKED}
select (select count(*) from w) as samples, (select cast(sum(len(words)) as bigint) from w) as tokens,
       (select cast(sum(len(toks) // 256) as bigint) from j) as chunks,
       count(*) filter (where h >= 1) as train_rows, count(*) filter (where h < 1) as test_rows
from (select cast('0x' || substr(md5(cast(id as varchar)), 1, 8) as bigint) % 100 as h from posts)""")
def _(t: Tables):
    return corpus.corpus_stats(t.posts().select("id", "text"))


@query("train_test_split", "select id, split_set from split_posts", ("posts", "split_posts"))
def _(t: Tables):
    return train_test_split(t.posts(), 20).select("id", "split_set")


# ---- streams ------------------------------------------------------------------------------

def lexicon_sql(expr: str) -> str:
    """Highest label among the listed words of a text."""
    def found(label: int) -> str:
        words = "|".join(w for w, v in LEXICON.items() if v == label)
        return rf"regexp_matches(concat(' ', lower({expr}), ' '), '[^\p{{L}}\p{{N}}_](?:{words})[^\p{{L}}\p{{N}}_]')"

    return f"case when {found(2)} then 2 when {found(1)} then 1 else 0 end"


_CLEAN = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"


def _stream(t: Tables, name: str):
    # A glob, because a stream takes a plain path for a directory and the table may be one file.
    return t.spark.readStream.schema(t.table(name).schema).parquet(t.path(f"{{{name}}}"))


@query("stream_moderation", f"""
select conv_id, turn, {lexicon_sql('text')} as predicted_label, {lexicon_sql('text')} in (1, 2) as is_target
from conversations where {_CLEAN} <> ''""", ())
def _(t: Tables):
    timed = _stream(t, "conversations").withColumn("ts", F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id")))
    sink, checkpoint = new_dir(t.spark, "flagged"), new_dir(t.spark, "flagged-state")
    moderation.stream_moderation(
        timed, sink, checkpoint, lexicon_column(LEXICON), ["conv_id", "turn"], trigger=ONCE
    ).awaitTermination()
    return t.spark.read.parquet(sink).select("conv_id", "turn", "predicted_label", "is_target")


_DELAY = 10  # seconds


@query("stream_moderation_routed", f"""
with timed as (
    select conv_id, turn, text, 1704067200 + conv_id as moment, (conv_id * 4) // (max(conv_id) over () + 1) as part from conversations),
arrived as (
    select * replace (case when conv_id % 11 = 0 then 3 else part end as part) from timed
    union all select * replace (part + 1 as part) from timed where conv_id % 7 = 0 and conv_id % 11 <> 0 and part < 3),
tops as (select part, max(max(moment)) over (order by part rows between unbounded preceding and 1 preceding) as top from arrived where {_CLEAN} <> '' group by part),
judged as (
    select a.*, coalesce(moment <= top - {_DELAY}, false) as late from arrived a left join tops using (part) where {_CLEAN} <> ''),
routed as (
    select *, case when late then 'late' when row_number() over (partition by conv_id, turn, late order by part) = 1 then 'kept' else 'repeated' end as route
    from judged)
select conv_id, turn, cast(part as int) as part, route, case when route = 'kept' then {lexicon_sql('text')} end as predicted_label from routed""", ())
def _(t: Tables):
    """Four arrivals, one a micro-batch: some comments come again in the next one, some only in the last."""
    spark, said = t.spark, t.table("conversations")
    size = said.agg(F.max("conv_id")).first()[0] + 1
    late = F.col("conv_id") % 11 == 0
    part = F.floor(F.col("conv_id") * 4 / size).cast("int")
    timed = said.select("conv_id", "turn", "text", F.timestamp_seconds(F.lit(1704067200) + F.col("conv_id")).alias("ts"),
                        F.when(late, F.lit(3)).otherwise(part).alias("part"))
    again = timed.filter((F.col("conv_id") % 7 == 0) & ~late & (F.col("part") < 3)).withColumn("part", F.col("part") + 1)
    arrived = stored(timed.unionByName(again), "arrived")
    source = new_dir(spark, "arriving")
    sink, rest, checkpoint = (new_dir(spark, name) for name in ("routed", "rest", "routed-state"))
    for k in range(4):  # the stream goes on from its checkpoint; an arrival has as many files as tasks
        arrived.filter(F.col("part") == k).write.mode("append").parquet(source)
        routing.stream_moderation_routed(
            spark.readStream.schema(arrived.schema).parquet(source), sink, rest, checkpoint, lexicon_column(LEXICON),
            ["conv_id", "turn"], delay=f"{_DELAY} seconds", trigger=ONCE
        ).awaitTermination()
    columns = ["conv_id", "turn", "part", "route", "predicted_label"]
    kept = read_sink(spark, sink).withColumn("route", F.lit(routing.KEPT)).select(*columns)
    return kept.unionByName(read_sink(spark, rest).withColumn("predicted_label", F.lit(None).cast("int")).select(*columns))


@query("stream_ingest_dedup", rf"""
with d as (select doc_id, {_CLEAN} as cut, source, lang from documents),
s as (select d.* from d join labels using (doc_id))
select doc_id, source, lang from d
where not exists (select 1 from s where s.cut = d.cut and s.source = d.source and s.lang = d.lang)""", ())
def _(t: Tables):
    documents = t.table("documents")
    labelled = documents.join(t.table("labels").select("doc_id"), "doc_id", "left_semi")
    keys = ("text", "source", "lang")
    known = stored(labelled.select(row_digest(keys).alias(DIGEST)), "known-digests")
    sink, checkpoint = new_dir(t.spark, "loaded"), new_dir(t.spark, "loaded-state")
    ingest.stream_ingest_dedup(
        _stream(t, "documents"), sink, checkpoint, stored=known, keys=keys, trigger=ONCE
    ).awaitTermination()
    return read_sink(t.spark, sink).select("doc_id", "source", "lang")


@query("stream_daily_count", """
select cast(ts as date) as crawl_date, event_type, count(*) as total from events group by all""", ())
def _(t: Tables):
    timed = _stream(t, "events").withColumn("ts", counts.utc_instant(F.col("ts")))
    sink, checkpoint = new_dir(t.spark, "daily"), new_dir(t.spark, "daily-state")
    counts.stream_daily_count(timed, sink, checkpoint, ["event_type"], trigger=ONCE).awaitTermination()
    return counts.latest_counts(t.spark, sink, ["event_type"])
