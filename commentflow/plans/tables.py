"""Views over the given tables in the shapes the operators work on."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commentflow.functions.text import SPACE_CLASS
from commentflow.operators import joins
from commentflow.operators.filters import COUNTER, RELATIVE_TIME, REPLY_PREFIX, UI_CAPTIONS
from commentflow.operators.pages import CLOSES, ENTITIES, NUMERIC_ENTITY, OPENS, TOKEN
from commentflow.operators.sampling import stratified_kfold
from commentflow.plans.scratch import scratch_root
from commentflow.schema import CLASSES
from commentflow.sources.paths import parquet_or_none
from commentflow.sources.readers import scan_all
from commentflow.sources.writers import write_comments

MODELS = ("model_a", "model_b", "llm")
LEXICON = {
    "idiot": 1, "moron": 1, "stupid": 1, "clown": 1, "loser": 1,
    "scum": 2, "trash": 2, "worthless": 2, "pathetic": 2, "disgusting": 2,
}

def tokens_sql(html: str) -> str:
    return f"regexp_extract_all({html}, '{TOKEN.replace(chr(39), chr(39) * 2)}')"


_SHOWN = f"""case when t[1] <> '<' or length(t) = 1 then t
when regexp_matches(t, '{OPENS}') then chr(1) when regexp_matches(t, '{CLOSES}') then chr(2) else '' end"""


def entities_sql(expr: str) -> str:
    """Character references decoded in the checking dialect."""
    for name, char in ENTITIES:
        expr = f"replace({expr}, '&{name};', '{char.replace(chr(39), chr(39) * 2)}')"
    code = "string_split(p, ';')[1]"
    number = f"cast(case when lower({code}[1]) = 'x' then concat('0x', {code}[2:]) else {code} end as int)"
    char = f"case when {number} between 1 and 55295 or {number} between 57344 and 1114111 then chr({number}) else chr(65533) end"
    return (
        f"replace(array_to_string(list_transform(string_split({expr}, '&#'), lambda p, i: case when i = 1 then p "
        f"when regexp_matches(p, '{NUMERIC_ENTITY}') then concat({char}, substr(p, strpos(p, ';') + 1)) else concat('&#', p) end), ''), '&amp;', '&')")


# The same views in the checking dialect.
CTES = {
    "posts": """
select d.doc_id as id, d.text, d.source as topic, concat(d.source, '_', d.lang) as keyword,
       concat('https://site.example/', d.source, '/video/', d.doc_id % 211) as url,
       case when l.doc_id is null then -1
            when l.toxic = 1 and l.quality = 0 then 2
            when l.toxic = 1 then 1 else 0 end as label,
       case when d.doc_id % 2 = 0 then 'tiktok' else 'threads' end as platform,
       case when d.doc_id % 2 = 0 then 'tiktok' else 'threads' end as source,
       cast(date '2024-01-01' + cast(d.doc_id % 180 as int) as date) as crawl_date,
       d.lang
from documents d left join labels l on d.doc_id = l.doc_id""",
    "voters": """
select id, label, platform, topic,
       case when ha % 10 < 8 then base else cast(ha // 16 % 3 as int) end as model_a,
       case when hb % 10 < 7 then base else cast(hb // 16 % 3 as int) end as model_b,
       case when hc % 10 < 6 then base else cast(hc // 16 % 4 as int) - 1 end as llm
from (select *, greatest(label, 0) as base,
             cast('0x' || substr(md5(concat(id, '-model_a')), 1, 8) as bigint) as ha,
             cast('0x' || substr(md5(concat(id, '-model_b')), 1, 8) as bigint) as hb,
             cast('0x' || substr(md5(concat(id, '-llm')), 1, 8) as bigint) as hc
      from posts)""",
    "folds": """
select *, cast((row_number() over (partition by label order by md5(concat(id, '-42')), id) - 1) % 5 as int) as fold
from voters where label in (0, 1, 2)""",
    "oof": """
select id, label, fold, 'model_a' as model, model_a as prediction from folds
union all select id, label, fold, 'model_b', model_b from folds
union all select id, label, fold, 'llm', llm from folds""",
    "split_posts": """
select *, case when cast('0x' || substr(md5(cast(id as varchar)), 1, 8) as bigint) % 100 < 20
               then 'test' else 'train' end as split_set
from posts""",
    "paragraphs": f"""
select page_id, url, position, regexp_replace({entities_sql("string_split(raw, chr(2))[1]")}, '^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$', '', 'g') as text
from (
  select page_id, url, unnest(parts) as raw, unnest(range(len(parts))) as position
  from (
    select page_id, url, string_split(array_to_string(list_transform({tokens_sql("translate(html, chr(1) || chr(2), '')")}, lambda t: {_SHOWN}), ''), chr(1))[2:] as parts
    from pages))""",
    "segments": f"""
select page_id, url, position, text from paragraphs
where text <> ''
  and text not in ({", ".join(f"'{c}'" for c in UI_CAPTIONS)})
  and not starts_with(text, '{REPLY_PREFIX}')
  and not regexp_matches(text, '{RELATIVE_TIME}')
  and not regexp_matches(lower(text), '{COUNTER}')
  and length(text) >= 5""",
}
CRAWL_CTES = {
    "crawl": r"""
select text, regexp_extract(url, '^https?://([^/?#]+)', 1) as topic,
       regexp_extract(url, '^https?://[^/?#]+/([^/?#]*)', 1) as keyword, url
from (select *, row_number() over (partition by lower(left(text, 80)) order by page_id, position) as same
      from (select *, row_number() over (partition by url order by page_id, position) as nth
            from (select *, row_number() over (partition by url, text order by page_id, position) as dup
                  from segments)
            where dup = 1)
      where nth <= 500)
where same = 1""",
}
CTES.update(CRAWL_CTES)


def hash32(col: Column) -> Column:
    """First 32 bits of an md5, the same number in every engine."""
    return F.conv(F.substring(F.md5(col), 1, 8), 16, 10).cast("bigint")


_STORES: dict[tuple[str, str], str] = {}


class Tables:
    """The given tables under one directory and the views derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def posts(self) -> DataFrame:
        """Comments: documents with a label where one was given."""
        return self.shape(self.table("documents").join(self.table("labels"), "doc_id", "left"), self.label())

    def dealt_posts(self) -> DataFrame:
        """The same comments, in tasks by the directories of the store: texts are moved once, whatever the size of the labels."""
        docs = joins.left_join_dealt(self.table("documents"), self.table("labels"), "doc_id", self.directories())
        return self.shape(docs, self.label())

    def label(self) -> Column:
        return (
            F.when(F.col("toxic").isNull() & F.col("quality").isNull(), -1)
            .when((F.col("toxic") == 1) & (F.col("quality") == 0), 2)
            .when(F.col("toxic") == 1, 1)
            .otherwise(0)
        )

    def directories(self) -> dict[str, Column]:
        key = F.col("doc_id")
        return {
            "platform": F.when(key % 2 == 0, "tiktok").otherwise("threads"),
            "crawl_date": F.date_add(F.lit("2024-01-01").cast("date"), (key % 180).cast("int")),
        }

    def shape(self, docs: DataFrame, label: Column) -> DataFrame:
        key, at = F.col("doc_id"), self.directories()
        return docs.select(
            key.alias("id"),
            "text",
            F.col("source").alias("topic"),
            F.concat_ws("_", "source", "lang").alias("keyword"),
            F.concat(F.lit("https://site.example/"), "source", F.lit("/video/"), (key % 211).cast("string")).alias("url"),
            label.alias("label"),
            at["platform"].alias("platform"),
            at["platform"].alias("source"),
            at["crawl_date"].alias("crawl_date"),
            "lang",
        )

    def voters(self) -> DataFrame:
        """Comments with the labels of three imperfect models."""
        base = F.greatest("label", F.lit(0))
        accuracy = {"model_a": 8, "model_b": 7, "llm": 6}

        def vote(model: str) -> Column:
            h = hash32(F.concat(F.col("id").cast("string"), F.lit(f"-{model}")))
            noise = F.floor(h / 16) % (4 if model == "llm" else 3) - (1 if model == "llm" else 0)
            return F.when(h % 10 < accuracy[model], base).otherwise(noise.cast("int"))

        return self.posts().select("id", "label", "platform", "topic", *[vote(m).alias(m) for m in MODELS])

    def folds(self) -> DataFrame:
        return stratified_kfold(self.voters().filter(F.col("label").isin(*CLASSES)))

    def oof(self) -> DataFrame:
        """Out-of-fold predictions in long form."""
        return self.folds().select("id", "label", "fold", *MODELS).unpivot(
            ["id", "label", "fold"], list(MODELS), "model", "prediction"
        )

    def store_root(self) -> str:
        """The comments written once per application as a partitioned store."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _STORES:
            digest = hashlib.md5(self.sf_dir.encode()).hexdigest()[:12]
            root = f"{scratch_root(self.spark)}/store-{digest}"
            if parquet_or_none(self.spark, root) is None:
                posts = self.dealt_posts().withColumn("id", F.col("id").cast("string"))
                write_comments(posts, root, mode="overwrite", dealt=True)
            _STORES[key] = root
        return _STORES[key]

    def stored_posts(self) -> DataFrame:
        """The comments of the store, for queries that need the texts more than once or write them again."""
        return scan_all(self.spark, self.store_root()).withColumn("id", F.col("id").cast("bigint"))
