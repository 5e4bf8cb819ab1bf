"""Registered queries: text, label, link and counter functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from commentflow.functions import labels, links, text
from commentflow.functions.text import TONE_MARKS
from commentflow.plans.registry import query
from commentflow.plans.tables import Tables
from commentflow.sources.readers import scan_all

_VALID_EXTRA = "À-ɏḀ-ỿ̀-ͯ"
_EMOJI = ("\U0001f600-\U0001f64f\U0001f300-\U0001f5ff\U0001f680-\U0001f6ff\U0001f700-\U0001f77f\U0001f780-\U0001f7ff"
          "\U0001f800-\U0001f8ff\U0001f900-\U0001f9ff\U0001fa00-\U0001fa6f\U0001fa70-\U0001faff"
          "☀-⛿✀-➿︀-️\U0001f1e0-\U0001f1ff‍⃣")
_SPACES = r"\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{0b}"


def _tone(expr: str) -> str:
    for old, new in TONE_MARKS.items():
        expr = f"replace({expr}, '{old}', '{new}')"
    return expr


def _strip_emoji(expr: str) -> str:
    return f"regexp_replace({expr}, '[{_EMOJI}]', ' ', 'g')"


def _strip_invalid(expr: str) -> str:
    return rf"regexp_replace({expr}, '[^\p{{L}}\p{{N}}_{_SPACES}{_VALID_EXTRA}]', ' ', 'g')"


def _strip_punct(expr: str) -> str:
    return rf"regexp_replace({expr}, '[!-/:-@\[-`{{-~]', ' ', 'g')"


def _collapse(expr: str) -> str:
    return rf"trim(regexp_replace({expr}, '[{_SPACES}]+', ' ', 'g'))"


def _sentence(expr: str) -> str:
    return _collapse(_strip_punct(_strip_invalid(_strip_emoji(expr))))


def _over_documents(key: str, sql_expr: str, column) -> None:
    """Register a text function over every document."""

    @query(key, f"select doc_id, {sql_expr} as value from documents", ())
    def _(t: Tables):
        return t.table("documents").select("doc_id", column(F.col("text")).alias("value"))


# Documents are composed already, so each is taken apart on the way in: accents become combining marks.
_APART = [("é", "é"), ("è", "è"), ("ê", "ê"), ("ç", "ç"), ("ü", "ü"), ("ñ", "ñ")]


def _decomposed(column):
    for whole, parts in _APART:
        column = F.replace(column, F.lit(whole), F.lit(parts))
    return column


def _decomposed_sql(expr: str) -> str:
    for whole, parts in _APART:
        expr = f"replace({expr}, '{whole}', '{parts}')"
    return expr


_over_documents("nfc", f"nfc_normalize({_decomposed_sql('text')})", lambda c: text.nfc(_decomposed(c)))
_over_documents("lowercase", "lower(text)", text.lowercase)
_over_documents("tone_marks", _tone("lower(text)"), lambda c: text.tone_marks(text.lowercase(c)))
_over_documents("strip_emoji", _strip_emoji("text"), text.strip_emoji)
_over_documents("strip_invalid", _strip_invalid("text"), text.strip_invalid)
_over_documents("strip_punctuation", _strip_punct("text"), text.strip_punctuation)
_over_documents("collapse_ws", _collapse("text"), text.collapse_ws)
_over_documents("normalize_sentence", _sentence("text"), text.normalize_sentence)
_over_documents("preprocess", f"coalesce({_sentence(_tone('lower(nfc_normalize(text))'))}, '')", text.preprocess)
_over_documents("text_length", "cast(length(text) as int)", text.text_length)


@query("preprocess_table", f"""
select doc_id, text as text_original, coalesce({_sentence(_tone('lower(nfc_normalize(text))'))}, '') as text from documents""", ())
def _(t: Tables):
    return text.preprocess_table(t.table("documents").select("doc_id", "text"))


# Captions are put behind the texts the crawl would have left them on.
_CAPTIONED = "case when lang = 'en' then concat(text, ' Translate') else text end"


@query("strip_translate_suffix", rf"""
with c as (select doc_id, lower({_CAPTIONED}) as text from documents)
select doc_id, case when ends_with(regexp_replace(text, '^[{_SPACES}]+|[{_SPACES}]+$', '', 'g'), 'translate')
  then regexp_replace(regexp_replace(text, '[{_SPACES}]*translate[{_SPACES}]*$', ''), '^[{_SPACES}]+|[{_SPACES}]+$', '', 'g')
  else text end as value,
  ends_with(regexp_replace(text, '^[{_SPACES}]+|[{_SPACES}]+$', '', 'g'), 'translate') as affected from c""", ())
def _(t: Tables):
    captioned = F.when(F.col("lang") == "en", F.concat("text", F.lit(" Translate"))).otherwise(F.col("text"))
    lowered = t.table("documents").select("doc_id", F.lower(captioned).alias("text"))
    return lowered.select("doc_id", text.strip_translate_suffix(F.col("text")).alias("value"),
                          text.has_translate_suffix(F.col("text")).alias("affected"))


# Frequent words of the documents stand in for chat abbreviations.
SLANG = {"the": "cái", "of": "của", "les": "những", "und": "và", "los": "các"}


def _slang_sql() -> str:
    """Word by word: cut at the borders between word and other characters, swap, put together again."""
    cases = " ".join(f"when '{k}' then '{v}'" for k, v in SLANG.items())
    return rf"""list_transform(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]+'),
        lambda x: case lower(x) {cases} else x end)"""


@query("teencode", f"""
select doc_id, array_to_string({_slang_sql()}, '') as value, array_to_string({_slang_sql()}, '') <> text as changed
from documents""", ())
def _(t: Tables):
    swapped = t.table("documents").select("doc_id", "text", text.teencode(F.col("text"), SLANG).alias("value"))
    return swapped.select("doc_id", "value", (F.col("value") != F.col("text")).alias("changed"))


# ---- labels -------------------------------------------------------------------------------

def _answer_text():
    """Model answers: some tagged, some tagged twice, some with loose digits, some without any."""
    key = F.col("doc_id")
    tag = F.concat(F.lit(" [LABEL: "), (key % 5).cast("string"), F.lit("]"))
    return F.when(key % 4 == 0, F.concat("text", tag)).when(
        key % 4 == 1, F.concat(F.lit("[LABEL:1] "), "text", tag)).when(
        key % 4 == 2, F.concat("text", F.lit(" = "), key.cast("string"))).otherwise(F.col("text"))


_ANSWER = """case doc_id % 4 when 0 then concat(text, ' [LABEL: ', doc_id % 5, ']')
  when 1 then concat('[LABEL:1] ', text, ' [LABEL: ', doc_id % 5, ']')
  when 2 then concat(text, ' = ', doc_id) else text end"""
_PARSED = r"""coalesce(cast(coalesce(regexp_extract_all(raw, '\[LABEL:\s*([012])\]', 1)[-1],
  nullif(regexp_extract(raw, '(?s)^.*([012])', 1), '')) as int), -1)"""


@query("parse_llm_label", f"with a as (select doc_id, {_ANSWER} as raw from documents) select doc_id, {_PARSED} as label from a", ())
def _(t: Tables):
    return t.table("documents").select("doc_id", labels.parse_llm_label(_answer_text()).alias("label"))


@query("unparsed_to_clean", "select id, case when llm = -1 then 0 else llm end as label from voters", ("posts", "voters"))
def _(t: Tables):
    return t.voters().select("id", labels.unparsed_to_clean(F.col("llm")).alias("label"))


@query("map_text_label", """
with n as (select doc_id, case when quality = 0 and toxic = 1 then ' Hate ' when toxic = 1 then 'hate-offensive'
                               when quality = 0 then 'off' else 'clean' end as name from labels)
select doc_id, case when upper(name) like '%HATE%' and upper(name) not like '%OFFENSIVE%' then 2
                    when upper(name) like '%OFF%' then 1 else 0 end as label from n""", ())
def _(t: Tables):
    name = F.when((F.col("quality") == 0) & (F.col("toxic") == 1), " Hate ").when(
        F.col("toxic") == 1, "hate-offensive").when(F.col("quality") == 0, "off").otherwise("clean")
    return t.table("labels").select("doc_id", labels.map_text_label(name).alias("label"))


@query("label_name", """
select id, case label when -1 then 'chưa gán nhãn' when 0 then 'bình thường' when 1 then 'offensive'
 when 2 then 'hate speech' else 'không xác định' end as label_name from posts""")
def _(t: Tables):
    return t.posts().select("id", labels.label_name(F.col("label")).alias("label_name"))


@query("argmax_label", """
select vec_id, cast(list_position(embedding, list_max(embedding)) - 1 as int) as label from embeddings""", ())
def _(t: Tables):
    return t.table("embeddings").select("vec_id", labels.argmax_label(F.col("embedding")).alias("label"))


SYSTEM = "Classify the comment and end with its label."


@query("build_prompt", f"""
select conv_id, turn, concat('system=', '{SYSTEM}', '|user=Bình luận: ''', text, '''') as messages,
       concat('hate-speech-detection: ', text) as seq2seq from conversations""", ())
def _(t: Tables):
    messages = labels.build_prompt(F.col("text"), SYSTEM)
    flat = F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit("="), m["content"])), "|")
    return t.table("conversations").select(
        "conv_id", "turn", flat.alias("messages"), labels.seq2seq_prompt(F.col("text")).alias("seq2seq")
    )


# ---- links, dates, counters ---------------------------------------------------------------

def _shown_count():
    """Like counts as a page shows them: plain, with thousands separator, K, M and unreadable."""
    n, key = F.col("n_chars"), F.col("doc_id")
    whole = F.floor(n / 1000).cast("string")
    return F.when(key % 5 == 0, n.cast("string")).when(
        key % 5 == 1, F.concat(whole, F.lit("."), F.floor(n % 1000 / 100).cast("string"), F.lit("K"))).when(
        key % 5 == 2, F.concat(whole, F.lit(","), F.lpad((n % 1000).cast("string"), 3, "0"))).when(
        key % 5 == 3, F.concat(F.lit(" "), n.cast("string"), F.lit("m"))).otherwise(F.substring("text", 1, 12))


_SHOWN = """case doc_id % 5 when 0 then cast(n_chars as varchar)
  when 1 then concat(n_chars // 1000, '.', n_chars % 1000 // 100, 'K')
  when 2 then concat(n_chars // 1000, ',', lpad(cast(n_chars % 1000 as varchar), 3, '0'))
  when 3 then concat(' ', n_chars, 'm') else left(text, 12) end"""
_NUM = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)(E[+-]?\d+)?\s*$'"


@query("parse_like_count", rf"""
with s as (select doc_id, upper(trim({_SHOWN})) as s from documents)
select doc_id, cast(coalesce(case
  when contains(s, 'K') then case when regexp_matches(replace(s, 'K', ''), {_NUM})
                             then trunc(try_cast(trim(replace(s, 'K', '')) as double) * 1000) end
  when contains(s, 'M') then case when regexp_matches(replace(s, 'M', ''), {_NUM})
                             then trunc(try_cast(trim(replace(s, 'M', '')) as double) * 1000000) end
  when regexp_matches(replace(s, ',', ''), '^\s*[+-]?\d+\s*$') then try_cast(trim(replace(s, ',', '')) as bigint) end, 0) as bigint)
  as likes from s""", ())
def _(t: Tables):
    return t.table("documents").select("doc_id", links.parse_like_count(_shown_count()).alias("likes"))


@query("extract_video_id", r"""
select id, coalesce(nullif(regexp_extract(link, '/video/(\d+)', 1), ''), 'unknown') as video_id
from (select id, case when label = 0 then topic else concat(url, '?x=1') end as link from posts)""")
def _(t: Tables):
    link = F.when(F.col("label") == 0, F.col("topic")).otherwise(F.concat("url", F.lit("?x=1")))
    return t.posts().select("id", links.extract_video_id(link).alias("video_id"))


_HREFS = r"""
with h as (select page_id, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href="([^"]*)"', 1)) as href from pages)"""


def _hrefs(t: Tables):
    found = F.regexp_extract_all("html", F.lit(r'(?is)<a\s[^>]*?href="([^"]*)"'), F.lit(1))
    return t.table("pages").select("page_id", F.explode(found).alias("href"))


@query("absolute_url", f"""{_HREFS}
select page_id, case when starts_with(href, 'http') then href else concat('https://www.tiktok.com', href) end as url from h""", ())
def _(t: Tables):
    return _hrefs(t).select("page_id", links.absolute_url(F.col("href")).alias("url"))


@query("post_url_match", r"""
select page_id, regexp_matches(link, 'threads\.com/@[^/]+/post/') as is_post
from (select page_id, case when page_id % 3 = 0 then url else concat('https://www.threads.com/@', page_id, '/post/', url) end as link
      from pages)""", ())
def _(t: Tables):
    key = F.col("page_id")
    link = F.when(key % 3 == 0, F.col("url")).otherwise(
        F.concat(F.lit("https://www.threads.com/@"), key.cast("string"), F.lit("/post/"), "url"))
    return t.table("pages").select("page_id", links.post_url_match(link).alias("is_post"))


@query("path_date", "select cast(id as varchar) as id, strftime(crawl_date, '%Y-%m-%d') as path_date from posts")
def _(t: Tables):
    return scan_all(t.spark, t.store_root()).select("id", links.path_date(F.col("_metadata.file_path")).alias("path_date"))


@query("month_key", "select id, strftime(crawl_date, '%Y-%m') as month from posts")
def _(t: Tables):
    return t.posts().select("id", links.month_key(F.col("crawl_date")).alias("month"))


@query("humanize", """
select distinct keyword, concat(upper(left(replace(keyword, '_', ' '), 1)), substr(replace(keyword, '_', ' '), 2)) as shown from posts""")
def _(t: Tables):
    return t.posts().select("keyword").distinct().select("keyword", text.humanize(F.col("keyword")).alias("shown"))
