"""Crawl post-processing over stored pages.

A page becomes an array of tokens (texts, tags, comments, scripts) in one pass. Links and text segments are picked out
of it with array expressions inside the row, so no shuffle is needed until rows of different pages meet.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentflow.functions.links import VIDEO_SITE, absolute_url
from commentflow.functions.text import strip_space
from commentflow.operators import filters
from commentflow.operators.dedup import (
    COMMENTS_PER_POST, cap_per_group, dedup_exact_in_group, dedup_prefix80,
)

# One alternation reads a page from left to right, so what is inside a comment, a script or a quoted value is never
# taken for markup. Comments, scripts and styles that are not closed run to the end of the page. A quote opens a value
# only behind an equals sign; one that is never closed is an ordinary character.
_REST = r"[^>=]*(?:=\s*(?:\"[^\"]*\"|'[^']*'|)[^>=]*)*>"
TOKEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    + "".join(rf"|<{name}(?:\s{_REST}|>).*?(?:</{name}\s*>|\z)" for name in ("script", "style"))
    + rf"|</?[a-z]{_REST}|<[!?/][^>]*>|[^<]+|<"
)
ATTRIBUTE = r"(?is)[^\s=>\"'/]+\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"']+)"
HREF = r"(?is)^href\s*=\s*"
LINK, OPENS, CLOSES = r"(?i)^<a\s", r"(?i)^<p[\s>/]", r"(?i)^</p\s*>"
#: Characters that stand for the start and the end of a paragraph; pages lose them if they hold any.
START, END = "\x01", "\x02"
NUMERIC_ENTITY = r"^(?:[xX][0-9a-fA-F]{1,6}|[0-9]{1,7});"

# ---- fixed values -------------------------------------------------------------------------
ENTITIES = (
    ("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("nbsp", "\u00a0"), ("hellip", "…"), ("ndash", "–"), ("mdash", "—"),
    ("lsquo", "‘"), ("rsquo", "’"), ("ldquo", "“"), ("rdquo", "”"), ("laquo", "«"), ("raquo", "»"), ("bull", "•"),
    ("middot", "·"), ("copy", "©"), ("reg", "®"), ("trade", "™"), ("euro", "€"), ("times", "×"), ("deg", "°"),
)
# ---- end of fixed values ------------------------------------------------------------------


def extract_anchors(
    pages: DataFrame, pattern: str | None = None, cap: int | None = None, site: str = VIDEO_SITE,
    html_col: str = "html", key_col: str = "page_id",
) -> DataFrame:
    """Distinct absolute link targets of each page in order of appearance.

    Comments, scripts and styles hold no links; a value may stand in double quotes, single quotes or none."""
    links = F.filter(tokens(F.col(html_col)), lambda t: t.rlike(LINK))
    # The first attribute of that name counts, and no part of another one's value.
    named = F.transform(links, lambda t: F.get(F.filter(F.regexp_extract_all(t, F.lit(ATTRIBUTE), F.lit(0)), lambda a: a.rlike(HREF)), F.lit(0)))
    values = F.transform(F.filter(named, lambda a: a.isNotNull()), lambda a: F.regexp_replace(a, HREF, ""))
    hrefs = F.transform(values, lambda h: decode_entities(F.regexp_replace(h, "^[\"']|[\"']$", "")))
    if pattern is not None:
        hrefs = F.filter(hrefs, lambda h: h.rlike(pattern))
    links = F.array_distinct(F.transform(hrefs, lambda h: absolute_url(h, site)))
    if cap is not None:
        links = F.slice(links, 1, cap)
    return pages.select(key_col, F.posexplode(links).alias("position", "url"))


def decode_entities(text: Column) -> Column:
    """Named and numeric character references as characters; the ampersand comes last, so nothing is decoded twice."""
    def numeric(part: Column, i: Column) -> Column:
        code = F.substring_index(part, ";", 1)
        number = F.when(F.lower(F.left(code, F.lit(1))) == "x", F.conv(F.substr(code, F.lit(2)), 16, 10)).otherwise(code).cast("int")
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number.cast("bigint")), 8, "0")), "UTF-32")).otherwise("\ufffd")
        rest = F.substr(part, F.locate(";", part) + 1)
        return F.when(i == 0, part).when(part.rlike(NUMERIC_ENTITY), F.concat(char, rest)).otherwise(F.concat(F.lit("&#"), part))

    named = reduce(lambda c, e: F.replace(c, F.lit(f"&{e[0]};"), F.lit(e[1])), ENTITIES, text)
    spelled = F.when(named.contains("&#"), F.array_join(F.transform(F.split(named, "&#"), numeric), "")).otherwise(named)
    decoded = F.replace(spelled, F.lit("&amp;"), F.lit("&"))
    return F.when(text.contains("&"), decoded).otherwise(text)


def _possessive(pattern: str) -> str:
    """The same pattern without steps back, which long tags would need a deep stack for."""
    return pattern.replace("[^>=]*", "[^>=]*+").replace("[^>=]*+)*>", "[^>=]*+)*+>")


def tokens(html: Column) -> Column:
    """The texts, tags, comments, scripts and styles of a page, in order."""
    return F.regexp_extract_all(html, F.lit(_possessive(TOKEN)), F.lit(0))


def segment_array(html: Column) -> Column:
    """Visible text of every paragraph; one that is not closed ends where the next one opens, or with the page."""
    def shown(token: Column) -> Column:
        markup = token.startswith("<") & (F.length(token) > 1)
        mark = F.when(token.rlike(OPENS), F.lit(START)).when(token.rlike(CLOSES), F.lit(END)).otherwise(F.lit(""))
        return F.when(markup, mark).otherwise(token)

    marked = F.array_join(F.transform(tokens(F.translate(html, START + END, "")), shown), "")
    opened = F.split(marked, START)
    parts = F.slice(opened, F.lit(2), F.greatest(F.size(opened) - 1, F.lit(0)))
    return F.transform(parts, lambda p: strip_space(decode_entities(F.substring_index(p, END, 1))))


def keep_comment(text: Column, shortest: int = 5, interface_rules: bool = True) -> Column:
    """The crawl's rules for text worth keeping; one source shows no interface lines and needs the length only."""
    if not interface_rules:
        return (text != "") & filters.long_enough(text, shortest)
    return (
        (text != "")
        & filters.no_ui_caption(text)
        & filters.no_reply_line(text)
        & filters.no_relative_time(text)
        & filters.no_counter(text)
        & filters.long_enough(text, shortest)
    )


def extract_segments(
    pages: DataFrame, shortest: int = 5, skip_first: bool = False, html_col: str = "html", interface_rules: bool = True,
) -> DataFrame:
    """One row per kept text segment with its position on the page.

    ``skip_first`` leaves out the first segment, for pages that open with the post itself.
    """
    others = [c for c in pages.columns if c != html_col]
    # Cleaned inside the array: past the explode a text is a plain column, evaluated once for all rules.
    rows = pages.select(*others, F.posexplode(segment_array(F.col(html_col))).alias("position", "text"))
    if skip_first:
        rows = rows.filter(F.col("position") > 0)
    return rows.filter(keep_comment(F.col("text"), shortest, interface_rules))


def url_topic(url: Column) -> Column:
    """Host of an address, the stand-in for a topic on stored pages."""
    return F.regexp_extract(url, r"^https?://([^/?#]+)", 1)


def url_keyword(url: Column) -> Column:
    """First path element of an address."""
    return F.regexp_extract(url, r"^https?://[^/?#]+/([^/?#]*)", 1)


def clean_crawl(
    pages: DataFrame, shortest: int = 5, cap: int = COMMENTS_PER_POST, skip_first: bool = False,
    url_col: str = "url", key_col: str = "page_id", interface_rules: bool = True,
) -> DataFrame:
    """Stored pages to comments: segments, duplicates inside a page, cap, duplicates across pages."""
    order = [key_col, "position"]
    segments = extract_segments(pages, shortest, skip_first, interface_rules=interface_rules)
    unique = dedup_exact_in_group(segments, [url_col], order_by=order)
    capped = cap_per_group(unique, [url_col], cap, order)
    url = F.col(url_col)
    return dedup_prefix80(capped, order_by=order).select(
        "text", url_topic(url).alias("topic"), url_keyword(url).alias("keyword"), url.alias("url")
    )


def crawl_totals(comments: DataFrame) -> DataFrame:
    """Rows kept per topic, keyword and post."""
    return comments.groupBy("topic", "keyword", "url").agg(F.count("*").alias("total"))
