"""URL, path, date and counter expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from commentflow.functions.text import strip_space

# ---- fixed values -------------------------------------------------------------------------
VIDEO_ID = r"/video/(\d+)"
POST_URL = r"threads\.com/@[^/]+/post/"
PATH_DATE = r"crawl_date=(\d{4}-\d{2}-\d{2})"
UNKNOWN_VIDEO = "unknown"
VIDEO_SITE = "https://www.tiktok.com"
# ---- end of fixed values ------------------------------------------------------------------

_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)(E[+-]?\d+)?\s*$"
_INTEGER = r"^\s*[+-]?\d+\s*$"


def extract_video_id(url: Column) -> Column:
    found = F.nullif(F.regexp_extract(url, VIDEO_ID, 1), F.lit(""))
    return F.coalesce(found, F.lit(UNKNOWN_VIDEO))


def absolute_url(href: Column, site: str = VIDEO_SITE) -> Column:
    return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(site), href))


def post_url_match(href: Column) -> Column:
    return href.rlike(POST_URL)


def path_date(path: Column) -> Column:
    """Crawl date written into a file path, '' when there is none."""
    return F.regexp_extract(path, PATH_DATE, 1)


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def parse_like_count(raw: Column) -> Column:
    """``1.2K`` → 1200, ``3M`` → 3000000, ``1,234`` → 1234, unreadable → 0."""
    shown = F.upper(strip_space(raw))

    def scaled(suffix: str, factor: int) -> Column:
        number = F.replace(shown, F.lit(suffix), F.lit(""))
        return F.when(number.rlike(_DECIMAL), (F.trim(number).try_cast("double") * factor).cast("bigint"))

    plain = F.replace(shown, F.lit(","), F.lit(""))
    value = (
        F.when(shown.contains("K"), scaled("K", 1_000))
        .when(shown.contains("M"), scaled("M", 1_000_000))
        .otherwise(F.when(plain.rlike(_INTEGER), F.trim(plain).try_cast("bigint")))
    )
    return F.coalesce(value, F.lit(0).cast("bigint"))
