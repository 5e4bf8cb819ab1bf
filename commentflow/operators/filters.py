"""Row filters: store queries, training rows and crawl clean-up rules."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentflow.functions.text import SPACE_CLASS, strip_space
from commentflow.operators.ranking import top_values
from commentflow.schema import PLATFORMS, UNLABELLED

# ---- fixed values -------------------------------------------------------------------------
UI_CAPTIONS = (
    "Trả lời", "Xem thêm", "Thích", "Phản hồi", "Chia sẻ", "Xem bản dịch", "Xem tất cả",
    "Đăng lại", "Hàng đầu", "Xem hoạt động", "Theo dõi",
)
REPLY_PREFIX = "Đang trả lời"
RELATIVE_UNITS = ("giờ", "phút", "ngày", "tuần", "tháng", "giây")
COUNTER_CHARS = ",./km"
# ---- end of fixed values ------------------------------------------------------------------

# Digits and white space of every script; both patterns read the same in Java and RE2.
RELATIVE_TIME = rf"^\p{{Nd}}+[{SPACE_CLASS}]*({'|'.join(RELATIVE_UNITS)})"
COUNTER = rf"^[\p{{Nd}}{COUNTER_CHARS}{SPACE_CLASS}]+$"


def _and_also(
    df: DataFrame,
    condition: Column | None,
    platform: str | None,
    label: int | None,
    limit: int | None,
    platforms: Sequence[str],
) -> DataFrame:
    if platform is not None and platform not in platforms:
        raise ValueError(f"unknown platform {platform!r}; choose one of {tuple(platforms)}")
    if platform is not None:
        df = df.filter(F.col("platform") == platform)
    if label is not None:
        df = df.filter(F.col("label") == label)
    if condition is not None:
        df = df.filter(condition)
    return df.orderBy("id").limit(limit) if limit else df


def query_by_label(
    df: DataFrame, label: int, platform: str | None = None, limit: int | None = None,
    platforms: Sequence[str] = PLATFORMS,
) -> DataFrame:
    return _and_also(df, None, platform, label, limit, platforms)


def query_by_date(
    df: DataFrame, start: date | str, end: date | str | None = None, platform: str | None = None,
    label: int | None = None, limit: int | None = None, platforms: Sequence[str] = PLATFORMS,
) -> DataFrame:
    """Rows crawled from ``start`` to ``end`` inclusive, one day when ``end`` is left out."""
    first, last = (F.lit(str(d)).cast("date") for d in (start, start if end is None else end))
    return _and_also(df, F.col("crawl_date").between(first, last), platform, label, limit, platforms)


def query_by_platform(
    df: DataFrame, platform: str, label: int | None = None, limit: int | None = None,
    platforms: Sequence[str] = PLATFORMS,
) -> DataFrame:
    return _and_also(df, None, platform, label, limit, platforms)


def query_by_topic(
    df: DataFrame, topic: str, platform: str | None = None, label: int | None = None,
    limit: int | None = None, platforms: Sequence[str] = PLATFORMS,
) -> DataFrame:
    return _and_also(df, F.lower("topic") == topic.lower(), platform, label, limit, platforms)


def query_by_keyword(
    df: DataFrame, keyword: str, platform: str | None = None, label: int | None = None,
    exact: bool = True, limit: int | None = None, platforms: Sequence[str] = PLATFORMS,
) -> DataFrame:
    """Case-insensitive equality, or substring search (no wildcards) with ``exact=False``."""
    have, want = F.lower("keyword"), keyword.lower()
    return _and_also(df, have == want if exact else have.contains(want), platform, label, limit, platforms)


def query_by_keyword_like(df: DataFrame, keyword: str, **filters) -> DataFrame:
    return query_by_keyword(df, keyword, exact=False, **filters)


def filter_source_in(df: DataFrame, sources: Sequence[str] = PLATFORMS, source_col: str = "source") -> DataFrame:
    return df.filter(F.col(source_col).isin(*sources))


def top_topics_semi(df: DataFrame, top_n: int = 10, topic_col: str = "topic") -> DataFrame:
    """Rows of the most frequent topics; whether these are broadcast is left to the planner, which sees their size."""
    top = top_values(df, topic_col, top_n).select(topic_col)
    return df.join(top, topic_col, "left_semi")


def drop_missing_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Trimmed, lower-cased text; rows without any are dropped."""
    stripped = strip_space(F.col(text_col))
    return df.filter(stripped != "").withColumn(text_col, F.lower(stripped))


def training_rows(df: DataFrame, text_col: str = "text", label_col: str = "label") -> DataFrame:
    return df.select(text_col, label_col).dropna().withColumn(label_col, F.col(label_col).cast("int"))


# Crawl rules, as conditions that hold for text worth keeping.

def long_enough(text: Column, n: int) -> Column:
    return F.length(text) >= n


def no_ui_caption(text: Column) -> Column:
    return ~text.isin(*UI_CAPTIONS)


def no_reply_line(text: Column) -> Column:
    return ~text.startswith(REPLY_PREFIX)


def no_relative_time(text: Column) -> Column:
    return ~text.rlike(RELATIVE_TIME)


def no_counter(text: Column) -> Column:
    return ~F.lower(text).rlike(COUNTER)


def min_length(df: DataFrame, text_col: str = "text", n: int = 3) -> DataFrame:
    return df.filter(long_enough(F.col(text_col), n))


def drop_ui_labels(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.filter(no_ui_caption(F.col(text_col)))


def drop_reply_lines(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.filter(no_reply_line(F.col(text_col)))


def drop_relative_time(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.filter(no_relative_time(F.col(text_col)))


def drop_counters(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.filter(no_counter(F.col(text_col)))


def unparsed_rows(df: DataFrame, label_col: str = "predicted_label", limit: int = 50, order_by: str = "id") -> DataFrame:
    """First rows whose model answer held no label."""
    return df.filter(F.col(label_col) == UNLABELLED).orderBy(order_by).limit(limit)


def drop_unlabelled(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Rows somebody looked at; a label that is missing altogether is not "unlabelled"."""
    return df.filter(~F.col(label_col).eqNullSafe(F.lit(UNLABELLED)))
