"""Duplicate removal and per-group caps.

"First" always means first by an explicit order, the id unless told otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentflow.functions.links import extract_video_id
from commentflow.functions.text import strip_space
from commentflow.operators.ranking import cap_rows, first_rows, with_rank

# ---- fixed values -------------------------------------------------------------------------
PREFIX_CHARS = 80
COMMENTS_PER_POST = 500
POSTS_PER_KEYWORD = 10
# ---- end of fixed values ------------------------------------------------------------------


def dedup_prefix80(df: DataFrame, text_col: str = "text", order_by="id", chars: int = PREFIX_CHARS) -> DataFrame:
    """Keep the first row of each lower-cased text prefix."""
    return first_rows(df, [F.lower(F.substring(text_col, 1, chars))], order_by)


def dedup_exact_in_group(df: DataFrame, keys: Sequence[str] = ("url",), text_col: str = "text", order_by="id") -> DataFrame:
    """Keep the first row of each trimmed text inside a post or video."""
    return first_rows(df, [*keys, strip_space(F.col(text_col))], order_by)


def cap_per_group(df: DataFrame, keys: Sequence[str] = ("url",), cap: int = COMMENTS_PER_POST, order_by="id") -> DataFrame:
    """Keep at most ``cap`` rows per post or video."""
    return cap_rows(df, keys, order_by, cap)


def cap_posts_per_keyword(
    df: DataFrame, keyword_col: str = "keyword", url_col: str = "url", cap: int = POSTS_PER_KEYWORD, order_by: str = "id"
) -> DataFrame:
    """Rows of the first ``cap`` distinct posts of every keyword, by first appearance."""
    key = [keyword_col, url_col]
    posts = df.groupBy(*key).agg(F.min(order_by).alias("_first"))
    kept = cap_rows(posts, [keyword_col], ["_first", url_col], cap).select(*key)
    return df.join(kept, key, "left_semi")


def distinct_urls(df: DataFrame, url_col: str = "url") -> DataFrame:
    return df.select(url_col).distinct()


def comment_key(df: DataFrame, url_col: str = "url", order_by: str = "id", out: str = "comment_id") -> DataFrame:
    """``<video id>_<index>``, the index counting a video's comments from 0."""
    keyed = df.withColumn("_video", extract_video_id(F.col(url_col)))
    ranked = with_rank(keyed, ["_video"], order_by, out="_index")
    return ranked.withColumn(out, F.concat_ws("_", "_video", F.col("_index").cast("string"))).drop("_video", "_index")
