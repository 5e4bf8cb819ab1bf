"""Dashboard aggregates over the comment store.

All of them are single group-bys with map-side partial aggregation; nothing is collected. Null group
keys are kept. Those that only count also take the counts of ``sources.kept`` in place of the comments.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentflow.functions.labels import label_name, registry_label_name
from commentflow.functions.links import month_key
from commentflow.functions.text import tokens
from commentflow.operators.filters import drop_unlabelled
from commentflow.operators.ranking import limit_rows, share_of
from commentflow.schema import KEPT_ROWS, PLATFORMS

# ---- fixed values: column names of the per-label counts -----------------------------------
LABEL_COLUMNS = ((-1, "chưa_gán_nhãn"), (0, "bình_thường"), (1, "offensive"), (2, "hate_speech"))
UNKNOWN_COLUMN = "không_xác_định"
# ---- end of fixed values ------------------------------------------------------------------

_PERCENT_COLUMNS = ((0, "binh_thuong"), (1, "offensive"), (2, "hate_speech"))


def _of_platform(df: DataFrame, platform: str | None) -> DataFrame:
    return df if platform is None else df.filter(F.col("platform") == platform)


def _is(label: int) -> Column:
    return F.col("label") == label


def tally(df: DataFrame, condition: Column | None = None) -> Column:
    """Number of comments, or of those that meet a condition; the rows of a kept table stand for several each."""
    if KEPT_ROWS not in df.columns:
        return F.count("*") if condition is None else F.count_if(condition)
    rows = F.col(KEPT_ROWS) if condition is None else F.when(condition, F.col(KEPT_ROWS))
    return F.coalesce(F.sum(rows), F.lit(0).cast("bigint"))


def counts_by(df: DataFrame, *keys: str, name: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(tally(df).alias(name))


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("label_name", label_name(F.col("label")))


def _rank_limit(df: DataFrame, order: list[Column], top_n: int | None) -> DataFrame:
    ordered = df.orderBy(*order)
    return ordered if top_n is None else ordered.limit(top_n)


def label_distribution(df: DataFrame, platform: str | None = None) -> DataFrame:
    return _named(counts_by(_of_platform(df, platform), "label")).orderBy("label")


def daily_count(
    df: DataFrame, start: date | str | None = None, end: date | str | None = None, platform: str | None = None
) -> DataFrame:
    """Rows per crawl day and platform, optionally inside an inclusive date range."""
    if start is not None:
        df = df.filter(F.col("crawl_date") >= F.lit(str(start)).cast("date"))
    if end is not None:
        df = df.filter(F.col("crawl_date") <= F.lit(str(end)).cast("date"))
    return counts_by(_of_platform(df, platform), "crawl_date", "platform").orderBy("crawl_date", "platform")


def recent_days(df: DataFrame, platform: str | None = None, top_n: int = 7) -> DataFrame:
    """Newest (day, platform) rows of the daily counts."""
    daily = counts_by(_of_platform(df, platform), "crawl_date", "platform")
    return _rank_limit(daily, [F.desc("crawl_date"), F.col("platform")], top_n)


def platform_comparison(df: DataFrame) -> DataFrame:
    """Total per platform and one count per known label."""
    per_label = [tally(df, _is(value)).alias(name) for value, name in LABEL_COLUMNS]
    return df.groupBy("platform").agg(tally(df).alias("total"), *per_label).orderBy("platform")


def topic_stats(df: DataFrame, platform: str | None = None, top_n: int | None = None) -> DataFrame:
    stats = counts_by(_of_platform(df, platform), "topic", "platform")
    return _rank_limit(stats, [F.desc("total"), F.col("topic"), F.col("platform")], top_n)


def keyword_stats(df: DataFrame, platform: str | None = None, top_n: int = 20) -> DataFrame:
    stats = counts_by(_of_platform(df, platform), "keyword", "platform")
    return _rank_limit(stats, [F.desc("total"), F.col("keyword"), F.col("platform")], top_n)


def topic_label_distribution(df: DataFrame, platform: str | None = None) -> DataFrame:
    return _named(counts_by(_of_platform(df, platform), "topic", "label", name="count")).orderBy("topic", "label")


def source_label_distribution(df: DataFrame) -> DataFrame:
    return _named(counts_by(df, "platform", "label", name="count")).orderBy("platform", "label")


def source_topic_distribution(df: DataFrame) -> DataFrame:
    counted = counts_by(df, "platform", "topic", name="count")
    return counted.orderBy("platform", F.desc("count"), "topic")


def dashboard_kpis(df: DataFrame) -> DataFrame:
    """Totals of the store; rows without any label value count as labelled."""
    per_platform = df.groupBy("platform").agg(
        tally(df).alias("_rows"), tally(df, _is(-1)).alias("_unlabelled")
    )
    totals = per_platform.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_records"),
        F.count("*").alias("total_platforms"),
        F.coalesce(F.sum("_unlabelled"), F.lit(0)).alias("total_unlabeled"),
    ).withColumn("total_labeled", F.col("total_records") - F.col("total_unlabeled"))

    def percent(part: str) -> Column:
        return F.bround(F.try_divide(F.col(part) * F.lit(100.0).cast("double"), F.col("total_records")), 1)

    return totals.select(
        "total_records", "total_platforms", "total_labeled", "total_unlabeled",
        percent("total_labeled").alias("labeled_pct"), percent("total_unlabeled").alias("unlabeled_pct"),
    )


def crawl_timeline(df: DataFrame, platforms: Sequence[str] = PLATFORMS) -> DataFrame:
    """Rows per month, one zero-filled column per known platform; undated rows are skipped."""
    dated = df.filter(F.col("crawl_date").isNotNull())
    per_platform = [tally(df, F.col("platform") == p).alias(p) for p in platforms]
    return dated.groupBy(month_key(F.col("crawl_date")).alias("month")).agg(*per_platform).orderBy("month")


def topic_distribution(df: DataFrame, platform: str | None = None, top_n: int | None = None) -> DataFrame:
    totals = counts_by(_of_platform(df, platform), "topic")
    return _rank_limit(totals, [F.desc("total"), F.col("topic")], top_n)


def topic_label_heatmap(df: DataFrame) -> DataFrame:
    """Share of each class inside a topic in percent of all its rows, unlabelled ones included."""
    shares = [
        F.bround(tally(df, _is(value)) / tally(df) * F.lit(100.0).cast("double"), 1).alias(name)
        for value, name in _PERCENT_COLUMNS
    ]
    return df.groupBy("topic").agg(*shares).orderBy("topic")


def label_share(df: DataFrame, platform: str | None = None) -> DataFrame:
    """Each class as a percentage of all labelled rows, with the width its bar is drawn at."""
    counted = counts_by(drop_unlabelled(_of_platform(df, platform)), "label")
    pct = F.bround(share_of(F.col("total").cast("double")), 1)
    return _named(counted).withColumn("pct", pct).withColumn("bar_pct", F.least(F.col("pct"), F.lit(100.0).cast("double")))


def source_label_pivot(df: DataFrame) -> DataFrame:
    """One row per platform, one column per class name, unlabelled rows left out."""
    known = [value for value, _ in LABEL_COLUMNS]
    unknown = F.col("label").isNull() | ~F.col("label").isin(*known)
    cells = [(name, _is(value)) for value, name in LABEL_COLUMNS if value != -1] + [(UNKNOWN_COLUMN, unknown)]
    columns = [F.nullif(tally(df, condition), F.lit(0).cast("bigint")).alias(name) for name, condition in cells]
    return drop_unlabelled(df).groupBy(F.col("platform").alias("source")).agg(*columns)


def platform_profile(
    df: DataFrame, lang: str = "vi", lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """Size, crawl period, rows in one language and mean text length of every platform.

    Rows without a language column have an unknown number of records in that language.
    """
    in_language = F.count_if(F.col(lang_col) == lang) if lang_col in df.columns else F.lit(None).cast("bigint")
    return df.groupBy("platform").agg(
        F.count("*").alias("total_records"),
        F.min("crawl_date").alias("first_crawled"),
        F.max("crawl_date").alias("last_crawled"),
        in_language.alias("language_records"),
        F.bround(F.avg(F.length(text_col)), 1).alias("avg_char_count"),
    )


def platform_share(df: DataFrame) -> DataFrame:
    """Rows per platform and their share of all rows in whole percent."""
    share = F.bround(share_of(F.col("total").cast("double")), 0).cast("bigint")
    return counts_by(df, "platform").withColumn("share_pct", share)


def dataset_split_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Records and mean token count per split, platform and class."""
    named = df.withColumn("label_name", registry_label_name(F.col("label")))
    return (
        named.filter(F.col("label_name").isNotNull())
        .groupBy("split_set", "platform", "label_name")
        .agg(
            F.count("*").alias("record_count"),
            F.bround(F.avg(F.size(tokens(F.col(text_col)))), 1).alias("avg_token_count"),
        )
    )


def dataset_overview(df: DataFrame) -> DataFrame:
    """Per split: size, share of all labelled rows, and maps platform→rows and class→rows."""
    named = df.withColumns(
        {"label_name": registry_label_name(F.col("label")), "platform": F.coalesce("platform", F.lit("unknown"))}
    )
    split, platform, name = (F.col(c) for c in ("split_set", "platform", "label_name"))
    counted = (
        named.filter(name.isNotNull())
        .groupingSets([[split, platform], [split, name], [split]], split, platform, name)
        .agg(F.grouping_id(split, platform, name).alias("_gid"), F.count("*").alias("n"))
    )
    gid = F.col("_gid")

    # The maps are collected over distinct platforms or class names, never over rows.
    def as_map(key: Column, bits: int) -> Column:
        return F.map_from_entries(F.array_sort(F.collect_list(F.when(gid == bits, F.struct(key, "n")))))

    per_split = counted.groupBy("split_set").agg(
        F.max(F.when(gid == 0b011, F.col("n"))).alias("total_records"),
        as_map(platform, 0b001).alias("platforms"),
        as_map(name, 0b010).alias("labels"),
    )
    everything = F.sum("total_records").over(Window.partitionBy())
    return per_split.select(
        "split_set", "total_records", F.round(F.col("total_records") / everything, 4).alias("ratio"), "platforms", "labels"
    )


def dataset_overview_long(df: DataFrame) -> DataFrame:
    """``dataset_overview`` with its maps flattened to (kind, name, records) rows."""
    def rows(kind: str, column: str) -> Column:
        return F.transform(
            F.map_entries(column),
            lambda e: F.struct(F.lit(kind).alias("kind"), e["key"].alias("name"), e["value"].alias("records")),
        )

    pairs = F.concat(rows("platform", "platforms"), rows("label", "labels"))
    return dataset_overview(df).select("split_set", "total_records", "ratio", F.inline(pairs))


def split_sizes(df: DataFrame, train_ratio: float = 0.8, by: Sequence[str] = ()) -> DataFrame:
    """Train and test sizes a ratio gives for the rows at hand."""
    total = F.col("total_samples")
    return df.groupBy(*by).agg(F.count("*").alias("total_samples")).withColumns(
        {
            "train_samples": F.round(total * F.lit(float(train_ratio))).cast("bigint"),
            "test_samples": F.round(total * F.lit(1.0 - train_ratio).cast("double")).cast("bigint"),
        }
    )


def summary_report(df: DataFrame, days: int = 7, top_n: int = 10) -> DataFrame:
    """The whole overview in long form ``(section, rank, key, value)``, from one scan.

    The rows are first reduced to one count per (platform, topic, keyword, label, day). Grouping sets
    over that table give every section; sections that list only their first rows are cut to them in
    the map tasks, so a long list of keywords is never sorted in one place.
    """
    base = counts_by(df, "platform", "topic", "keyword", "label", "crawl_date", name="n")

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("null"))

    def sections(parts: dict[str, tuple[str, ...]]) -> DataFrame:
        """Counts of several sections at once; a section is named by the columns it groups by."""
        used = sorted({c for columns in parts.values() for c in columns})
        sets = [[F.col(c) for c in columns] for columns in parts.values()]
        # Bit i of the grouping id is on when the column is not part of the set.
        gids = {
            name: sum(1 << (len(used) - 1 - i) for i, c in enumerate(used) if c not in columns)
            for name, columns in parts.items()
        }
        counted = base.groupingSets(sets, *used).agg(F.grouping_id(*used).alias("_gid"), F.sum("n").alias("value"))
        name = F.coalesce(*[F.when(F.col("_gid") == gid, F.lit(s)) for s, gid in gids.items()])
        key = F.coalesce(*[
            F.when(F.col("_gid") == gid, F.concat_ws("|", *[text(c) for c in parts[s]]) if parts[s] else F.lit("all"))
            for s, gid in gids.items()
        ])
        return counted.select(name.alias("section"), key.alias("key"), "value", *used)

    complete = sections(
        {"total": (), "platform": ("platform",), "platform_label": ("platform", "label"), "label": ("label",)}
    )
    by_key = Window.partitionBy("section").orderBy("key")
    listed = sections(
        {"daily": ("crawl_date", "platform"), "keyword": ("keyword", "platform"), "topic": ("topic", "platform")}
    )
    is_day = F.col("section") == "daily"
    order = [
        F.when(is_day, F.col("crawl_date")).desc_nulls_last(), F.when(~is_day, F.col("value")).desc_nulls_last(), F.col("key"),
    ]
    first = limit_rows(listed, ["section"], order, max(days, top_n), rank_col="rank").filter(
        F.col("rank") <= F.when(is_day, days).otherwise(top_n)
    )
    columns = ["section", F.col("rank").cast("bigint").alias("rank"), "key", "value"]
    return complete.withColumn("rank", F.row_number().over(by_key)).select(*columns).unionByName(first.select(*columns))
