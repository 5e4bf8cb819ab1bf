"""Readers for the comment store and the flat files around it.

The store is ``<root>/platform=<p>/crawl_date=<d>/*.parquet``. A root laid out as
``<root>/<p>/crawl_date=<d>/`` is read as well. Both dates and platforms are partition columns, so
filters on them prune directories instead of rows; schemas are declared, never inferred or merged.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentflow.operators.joins import DIGEST
from commentflow.schema import CRAWL_CSV_SCHEMA, INGEST_CSV_SCHEMA, PLATFORMS, PROCESSED_SCHEMA, RAW_SCHEMA
from commentflow.sources.paths import parquet_or_none

_DATE = T.StructField("crawl_date", T.DateType(), True)
_PLATFORM = T.StructField("platform", T.StringType(), True)


def _read_hive(spark: SparkSession, root: str, platforms: Sequence[str], schema: T.StructType) -> DataFrame | None:
    """All given platforms that have a ``platform=`` directory, as one relation."""
    full = T.StructType([*schema.fields, _PLATFORM, _DATE])
    paths = [f"{root.rstrip('/')}/platform={p}" for p in platforms]
    there = [path for path in paths if parquet_or_none(spark, path, full, base=root) is not None]
    return spark.read.schema(full).option("basePath", root).parquet(*there) if there else None


def _read_plain(spark: SparkSession, root: str, platform: str, schema: T.StructType) -> DataFrame | None:
    df = parquet_or_none(spark, f"{root.rstrip('/')}/{platform}", T.StructType([*schema.fields, _DATE]))
    if df is None:
        return None
    return df.withColumn("platform", F.lit(platform)).select(*schema.fieldNames(), "platform", "crawl_date")


def scan_platform(
    spark: SparkSession, root: str, platform: str, schema: T.StructType = RAW_SCHEMA
) -> DataFrame:
    """All comments of one platform with ``platform`` and ``crawl_date``, from both layouts."""
    return scan_all(spark, root, [platform], schema)


def scan_all(
    spark: SparkSession,
    root: str,
    platforms: Sequence[str] = PLATFORMS,
    schema: T.StructType = RAW_SCHEMA,
) -> DataFrame:
    """Comments of every platform that has data; an error when none has."""
    found = [_read_hive(spark, root, platforms, schema), *(_read_plain(spark, root, p, schema) for p in platforms)]
    parts = [df for df in found if df is not None]
    if not parts:
        raise ValueError(f"no comments of {tuple(platforms)} under {root}")
    return reduce(DataFrame.unionByName, parts)


def scan_digests(spark: SparkSession, root: str, platforms: Sequence[str] = PLATFORMS) -> DataFrame:
    """The stored digests of all comments, without their texts."""
    return scan_all(spark, root, platforms, T.StructType([T.StructField(DIGEST, T.BinaryType())])).select(DIGEST)


def scan_processed(
    spark: SparkSession, root: str, schema: T.StructType = PROCESSED_SCHEMA
) -> DataFrame | None:
    """The processed set with its ``split_set``, or None when it was never written."""
    return parquet_or_none(spark, root, schema)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType = INGEST_CSV_SCHEMA, sep: str = ";", multi_line: bool = False,
    escaped: bool = False,
) -> DataFrame:
    """Delimited file with a header; quoted fields may hold doubled quotes.

    Files have one record per line and are read in splits. Exports of ``write_csv_export`` spell line breaks
    as two characters, which ``escaped=True`` turns back. Files with line breaks inside quotes need
    ``multi_line=True``; such a file cannot be split and is one task.
    """
    rows = (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )
    if not escaped:
        return rows
    return rows.withColumns({f.name: unescape_breaks(F.col(f.name)) for f in schema if f.dataType == T.StringType()})


def unescape_breaks(text: Column) -> Column:
    parts = F.transform(
        F.split(text, r"\\\\"),
        lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(parts, "\\")


def read_crawl_csv(spark: SparkSession, path: str, text_col: str = "text", multi_line: bool = False) -> DataFrame:
    """Output of a crawl as ``text, topic, keyword, url``; one source names its text ``comment_text``."""
    fields = [T.StructField(text_col if f.name == "text" else f.name, f.dataType) for f in CRAWL_CSV_SCHEMA.fields]
    rows = read_csv(spark, path, T.StructType(fields), sep=",", multi_line=multi_line)
    return rows.select(F.col(text_col).alias("text"), "topic", "keyword", F.col("post_url").alias("url"))


def read_jsonl(spark: SparkSession, path: str, text_field: str = "texts") -> DataFrame:
    """JSON-lines corpus reduced to its text field, named ``text``."""
    schema = T.StructType([T.StructField(text_field, T.StringType(), True)])
    return spark.read.schema(schema).json(path).select(F.col(text_field).alias("text"))


def file_inventory(df: DataFrame) -> DataFrame:
    """Files behind a file-based DataFrame with size, modification time and row count."""
    return (
        df.select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("_metadata.file_modification_time").alias("modified_at"),
        )
        .groupBy("file_path", "file_size", "modified_at")
        .agg(F.count("*").alias("row_count"))
    )


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The DataFrame itself, or an error naming what is missing and what is there."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; present: {df.columns}")
    return df


def table_head(df: DataFrame, columns: Sequence[str], n: int = 5, order_by: str = "id") -> DataFrame:
    """First rows by ``order_by``, chosen columns only."""
    wanted = list(dict.fromkeys([order_by, *columns]))
    return df.select(*wanted).orderBy(order_by).limit(n).select(*columns)
