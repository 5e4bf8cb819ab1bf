"""Reads of folders that may not be there."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_MISSING = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def parquet_or_none(
    spark: SparkSession, path: str, schema: T.StructType | None = None, base: str | None = None
) -> DataFrame | None:
    """The Parquet files below a path, or None when the path does not exist."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if base is not None:
        reader = reader.option("basePath", base)
    try:
        df = reader.parquet(path)
        df.schema  # noqa: B018  a remote session looks at the path only now
    except AnalysisException as error:
        if (error.getCondition() or "").split(".")[0] in _MISSING:
            return None
        raise
    return df
