"""Where intermediate tables go: always a folder that all executors share."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset, one below the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{shared.rstrip('/')}/commentflow-{spark.sparkContext.applicationId}"


def new_dir(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet; nothing is created."""
    return f"{scratch_root(spark)}/{name}-{uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a new folder below the shared one and read it back: later plans start at the files."""
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
