"""Registry of the queries that run over the given tables, with the SQL each one must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from commentflow.plans.tables import CTES, Tables


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


REGISTRY: dict[str, Query] = {}


def full_sql(body: str, uses: tuple[str, ...]) -> str:
    """Put the common table expressions a statement uses in front of it."""
    body = body.strip()
    if not uses:
        return body
    head = "with " + ",\n".join(f"{name} as (\n{CTES[name].strip()}\n)" for name in uses)
    if body.lower().startswith("with "):
        return f"{head},\n{body[5:]}"
    return f"{head}\n{body}"


def query(key: str, sql: str | None = None, uses: tuple[str, ...] = ("posts",)):
    """Register a function ``Tables -> DataFrame`` under a key."""

    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if key in REGISTRY:
            raise ValueError(f"query {key!r} is registered twice")
        REGISTRY[key] = Query(key, build, None if sql is None else full_sql(sql, uses))
        return build

    return add
