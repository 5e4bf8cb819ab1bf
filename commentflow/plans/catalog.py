"""Importing this module fills the registry."""

from commentflow.plans import (  # noqa: F401
    queries_crawl, queries_dashboard, queries_models, queries_store, queries_text,
)
from commentflow.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
