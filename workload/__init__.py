"""Queries over the supplied tables, each with the SQL it is checked against."""

from . import (  # noqa: F401
    business_queries, cleaning_queries, ingest_queries, model_queries, screening_queries,
)
from .registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
