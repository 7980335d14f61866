"""All registered queries. Importing a module of queries registers them."""

from . import queries_features, queries_ingest, queries_models, queries_quality, queries_service, queries_tables  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
