"""All registered queries. Importing the package fills the registry."""

from martloom.catalog import (  # noqa: F401
    control_queries,
    file_queries,
    policy_queries,
    retail_queries,
    statistics_queries,
)
from martloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
