"""All registered queries; importing the modules fills the registry."""

from marlstone.registry import (  # noqa: F401
    column_queries,
    explore_queries,
    gold_queries,
    join_queries,
    quality_queries,
    run_queries,
    source_queries,
)
from marlstone.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
