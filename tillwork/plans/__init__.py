"""Queries over the given tables, composed from the operators."""

from tillwork.plans import (  # noqa: F401
    evaluation,
    mining,
    modelling,
    profiling,
    regression,
    sales,
)
from tillwork.plans.registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES", "query"]
