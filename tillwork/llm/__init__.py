"""Operators for training-data pipelines, with their queries."""

from tillwork.llm import (  # noqa: F401
    alignment,
    conversations,
    decontaminate,
    language,
    line_dedup,
    near_dedup,
    overlap_join,
    packing,
    shard,
    suffix_dedup,
    token_counts,
    token_files,
    topk,
)
from tillwork.llm.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
