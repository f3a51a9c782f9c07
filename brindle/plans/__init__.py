"""The registered queries, by area."""

from brindle.plans import (  # noqa: F401
    aggregate_queries,
    function_queries,
    generated_queries,
    join_queries,
    layout_queries,
    shaping_queries,
    stream_queries,
    window_queries,
)
from brindle.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
