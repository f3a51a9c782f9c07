"""All queries of the subpackage."""

from brindle.llm import manifest_queries, table_queries, text_queries  # noqa: F401
from brindle.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
