"""Registered queries. Importing this package fills ``QUERIES`` and ``ORACLE``."""

from .registry import ORACLE, QUERIES  # noqa: F401
from . import algorithm_queries, clause_queries, function_queries, mutation_queries, patterns, table_queries, vector_queries  # noqa: F401, E402
