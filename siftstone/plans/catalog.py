"""All queries of the engine by name, with the SQL that gives the same rows."""

from __future__ import annotations

from siftstone.plans import corpus_queries, label_queries, output_queries, work_queries
from siftstone.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "corpus_queries", "label_queries", "output_queries", "work_queries"]
