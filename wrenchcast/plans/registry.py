"""All registered queries and their oracle SQL, by inventory key."""

from __future__ import annotations

from wrenchcast.plans import matrix_queries, ml_queries, relational_queries

QUERIES: dict = {}
ORACLE: dict = {}

for _module in (matrix_queries, relational_queries, ml_queries):
    overlap = set(QUERIES) & set(_module.QUERIES)
    if overlap:
        raise RuntimeError(f"duplicate query keys: {sorted(overlap)}")
    QUERIES.update(_module.QUERIES)
    ORACLE.update(_module.ORACLE)
