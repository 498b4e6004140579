"""All queries of this package and their SQL."""

from __future__ import annotations

from . import (queries_dedup, queries_documents, queries_models, queries_packing, queries_private, queries_runs,
               queries_url, queries_vectors)

_MODULES = [queries_url, queries_documents, queries_dedup, queries_models, queries_packing, queries_runs,
            queries_private, queries_vectors]
QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
