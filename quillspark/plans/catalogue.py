"""All queries of the core with their SQL."""

from __future__ import annotations

from quillspark.plans import drawing, files, relational, rowsonly

MODULES = (files, relational, drawing, rowsonly)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in MODULES for k, v in m.SQL.items()}
