"""All queries of the core and their SQL."""

from __future__ import annotations

from tesserae.plans import problems, reference, reference_sql

QUERIES = {**reference.QUERIES, **problems.QUERIES}
SQL = {**reference_sql.SQL, **problems.SQL}
