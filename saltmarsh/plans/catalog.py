"""All queries of the engine and their SQL."""

from __future__ import annotations

from . import compounds, documents, papers, scalars, stages, streams

QUERIES = {**papers.QUERIES, **documents.QUERIES, **compounds.QUERIES, **scalars.QUERIES, **stages.QUERIES, **streams.QUERIES}
ORACLE_SQL = {**papers.ORACLE_SQL, **documents.ORACLE_SQL, **compounds.ORACLE_SQL, **scalars.ORACLE_SQL, **stages.ORACLE_SQL, **streams.ORACLE_SQL}
