"""All registered queries of the library's own operators, with their DuckDB oracles."""

from __future__ import annotations

from claimloom.plans import claim_queries, contract_queries, outcome_queries, page_queries, text_queries

QUERIES: dict = {**claim_queries.QUERIES, **text_queries.QUERIES, **page_queries.QUERIES, **contract_queries.QUERIES, **outcome_queries.QUERIES}
ORACLE_SQL: dict[str, str] = {**claim_queries.ORACLE_SQL, **text_queries.ORACLE_SQL, **page_queries.ORACLE_SQL, **contract_queries.ORACLE_SQL, **outcome_queries.ORACLE_SQL}
