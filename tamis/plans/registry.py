"""All registered queries and their SQL, but for those of the numbered operators."""

from tamis.plans import catalogue, evalset_queries, evaluation_queries, ingest_queries, normalizer_queries, session_queries

MODULES = (catalogue, normalizer_queries, evalset_queries, evaluation_queries, ingest_queries, session_queries)
QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
