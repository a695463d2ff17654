"""Queries that combine the operators over the driver's tables."""

from . import engagement_queries, history_queries, label_queries, segment_queries, store_queries, table_queries, timeline_queries

MODULES = (timeline_queries, segment_queries, table_queries, store_queries, label_queries, history_queries, engagement_queries)
QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLE_SQL = {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
