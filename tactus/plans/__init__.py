"""Registered queries with their oracle SQL."""

from tactus.plans import network, signal, tabular, timeline

QUERIES = {**timeline.QUERIES, **signal.QUERIES, **tabular.QUERIES, **network.QUERIES}
ORACLE_SQL = {**timeline.ORACLE_SQL, **signal.ORACLE_SQL, **tabular.ORACLE_SQL, **network.ORACLE_SQL}
