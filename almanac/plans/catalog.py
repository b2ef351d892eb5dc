"""All queries of the engine by name, with their SQL."""

from almanac.plans import derived, fixtures, tables

QUERIES = tables.QUERIES | derived.QUERIES | fixtures.QUERIES
ORACLE_SQL = tables.ORACLE_SQL | derived.ORACLE_SQL | fixtures.ORACLE_SQL
