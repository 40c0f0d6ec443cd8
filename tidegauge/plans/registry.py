"""All queries of the library by name."""

from __future__ import annotations

from . import analyses, audits, editions, files, marts, places, published, sql

QUERIES = marts.QUERIES | analyses.QUERIES | audits.QUERIES | editions.QUERIES | files.QUERIES | places.QUERIES | published.QUERIES
SQL = sql.SQL | analyses.SQL | audits.SQL | editions.SQL | files.SQL | places.SQL | published.SQL
