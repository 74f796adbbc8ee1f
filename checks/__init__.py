"""Queries over the given tables, each beside the SQL that must give the same rows.

Every module shapes the tables like the engine's inputs, by the same simple
expressions in Spark and in SQL, and lists ``QUERIES`` and ``SQL`` by name.
"""

from __future__ import annotations

from checks import archives, commits, documents, files, jobs, labels, lookups, records, runs, scaling, stored, train

_MODULES = (scaling, train, documents, records, runs, labels, lookups, archives, files, stored, commits, jobs)


def all_queries():
    return {name: run for module in _MODULES for name, run in module.QUERIES.items()}


def all_sql():
    return {name: text for module in _MODULES for name, text in module.SQL.items()}
