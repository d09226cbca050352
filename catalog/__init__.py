"""Registered queries on the test tables, each with the SQL that recomputes its result."""

from __future__ import annotations

from catalog import cleaning, evaluation, features, models, overview, sources, targets, trees

MODULES = (sources, cleaning, targets, features, models, trees, evaluation, overview)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in MODULES for name, sql in module.SQL.items()}
