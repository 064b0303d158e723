"""The registered queries of the library and their SQL."""

from __future__ import annotations

from .plans import corpus, documents, nested, runs, states, tables, web

MODULES = (documents, web, tables, states, corpus, nested, runs)


def queries() -> dict:
    return {name: run for m in MODULES for name, (run, _) in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, (_, sql) in m.QUERIES.items() if sql}
