"""The corpus queries by name, over the test tables, with SQL where it can say the same."""

from __future__ import annotations

from chatweave.llm.queries import audits, language, native, pairs, search, texts, tokens

MODULES = (native, texts, tokens, search, language, pairs, audits)


def queries() -> dict:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
