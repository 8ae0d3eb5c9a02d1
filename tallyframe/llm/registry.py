"""The queries opN_<name> of this subpackage and their SQL."""

from __future__ import annotations

from tallyframe.llm import queries_native, queries_scores, queries_text

_MODULES = [queries_text, queries_native, queries_scores]


def queries():
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracle_sql():
    return {k: v for m in _MODULES for k, v in m.ORACLE.items()}
