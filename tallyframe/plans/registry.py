"""All queries of the library with their SQL, gathered from the plan modules."""

from __future__ import annotations


from tallyframe.plans import documents, masterdata, pages, payables, printed, scalars


def _modules():
    return [payables, scalars, masterdata, pages, documents, printed]


def queries():
    return {k: v for m in _modules() for k, v in m.QUERIES.items()}


def oracle_sql():
    return {k: v for m in _modules() for k, v in m.ORACLE.items()}
