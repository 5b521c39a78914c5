"""The registered queries: each operator run over a whole table, beside the SQL that must give the same rows."""

from __future__ import annotations

from papyrine.workload import cleaning, extras, files, hooks, outcome, pages, relevance, scoring, similar, stages
from papyrine.workload.inputs import Query

_MODULES = (cleaning, pages, relevance, stages, outcome, files, hooks, extras, similar, scoring)


def queries() -> dict[str, Query]:
    return {name: query for module in _MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
