"""Registered queries: each wires an operator to the tables, beside its SQL where there is one."""

from __future__ import annotations

from lectern.plans import accounting, audits, contracts, evidence, layers, measures, pages, records, relational, stateful
from lectern.plans.registry import Query

_MODULES = (accounting, relational, measures, contracts, records, evidence, layers, pages, audits, stateful)


def queries() -> dict[str, Query]:
    return {name: f for m in _MODULES for name, f in m.query.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.query.oracles.items()}
