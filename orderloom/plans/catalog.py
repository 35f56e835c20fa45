"""All named plans."""

from __future__ import annotations

from . import analytics, checks, fact_overview, flows, intake, predict, rules

MODULES = [fact_overview, analytics, intake, rules, checks, predict, flows]


def queries():
    return {name: fn for m in MODULES for name, fn in m.reg.callables().items()}


def oracle_sql():
    return {name: sql for m in MODULES for name, sql in m.reg.sql.items()}
