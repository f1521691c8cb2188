"""Every operator as a query over the standard tables, with equivalent SQL where SQL can say it."""

from __future__ import annotations

from workload import collect, combine, detect, expressions, fix, learn, profile, sample, search, stream

MODULES = [collect, expressions, combine, detect, profile, fix, sample, search, learn, stream]


def all_queries():
    return {name: case[0] for m in MODULES for name, case in m.CASES.items()}


def all_sql():
    return {name: case[1] for m in MODULES for name, case in m.CASES.items() if case[1] is not None}
