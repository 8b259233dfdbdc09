"""Registered queries over the given tables, each beside the SQL it must agree with."""

from wardmill.catalog import checks, cleaning, keyed, loads, records, reports, shaping

MODULES = (cleaning, shaping, keyed, checks, reports, records, loads)


def all_queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
