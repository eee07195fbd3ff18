"""Registered queries, by operator family, with the SQL they must agree with."""

from runlens.plans import calls, corpus, files, jobs, logs, monitor, nested, search, streams

FAMILIES = (calls, monitor, search, logs, nested, files, corpus, jobs, streams)


def all_queries():
    return {name: fn for family in FAMILIES for name, fn in family.QUERIES.items()}


def all_oracles():
    return {name: sql for family in FAMILIES for name, sql in family.ORACLES.items()}
