"""Collects the queries of every family."""

from __future__ import annotations

from functools import wraps

from trawl.plans import approximate, dense, filters, lexical, mutation
from trawl.session import ship_package

FAMILIES = (dense, filters, lexical, mutation, approximate)


def all_queries():
    out = {}
    for family in FAMILIES:
        out.update({name: shipped(run) for name, run in family.QUERIES.items()})
    return out


def shipped(run):
    """Run a query with the package's code available on the workers."""
    @wraps(run)
    def query(spark, sf):
        ship_package(spark)
        return run(spark, sf)

    return query


def all_oracles():
    out = {}
    for family in FAMILIES:
        out.update(family.ORACLES)
    return out
