"""The registered queries over the driver's tables, and the SQL each is checked against."""

from trawl.plans.registry import all_oracles, all_queries

__all__ = ["all_oracles", "all_queries"]
