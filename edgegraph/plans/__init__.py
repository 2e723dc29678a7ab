"""Registered queries: one Spark plan per operator of the inventory, each with its DuckDB oracle SQL."""

from edgegraph.plans.catalog import queries, oracle_sql, REGISTRY  # noqa: F401
