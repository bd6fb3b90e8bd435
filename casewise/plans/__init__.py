"""Registered queries: each is a Spark plan over the driver tables plus its DuckDB oracle."""

from casewise.plans.catalog import ORACLES, QUERIES, load_all

__all__ = ["QUERIES", "ORACLES", "load_all"]
