"""Registered scans and views (A1, A2)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from casewise.plans import sql as S
from casewise.plans.catalog import register
from casewise.plans.common import run_dir
from casewise.sources.tables import read_cases
from casewise.sources.views import cases_nulls, cases_view


@register("scan_cases", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def scan_cases(spark, sf_dir):
    """A1: generic reader over the whole table; the projection reaches the Parquet scan."""
    df = read_cases(spark, os.path.join(sf_dir, "orders.parquet"), fmt="parquet")
    return df.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


_TEXT, _NUMBER = ["continent", "education_of_employee", "case_status"], ["no_of_employees", "yr_of_estab", "prevailing_wage"]
_PROFILE = [("rows", "count(*)"), ("ids", "count(DISTINCT case_id)"),
            *[(f"n_{c}", f"count({c})") for c in _TEXT + _NUMBER],
            *[(f"sum_{c}", f"round(sum(CAST({c} AS DOUBLE)), 2)") for c in _NUMBER]]


@register("csv_roundtrip", S.with_cases(
    "SELECT m AS mode, " + ", ".join(f"{sql} AS {name}" for name, sql in _PROFILE)
    + " FROM cases_nulls, (VALUES ('schema'), ('inferred')) t(m) GROUP BY 1", nulls=True))
def q_csv_roundtrip(spark, sf_dir):
    """A1: the view written as CSV and read again, with its schema and by inference."""
    path = run_dir(spark, "csv")
    view = cases_nulls(spark, sf_dir)
    view.write.option("header", True).csv(path)
    both = [read_cases(spark, path, "csv", schema=view.schema), read_cases(spark, path, "csv")]
    out = [df.agg(*[F.expr(sql).alias(name) for name, sql in _PROFILE]).withColumn("mode", F.lit(mode))
           for df, mode in zip(both, ("schema", "inferred"))]
    return out[0].unionByName(out[1]).select("mode", *[name for name, _ in _PROFILE])


@register("cases_view", S.with_cases("SELECT * FROM cases"))
def q_cases_view(spark, sf_dir):
    """A2: the star-join binding of the case-record roles."""
    return cases_view(spark, sf_dir)


@register("cases_nulls", S.with_cases("SELECT * FROM cases_nulls", nulls=True))
def q_cases_nulls(spark, sf_dir):
    """A2 variant with injected NULLs."""
    return cases_nulls(spark, sf_dir)
