"""The ``cases`` view (A2): driver tables bound to the case-record roles.

``cases`` = orders JOIN customer JOIN nation JOIN region.  nation and region
are fixed-size dimensions and are broadcast behind a row-count check;
customer grows with the data, so orders/customer is a shuffle join on the
customer key (AQE may broadcast it at runtime if it is small).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewise.operators.joins import bounded_broadcast
from casewise.sources.tables import read_table

CASE_COLUMNS = [
    "case_id", "continent", "education_of_employee", "has_job_experience",
    "requires_job_training", "no_of_employees", "yr_of_estab",
    "region_of_employment", "prevailing_wage", "unit_of_wage",
    "full_time_position", "case_status", "score",
]
CATEGORICAL = ["continent", "education_of_employee", "has_job_experience",
               "requires_job_training", "region_of_employment", "unit_of_wage",
               "full_time_position"]
NUMERIC = ["no_of_employees", "yr_of_estab", "prevailing_wage"]
POSITIVE, NEGATIVE = "F", "O"

# Fixed values of the binding: market segment -> wage unit.
UNIT_BY_SEGMENT = {"MACHINERY": "Hour", "FURNITURE": "Week", "BUILDING": "Month"}
UNIT_OTHER = "Year"


def _flag(mod: int) -> "F.Column":
    return F.when(F.col("o_orderkey") % mod == 0, F.lit("Y")).otherwise(F.lit("N"))


def cases_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    dims = os.path.abspath(sf_dir)
    geo = nation.join(bounded_broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    geo = geo.select("n_nationkey", "n_name", "r_name")
    cust = customer.join(bounded_broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey"))
    joined = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))

    unit = None
    for seg, u in UNIT_BY_SEGMENT.items():
        cond = F.col("c_mktsegment") == seg
        unit = F.when(cond, u) if unit is None else unit.when(cond, u)
    unit = unit.otherwise(UNIT_OTHER)
    return joined.select(
        F.col("o_orderkey").alias("case_id"),
        F.col("r_name").alias("continent"),
        F.col("o_orderpriority").alias("education_of_employee"),
        _flag(2).alias("has_job_experience"),
        _flag(3).alias("requires_job_training"),
        F.floor("c_acctbal").cast("bigint").alias("no_of_employees"),
        F.year("o_orderdate").cast("bigint").alias("yr_of_estab"),
        F.col("n_name").alias("region_of_employment"),
        F.col("o_totalprice").alias("prevailing_wage"),
        unit.alias("unit_of_wage"),
        _flag(5).alias("full_time_position"),
        F.col("o_orderstatus").alias("case_status"),
        (F.col("o_totalprice") / F.lit(500000.0)).alias("score"),
    )


def cases_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cases`` with injected NULLs (wage /17, continent /19, status /23)."""
    c = cases_view(spark, sf_dir)
    k = F.col("case_id")
    return c.select(*[
        F.when(k % 17 == 0, F.lit(None).cast("double")).otherwise(F.col(n)).alias(n)
        if n == "prevailing_wage" else
        F.when(k % 19 == 0, F.lit(None).cast("string")).otherwise(F.col(n)).alias(n)
        if n == "continent" else
        F.when(k % 23 == 0, F.lit(None).cast("string")).otherwise(F.col(n)).alias(n)
        if n == "case_status" else F.col(n)
        for n in CASE_COLUMNS
    ])
