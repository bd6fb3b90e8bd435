"""Registered serving-side profile and diagnosis queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewise.operators import profile as P
from casewise.plans import sql as S
from casewise.plans.catalog import register
from casewise.plans.common import r6
from casewise.plans.q_profile import stack_sql
from casewise.plans.q_sampling import _nulls_split, split_ctes
from casewise.sources.views import CATEGORICAL, NUMERIC, cases_nulls

META_SCHEMA = "kind string, column string, position int, value string, min double, max double, " \
              "p50 double, rows bigint"


def meta_profile(df):
    """Category domains, numeric ranges and the row count as rows of one result."""
    dom = P.category_domain(df, CATEGORICAL).select(
        F.lit("category").alias("kind"), "column", "position", "value",
        *[F.lit(None).cast("double").alias(c) for c in ("min", "max", "p50")],
        F.lit(None).cast("bigint").alias("rows"))
    rng = P.numeric_range(df, NUMERIC).select(
        F.lit("range").alias("kind"), "column", F.lit(None).cast("int").alias("position"),
        F.lit(None).cast("string").alias("value"), r6("min"), r6("max"), r6("p50"),
        F.lit(None).cast("bigint").alias("rows"))
    cnt = df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("rows").alias("kind"), F.lit(None).cast("string").alias("column"),
        F.lit(None).cast("int").alias("position"), F.lit(None).cast("string").alias("value"),
        *[F.lit(None).cast("double").alias(c) for c in ("min", "max", "p50")], "rows")
    return dom.unionByName(rng).unionByName(cnt)


@register("meta_profile", S.with_cases(
    f"""SELECT 'category' AS kind, "column", CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) AS INTEGER)
       AS position, value, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, CAST(NULL AS DOUBLE) AS p50,
       CAST(NULL AS BIGINT) AS rows
FROM (SELECT DISTINCT "column", value FROM c WHERE value IS NOT NULL)
UNION ALL
SELECT 'range', "column", NULL, NULL, round(min(value), 6), round(max(value), 6), round(median(value), 6), NULL
FROM n GROUP BY "column" HAVING count(value) > 0
UNION ALL SELECT 'rows', NULL, NULL, NULL, NULL, NULL, NULL, count(*) FROM cases_nulls""",
    nulls=True, c=stack_sql(CATEGORICAL), n=stack_sql(NUMERIC, cast="DOUBLE")))
def q_meta_profile(spark, sf_dir):
    return meta_profile(cases_nulls(spark, sf_dir))


def diagnose_split(df, target: str, split_col: str = "split"):
    """G11 in one pass over a frame holding both splits."""
    from pyspark.sql import Window
    counts = df.groupBy(F.col(target).alias("cls"), F.col(split_col).alias("split")) \
        .agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("split")  # a handful of rows per split
    return counts.withColumn("baseline", F.max("count").over(w) / F.sum("count").over(w))


@register("diagnose", S.with_cases(
    """SELECT case_status AS cls, count(*) AS count, split,
       round(max(count(*)) OVER (PARTITION BY split) / sum(count(*)) OVER (PARTITION BY split), 6) AS baseline
FROM sp GROUP BY case_status, split""", nulls=True, **split_ctes("cases_nulls")))
def q_diagnose(spark, sf_dir):
    out = diagnose_split(_nulls_split(spark, sf_dir), "case_status")
    return out.select("cls", "count", "split", r6("baseline"))
