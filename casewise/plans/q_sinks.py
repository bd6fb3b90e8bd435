"""Registered sink round trips (A3-A5): write with Spark, read back, report."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from casewise.operators import profile as P
from casewise.plans import sql as S
from casewise.plans.catalog import register
from casewise.plans.q_sampling import SEED, split_ctes
from casewise.session import checkpoint_dir
from casewise.sources import sinks as SK
from casewise.sources.views import cases_view


def _dir(spark, name):
    return os.path.join(checkpoint_dir(spark), "sinks", f"{name}-{uuid.uuid4().hex}")


@register("write_splits", S.with_cases(
    "SELECT f AS fmt, split, count(*) AS rows FROM sp, (VALUES ('parquet'), ('csv')) t(f) GROUP BY 1, 2",
    **split_ctes("cases")))
def q_write_splits(spark, sf_dir):
    """A3: raw/train/test written as Parquet and CSV, read back and counted."""
    from casewise.operators.sampling import stratified_split
    base = _dir(spark, "splits")
    sp = stratified_split(cases_view(spark, sf_dir), "case_status", "case_id", 0.2, SEED)
    SK.write_table(sp, f"{base}/parquet", "parquet", partition_by=["split"])
    SK.write_table(sp, f"{base}/csv", "csv", partition_by=["split"])
    out = None
    for fmt in ("parquet", "csv"):
        back = SK.read_table_at(spark, f"{base}/{fmt}", fmt)
        part = back.groupBy("split").agg(F.count(F.lit(1)).alias("rows")).withColumn("fmt", F.lit(fmt))
        out = part if out is None else out.unionByName(part)
    return out.select("fmt", "split", "rows")


def _reports_sql() -> str:
    from casewise.sources.views import CASE_COLUMNS
    parts = [f"SELECT '{c}' AS \"column\", CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS missing FROM cases"
             for c in CASE_COLUMNS]
    return S.with_cases("SELECT f AS fmt, \"column\", missing FROM m, (VALUES ('csv'), ('json')) t(f)",
                        m=" UNION ALL ".join(parts))


@register("write_reports", _reports_sql())
def q_write_reports(spark, sf_dir):
    """A4: missing-value report as CSV and JSON, read back."""
    base = _dir(spark, "reports")
    rep = P.missing_counts(cases_view(spark, sf_dir))
    SK.write_report(rep, f"{base}/missing_csv", "csv")
    SK.write_report(rep, f"{base}/missing_json", "json")
    a = SK.read_table_at(spark, f"{base}/missing_csv", "csv").withColumn("fmt", F.lit("csv"))
    b = SK.read_table_at(spark, f"{base}/missing_json", "json").withColumn("fmt", F.lit("json"))
    return a.select("fmt", "column", F.col("missing").cast("bigint")).unionByName(
        b.select("fmt", "column", F.col("missing").cast("bigint")))


def _features_sql() -> str:
    from casewise.plans.q_models import _prepare_sql
    return _prepare_sql(12, False)


@register("write_features", _features_sql())
def q_write_features(spark, sf_dir):
    """A5: the labelled train matrix to Parquet and back."""
    from pyspark.ml.functions import vector_to_array
    from casewise.plans.q_models import prepared
    base = _dir(spark, "features")
    prep = prepared(spark, sf_dir)
    SK.write_features(prep.train, f"{base}/train")
    back = SK.read_features(spark, f"{base}/train")
    return back.select("case_id", "label", F.size(vector_to_array("features")).alias("n_features"))
