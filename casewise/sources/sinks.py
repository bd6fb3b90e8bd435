"""Sinks (A3-A5): tables, reports and feature matrices, written by executors.

Nothing is gathered on the driver: every writer is ``DataFrame.write``.
Reports are ordinary (small) DataFrames written as JSON / CSV / Parquet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

FORMATS = ("parquet", "csv", "json", "orc")


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> str:
    """A3: write a table (CSV with a header)."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt}")
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    return path


def read_table_at(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
        if schema is None:
            r = r.option("inferSchema", True)
    return r.format(fmt).load(path)


def write_report(df: DataFrame, path: str, fmt: str = "json") -> str:
    """A4: a report DataFrame (missing report, schema, validation report) as one file."""
    w = df.coalesce(1).write.mode("overwrite")  # reports are a few rows
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    return path


def write_features(df: DataFrame, path: str, features: str = "features", label: str = "label") -> str:
    """A5: labelled feature matrix (vector column) to Parquet."""
    df.write.mode("overwrite").parquet(path)
    return path


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
