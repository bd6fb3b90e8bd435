"""Scans (A1): parquet / CSV / JSON readers with explicit or inferred schema."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Normalise float NaN to NULL (Spark orders NaN above every number)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def read_cases(spark: SparkSession, path: str, fmt: str = "csv",
               schema: StructType | str | None = None, nan_as_null: bool | None = None) -> DataFrame:
    """Read case records.

    CSV is read with a header; the schema is inferred when none is given
    (fine for exploration; pass ``schema`` in production to skip the extra
    inference pass).  Text formats may carry ``NaN`` for missing numbers, so
    they are normalised to NULL by default; columnar formats are returned as
    stored so filters on their columns still reach the scan.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
        if schema is None:
            reader = reader.option("inferSchema", True)
        df = reader.csv(path)
    elif fmt == "json":
        df = reader.json(path)
    elif fmt == "parquet":
        df = reader.parquet(path)
    else:
        df = reader.format(fmt).load(path)
    if nan_as_null is None:
        nan_as_null = fmt in ("csv", "json")
    return nan_to_null(df) if nan_as_null else df
