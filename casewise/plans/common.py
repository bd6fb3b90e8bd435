"""Shared helpers for registered queries."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from casewise.session import checkpoint_dir


def dround(col: Column, digits: int = 6) -> Column:
    """round(x * 10^d) / 10^d, half away from zero, on the binary product --
    the arithmetic of the SQL oracle's ``round`` on DOUBLE, so exact ties
    resolve the same way on both sides."""
    scale = F.lit(float(10 ** digits))
    return F.round(col.cast("double") * scale, 0) / scale


def r6(c, name: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return dround(col, 6).alias(name or (c if isinstance(c, str) else "value"))


AS_OF_YEAR = 2025


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run's files, below the folder that all machines share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/runs/{name}-{uuid.uuid4().hex}"
