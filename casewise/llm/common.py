"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewise.session import checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the driver and all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worker_state(name: str, make, family: str | None = None):
    """``make()`` once per Python worker process, kept for the worker's later tasks.

    A worker keeps the states of one ``family`` (by default the name itself) at a time: asking for
    another one lets them go, so that a later stage does not carry the memory of an earlier one.
    """
    keep = sys.modules.setdefault("_casewise_worker_state", types.ModuleType("_casewise_worker_state"))
    held = keep.__dict__.setdefault("states", {})
    family = family or name
    for other in [k for k in held if k[0] != family]:
        del held[other]
    if (family, name) not in held:
        held[family, name] = make()
    return held[family, name]


def id_fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds


def text_hash(text_col: str) -> Column:
    """128 bits of a text's content as two longs; null and empty texts differ."""
    text = F.coalesce(F.col(text_col), F.lit("\x00null"))
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("second"), text).alias("b"))


def range_bounds(df: DataFrame, col: str, parts: int) -> list[int]:
    """At most ``parts - 1`` ascending cut points that split ``col`` into ranges of like size."""
    if parts < 2:
        return []
    found = df.select(F.col(col).cast("double").alias("x")).approxQuantile(
        "x", [i / parts for i in range(1, parts)], min(0.01, 0.2 / parts))
    return sorted({int(x) for x in found})


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
