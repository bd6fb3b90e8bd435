"""Join helpers (C1): size-checked broadcast, lookups with defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, MapType, StringType, StructType,
                               UserDefinedType)

from casewise.session import cut_lineage

# Largest side that is ever broadcast explicitly, in bytes and in rows (the row
# bound also limits what the check reads).  Anything bigger is left to a shuffle
# join (AQE may still turn it into a broadcast, behind its own byte threshold).
BROADCAST_MAX_BYTES = 32 << 20
BROADCAST_MAX_ROWS = 200_000


def _row_bytes(df: DataFrame) -> Column:
    """Approximate size of a row: text and collections by their printed length, the rest 8 bytes."""
    total = F.lit(8 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            total = total + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            total = total + F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0))
        elif isinstance(f.dataType, UserDefinedType):
            total = total + F.lit(1 << 16)  # a vector of unknown width
    return total


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES,
                      materialize: bool = False) -> DataFrame:
    """Broadcast ``df`` only after checking that it holds at most ``max_bytes`` and ``max_rows``.

    The check reads at most ``max_rows + 1`` rows.  On a derived table (an
    aggregate, a join) the check would compute it once and the join again, so
    ``materialize`` first writes it to the shared checkpoint folder and both
    read that copy.  Nothing is remembered between calls: a table that grew is
    checked anew.
    """
    if materialize:
        df = cut_lineage(df)
    size = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).first()
    return F.broadcast(df) if size["n"] <= max_rows and (size["b"] or 0) <= max_bytes else df


def lookup_with_default(df: DataFrame, key: str, table: DataFrame, table_key: str, value: str,
                        default: Column, out: str,
                        max_rows: int = BROADCAST_MAX_ROWS, materialize: bool = False) -> DataFrame:
    """Left-join ``table(table_key, value)`` on ``df[key]``; missing keys take ``default``.

    NULL keys never match (as a dict lookup of a missing key), so they take
    the default too.
    """
    t = table.select(F.col(table_key).alias("__lk_key"), F.col(value).alias("__lk_val"))
    joined = df.join(bounded_broadcast(t, max_rows, materialize=materialize), df[key] == F.col("__lk_key"), "left")
    return joined.withColumn(out, F.coalesce(F.col("__lk_val"), default)).drop("__lk_key", "__lk_val")
