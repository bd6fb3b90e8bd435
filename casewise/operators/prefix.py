"""Exact running totals over a global order without a single-task window.

A window ``ORDER BY x`` with no partition runs in one task.  Instead ``x``
is cut into ranges by sampled boundaries (``percentile_approx`` over ``x``:
at most ``buckets - 1`` numbers, so the ranges are balanced even when values
cluster); the range index is a pure function of ``x`` (a binary-search
``CASE`` tree over the boundary literals), so recomputation after a lost
executor puts every row in the same range again.  Per-range totals (one row
per range) give each range's offset, and the running total inside a range is
an ordinary window partitioned by the range index.  Nothing is ordered in
a single task: the per-range offsets are as many numbers as shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def range_index(x: Column, bounds: Sequence) -> Column:
    """Number of ``bounds`` (sorted, distinct) that are <= x; NULL x -> 0."""
    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi + 1) // 2
        return F.when(x >= F.lit(bounds[mid - 1]), search(mid, hi)).otherwise(search(lo, mid - 1))
    return search(0, len(bounds))


def sampled_bounds(df: DataFrame, order_col: str, buckets: int) -> list:
    if buckets <= 1:
        return []
    probs = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.percentile_approx(F.col(order_col), probs, 10000).alias("b")).first()
    return sorted(set(v for v in (row["b"] or []) if v is not None))


def running_totals(df: DataFrame, order_col: str, value_cols: Sequence[str], partitions: int,
                   descending: bool = False, inclusive: bool = True,
                   suffix: str = "_cum") -> DataFrame:
    """Add ``<v><suffix>`` = sum of ``v`` over rows before (and, if
    ``inclusive``, at) each row in ``order_col`` order.  ``order_col`` must be
    unique (aggregate by it first)."""
    bounds = sampled_bounds(df, order_col, partitions)
    idx = range_index(F.col(order_col), bounds)
    if descending:
        idx = F.lit(len(bounds)) - idx
    ranged = df.withColumn("__rng", idx)
    # one row per range (as many as partitions were asked for): offsets become a literal array
    totals = {r["__rng"]: r for r in
              ranged.groupBy("__rng").agg(*[F.sum(v).alias(f"__t_{v}") for v in value_cols]).collect()}
    key = F.desc(order_col) if descending else F.asc(order_col)
    frame = Window.partitionBy("__rng").orderBy(key).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    out = ranged
    for v in value_cols:
        offsets, acc = [], 0
        for i in range(len(bounds) + 1):
            offsets.append(acc)
            acc += (totals[i][f"__t_{v}"] or 0) if i in totals else 0
        offset = F.element_at(F.array(*[F.lit(o) for o in offsets]), F.col("__rng") + 1)
        out = out.withColumn(f"{v}{suffix}", offset + F.coalesce(F.sum(v).over(frame), F.lit(0)))
    return out.drop("__rng")


def positions_within(df: DataFrame, group_col: str, order_col: str, partitions: int) -> DataFrame:
    """1-based position of each row within ``group_col`` by ``order_col``
    (rows must be distinct on the pair); works for any orderable type.

    The rows are range-partitioned on (group, order) and materialised once in
    the shared checkpoint folder, so partition ids are fixed; per (partition,
    group) counts -- at most partitions x groups numbers -- give offsets, and
    numbering inside a partition is a window over that partition only.
    """
    from casewise.session import cut_lineage
    ranged = cut_lineage(df.repartitionByRange(max(1, partitions), group_col, order_col)
                         .withColumn("__pid", F.spark_partition_id()))
    counts = ranged.groupBy("__pid", group_col).agg(F.count(F.lit(1)).alias("__c")).collect()
    offsets, acc = {}, {}
    for r in sorted(counts, key=lambda r: r["__pid"]):
        g = r[group_col]
        offsets[(r["__pid"], g)] = acc.get(g, 0)
        acc[g] = acc.get(g, 0) + r["__c"]
    spark = df.sparkSession
    off = spark.createDataFrame([(p, g, o) for (p, g), o in offsets.items()],
                                f"__pid int, {group_col} {df.schema[group_col].dataType.simpleString()}, "
                                "__off long")
    w = Window.partitionBy("__pid", group_col).orderBy(order_col)
    # ``off`` was built from the collected counts: partitions x groups rows at most
    return ranged.join(F.broadcast(off), ["__pid", group_col]) \
        .withColumn("position", (F.col("__off") + F.row_number().over(w)).cast("int")) \
        .drop("__pid", "__off")
