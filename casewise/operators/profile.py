"""Profiling aggregates.

Every operator is one or two aggregates.  Where a share needs a group total,
the total comes from a second (tiny) aggregate joined back on the group key
rather than from a window: a window ``partition by column`` would put a
whole high-cardinality column into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewise.functions.columns import is_numeric_type
from casewise.operators.joins import bounded_broadcast
from casewise.operators.quantiles import group_quantiles
from casewise.session import cut_lineage


def _stack(df: DataFrame, cols: Sequence[str], value_type: str = "string",
           ids: Sequence[str] = ()) -> DataFrame:
    """Unpivot ``cols`` into (column, value) rows, keeping ``ids``."""
    cast = df.select(*ids, *[F.col(c).cast(value_type).alias(c) for c in cols])
    return cast.unpivot(list(ids), list(cols), "column", "value")


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """(value, count), most frequent first."""
    src = df.where(F.col(col).isNotNull()) if dropna else df
    return src.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count")) \
        .orderBy(F.desc("count"), "value")


def value_share(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Percentage of each non-null value within its column."""
    counts = cut_lineage(_stack(df, cols).where(F.col("value").isNotNull())
                         .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count")))
    totals = counts.groupBy("column").agg(F.sum("count").alias("__total"))  # from the stored counts
    return counts.join(bounded_broadcast(totals), "column").select(
        "column", "value", "count", (F.lit(100.0) * F.col("count") / F.col("__total")).alias("percent"))


def status_share_by(df: DataFrame, group: str, label: str) -> DataFrame:
    """D3: label distribution (percent) within each group; NULL keys dropped."""
    src = df.where(F.col(group).isNotNull() & F.col(label).isNotNull())
    counts = cut_lineage(src.groupBy(group, label).agg(F.count(F.lit(1)).alias("count")))
    totals = counts.groupBy(group).agg(F.sum("count").alias("__total"))  # from the stored counts
    return counts.join(bounded_broadcast(totals), group).select(
        group, label, "count", (F.lit(100.0) * F.col("count") / F.col("__total")).alias("percent"))


def positive_rate_by(df: DataFrame, group: str, label: str, positive: str) -> DataFrame:
    """100 * positives / rows per group; NULL (not 0) when a group has
    no positive row, as index-aligned division of two value counts gives."""
    src = df.where(F.col(group).isNotNull())
    pos = F.count_if(F.col(label) == F.lit(positive))
    return src.groupBy(group).agg(
        (F.lit(100.0) * F.nullif(pos, F.lit(0)) / F.count(F.lit(1))).alias("positive_rate"),
        F.count(F.lit(1)).alias("count"))


def count_by_two(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts per (a, b)."""
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull()) \
        .groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))


def crosstab(df: DataFrame, row: str, col: str, values: Sequence[str]) -> DataFrame:
    """Contingency table, one column per listed ``col`` value, zeros filled.

    The pivot values are passed explicitly so no extra job discovers them.
    """
    src = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    out = src.groupBy(row).pivot(col, list(values)).agg(F.count(F.lit(1)))
    return out.na.fill(0, subset=list(values))


def group_mean_sorted(df: DataFrame, group: str, value: str) -> DataFrame:
    """Mean per group, highest first."""
    return df.where(F.col(group).isNotNull()).groupBy(group) \
        .agg(F.avg(value).alias("mean")).orderBy(F.desc("mean"), group)


def group_median(df: DataFrame, group: str, value: str) -> DataFrame:
    """Exact median per group (average of the middle pair)."""
    return group_quantiles(df.where(F.col(group).isNotNull()), [group], value, [0.5], ["median"])


def global_median(df: DataFrame, value: str) -> DataFrame:
    """NaN-ignoring median of a column."""
    return group_quantiles(df, [], value, [0.5], ["median"])


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max per numeric column."""
    stacked = _stack(df, cols, "double")
    moments = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    out = group_quantiles(stacked, ["column"], "value", [0.25, 0.5, 0.75], ["p25", "p50", "p75"],
                          extra=moments)  # moments ride in the pass that sizes the groups
    return out.select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def info(df: DataFrame) -> DataFrame:
    """Non-null count and type per column."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]) \
        .unpivot([], df.columns, "column", "non_null")
    meta = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)],
        "position int, column string, dtype string")
    # ``meta`` has one row per column of the schema: bounded by construction
    return F.broadcast(meta).join(counts, "column").select("position", "column", "non_null", "dtype")


def missing_counts(df: DataFrame) -> DataFrame:
    """NULL count per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]) \
        .unpivot([], df.columns, "column", "missing")


def missing_percent_frame(df: DataFrame, name: str) -> DataFrame:
    return df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns]) \
        .unpivot([], df.columns, "column", name)


def missing_percent(train: DataFrame, test: DataFrame, digits: int = 2) -> DataFrame:
    """D13 + C3: % NULL per column in both splits, outer-aligned on the column
    name, rounded half-even, highest train share first."""
    a = missing_percent_frame(train, "__tr")
    b = missing_percent_frame(test, "__te")
    out = a.join(b, "column", "full").select(
        "column",
        F.bround(F.lit(100.0) * F.col("__tr"), digits).alias("missing_train_percent"),
        F.bround(F.lit(100.0) * F.col("__te"), digits).alias("missing_test_percent"))
    return out.orderBy(F.desc_nulls_last("missing_train_percent"), "column")


def missing_percent_split(df: DataFrame, split_col: str = "split", train: str = "train",
                          test: str = "test", digits: int = 2) -> DataFrame:
    """D13 + C3 in one pass over a frame holding both splits: a conditional
    mean per (column, split) -- ``avg`` skips the NULLs of the other split --
    then one row per column, rounded half-even, highest train share first."""
    cols = [c for c in df.columns if c != split_col]
    aggs = []
    for c in cols:
        miss = F.col(c).isNull().cast("double")
        aggs += [F.avg(F.when(F.col(split_col) == train, miss)).alias(f"{c}__tr"),
                 F.avg(F.when(F.col(split_col) == test, miss)).alias(f"{c}__te")]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__tr").alias("tr"),
                                        F.col(f"{c}__te").alias("te")) for c in cols]))
    out = wide.select(rows.alias("r")).select(
        "r.column", F.bround(F.lit(100.0) * F.col("r.tr"), digits).alias("missing_train_percent"),
        F.bround(F.lit(100.0) * F.col("r.te"), digits).alias("missing_test_percent"))
    return out.orderBy(F.desc_nulls_last("missing_train_percent"), "column")


def missing_percent_over(df: DataFrame, min_missing: int = 1, digits: int = 4) -> DataFrame:
    """D13 variant: only columns with more than ``min_missing`` NULLs."""
    counts = missing_counts(df)
    n = F.lit(df.count())
    return counts.where(F.col("missing") > min_missing).select(
        "column", F.bround(F.lit(100.0) * F.col("missing") / n, digits).alias("missing_percent"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows after the first of identical rows (NULLs compare equal).

    Rows are grouped by a 128-bit hash first; whole rows are compared only
    where a hash occurs more than once.
    """
    names = [f"c{i}" for i in range(len(df.columns))]
    rows = df.toDF(*names)
    nulls = F.concat_ws("", *[F.col(c).isNull().cast("int").cast("string") for c in names])
    rows = rows.withColumns({"__a": F.xxhash64(nulls, *names), "__b": F.xxhash64(F.lit("second"), nulls, *names)})
    twice = rows.groupBy("__a", "__b").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1).select("__a", "__b")
    groups = rows.join(twice, ["__a", "__b"], "left_semi").groupBy(*names).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def distinct_count(df: DataFrame, cols: Sequence[str], count_null: bool = False,
                   approx: bool = False) -> DataFrame:
    """Distinct non-NULL values per column (+1 when NULL is present and
    ``count_null``); ``approx`` uses HyperLogLog++ for very large columns."""
    aggs = []
    for c in cols:
        d = F.approx_count_distinct(c) if approx else F.count_distinct(c)
        if count_null:
            d = d + F.max(F.col(c).isNull().cast("int"))
        aggs.append(d.cast("bigint").alias(c))
    return df.agg(*aggs).unpivot([], list(cols), "column", "n_distinct")


def category_domain(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sorted distinct non-NULL text values per column, as rows
    (column, position, value) so no domain is gathered into one row."""
    from pyspark.sql import Window

    from casewise.operators.joins import BROADCAST_MAX_ROWS
    from casewise.operators.prefix import positions_within
    vals = cut_lineage(_stack(df, cols).where(F.col("value").isNotNull()).distinct())
    if vals.limit(BROADCAST_MAX_ROWS + 1).count() <= BROADCAST_MAX_ROWS:
        # proven small: a window per column over at most that many rows
        w = Window.partitionBy("column").orderBy("value")
        return vals.withColumn("position", F.row_number().over(w)).select("column", "position", "value")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return positions_within(vals, "column", "value", parts).select("column", "position", "value")


def numeric_range(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Min, max, exact median per numeric column, only if any non-NULL."""
    stacked = _stack(df, cols, "double")
    out = group_quantiles(stacked, ["column"], "value", [0.5], ["p50"], with_count=True,
                          extra={"min": F.min, "max": F.max})
    return out.where(F.col("n") > 0).select("column", "min", "max", "p50")


def label_domain(df: DataFrame, label: str, limit: int | None = None) -> DataFrame:
    """Distinct labels as text, sorted; ``limit`` cuts a printed sample only."""
    vals = df.select(F.col(label).cast("string").alias("value")).where(F.col("value").isNotNull()) \
        .distinct()
    return vals.orderBy("value") if limit is None else vals.orderBy("value").limit(limit)


def expected_classes_found(df: DataFrame, label: str, classes: Sequence[str]) -> DataFrame:
    """One row telling whether every expected class occurs."""
    found = df.select(F.col(label).cast("string").alias("value")).where(
        F.col("value").isin(*classes)).agg(F.count_distinct("value").alias("n"))
    return found.select((F.col("n") == len(set(classes))).alias("all_found"))


def majority_baseline(df: DataFrame, label: str) -> DataFrame:
    """Share of the largest class, NULL counted as a class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    return counts.agg((F.max("__n") / F.sum("__n")).alias("majority_share"),
                      F.sum("__n").alias("rows"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric_type(f.dataType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not is_numeric_type(f.dataType)]
