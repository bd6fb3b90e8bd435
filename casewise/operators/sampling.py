"""Exact, seeded, partition-independent splits and samples.

Rows are ordered inside each class by ``md5(seed|id)`` (ties by id), so the
result never depends on partitioning or on ``rand()``.  Taking the ``k``
lowest hashes of a class is done without sorting the class:

1. a histogram of (class, hash prefix) -> rows, small after partial aggregation;
   the prefix grows with the table, so that about ``PREFIX_ROWS`` rows share one;
2. per class the *boundary* prefix where the running count reaches ``k``;
3. rows below the boundary are in, rows above are out -- a map-side
   decision after a broadcast join with the per-class table (no shuffle);
4. only the boundary prefix (about ``PREFIX_ROWS`` rows) is ranked
   with a window to settle the last places exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewise.operators.joins import bounded_broadcast
from casewise.session import cut_lineage

NULL_CLASS = "\u0000null"


def seeded_hash(id_col: str | Column, seed: int) -> Column:
    idc = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat_ws("|", F.lit(str(seed)), idc.cast("string")))


def class_key(label: str | None) -> Column:
    if label is None:
        return F.lit("all")
    return F.coalesce(F.col(label).cast("string"), F.lit(NULL_CLASS))


# rows expected below one hash prefix: what a single task ranks at the boundary
PREFIX_ROWS = 1_000


def prefix_length(df: DataFrame) -> int:
    """Hex digits of hash prefix that keep about ``PREFIX_ROWS`` rows below each, however large the table."""
    digits = math.ceil(math.log(max(1.0, df.count() / PREFIX_ROWS), 16))
    return min(32, max(2, digits))


def prefix_histogram(df: DataFrame, cls: Column, order_hash: Column, prefix: int) -> DataFrame:
    """(__cls, __b, __cnt): rows per class and hash prefix, materialised once in the shared checkpoint folder."""
    d = df.select(cls.alias("__cls"), F.substring(order_hash, 1, prefix).alias("__b"))
    return cut_lineage(d.groupBy("__cls", "__b").agg(F.count(F.lit(1)).alias("__cnt")))


def mark_lowest(df: DataFrame, cls: Column, order_hash: Column, id_col: str,
                quotas: DataFrame, out: str, prefix: int | None = None,
                hist: DataFrame | None = None) -> DataFrame:
    """Flag, per class, the ``quota`` rows with the lowest (hash, id).

    ``quotas`` holds ``__cls`` and ``__quota`` (one row per class).  The input
    is read twice: once for the prefix histogram, once for the decision.
    """
    prefix = prefix or prefix_length(df)
    hist = hist if hist is not None else prefix_histogram(df, cls, order_hash, prefix)
    w = Window.partitionBy("__cls").orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    runs = hist.withColumn("__incl", F.sum("__cnt").over(w)).join(quotas, "__cls")
    boundary = runs.where((F.col("__incl") - F.col("__cnt") < F.col("__quota"))
                          & (F.col("__incl") >= F.col("__quota"))) \
        .select("__cls", F.col("__b").alias("__bb"), (F.col("__incl") - F.col("__cnt")).alias("__before"))
    # one row per class, computed from the small checkpointed histogram
    per_class = cut_lineage(quotas.join(boundary, "__cls", "left"))
    d = df.withColumn("__cls", cls).withColumn("__h", order_hash) \
        .withColumn("__b", F.substring("__h", 1, prefix))
    d = d.join(bounded_broadcast(per_class), "__cls", "left")
    settled = d.where(F.col("__bb").isNull() | (F.col("__b") != F.col("__bb"))) \
        .withColumn(out, F.col("__bb").isNotNull() & (F.col("__b") < F.col("__bb")))
    wb = Window.partitionBy("__cls", "__b").orderBy("__h", id_col)
    edge = d.where(F.col("__b") == F.col("__bb")) \
        .withColumn(out, F.col("__before") + F.row_number().over(wb) <= F.col("__quota"))
    drop = ["__cls", "__h", "__b", "__bb", "__before", "__quota"]
    return settled.unionByName(edge).drop(*drop)


def allocate_split(counts: dict, test_frac: float) -> dict:
    """Per class test quota from per-class counts: n_test = ceil(frac * n);
    the training part is shared by class with largest remainders (ties: class
    order), each class's test quota is what remains of it."""
    n = sum(counts.values())
    n_train = n - int(math.ceil(float(test_frac) * n))
    cont = {c: float(n_train) * k / n for c, k in counts.items()} if n else {}
    floor = {c: int(math.floor(v)) for c, v in cont.items()}
    need = n_train - sum(floor.values())
    order = sorted(counts, key=lambda c: (-(cont[c] - floor[c]), c))
    train = {c: floor[c] + (1 if i < need else 0) for i, c in enumerate(order)}
    return {c: counts[c] - train[c] for c in counts}


def quotas_frame(spark, quotas: dict) -> DataFrame:
    return spark.createDataFrame([(c, int(q)) for c, q in quotas.items()], "__cls string, __quota long")


def class_counts(hist: DataFrame) -> dict:
    """Per-class row counts from the prefix histogram (one row per class)."""
    return {r["__cls"]: r["__n"] for r in hist.groupBy("__cls").agg(F.sum("__cnt").alias("__n")).collect()}


def stratified_split(df: DataFrame, label: str | None, id_col: str, test_frac: float = 0.2,
                     seed: int = 42, out: str = "split") -> DataFrame:
    """Adds ``split`` = 'test' / 'train'; stratified by ``label`` when it
    exists and has at least two non-NULL classes, else one class.  ``id_col``
    must be unique."""
    order_hash = seeded_hash(id_col, seed)
    has_label = label is not None and label in df.columns
    prefix = prefix_length(df)
    hist = prefix_histogram(df, class_key(label if has_label else None), order_hash, prefix)
    cls = class_key(label if has_label else None)
    counts = class_counts(hist)
    if has_label and len([c for c in counts if c != NULL_CLASS]) < 2:
        # not stratifiable: one class, histogram re-summed (small)
        cls = class_key(None)
        hist = hist.groupBy("__b").agg(F.sum("__cnt").alias("__cnt")).withColumn("__cls", F.lit("all"))
        counts = {"all": sum(counts.values())}
    quotas = quotas_frame(df.sparkSession, allocate_split(counts, test_frac))
    marked = mark_lowest(df, cls, order_hash, id_col, quotas, "__test", prefix, hist)
    return marked.withColumn(out, F.when(F.col("__test"), "test").otherwise("train")).drop("__test")


def stratified_sample(df: DataFrame, label: str, id_col: str, size: int, seed: int = 42,
                      positive=1) -> DataFrame:
    """Subset of ``size`` rows, s_pos = round_half_even(size * share_pos),
    s_neg = size - s_pos (each capped by its class), seeded by ``seed + size``."""
    cls = F.when(F.col(label) == F.lit(positive), "pos").otherwise("neg")
    order_hash = seeded_hash(id_col, seed + size)
    prefix = prefix_length(df)
    hist = prefix_histogram(df, cls, order_hash, prefix)
    counts = class_counts(hist)
    n = sum(counts.values())
    n_pos = counts.get("pos", 0)
    s_pos = int(round(size * (n_pos / n))) if n else 0  # Python round: half to even
    quotas = quotas_frame(df.sparkSession, {"pos": min(s_pos, n_pos),
                                            "neg": min(size - s_pos, counts.get("neg", 0))})
    marked = mark_lowest(df, cls, order_hash, id_col, quotas, "__in", prefix, hist)
    return marked.where("__in").drop("__in")


# Learning-curve subset sizes.
LEARNING_CURVE_SIZES = (1000, 3000, 6000, 12000)


def learning_curve_sizes(n: int, sizes=LEARNING_CURVE_SIZES) -> list[int]:
    """Sizes below ``n``, then ``n`` itself."""
    return [s for s in sizes if s < n] + [n]

