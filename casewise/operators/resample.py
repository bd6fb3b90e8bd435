"""Class rebalancing (H1-H4) as Spark jobs.

SMOTE (Chawla et al. 2002) interpolates each synthetic point between a
minority row and one of its k nearest minority neighbours; ENN (Wilson 1972)
drops rows whose nearest neighbours disagree with their class; SMOTE+ENN
(Batista et al. 2004) chains them.  Randomness is a hash of (seed, id,
draw number), so the output does not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewise.operators.joins import bounded_broadcast
from casewise.operators.neighbors import enn_keep, knn_join
from casewise.operators.sampling import mark_lowest, seeded_hash
from casewise.session import cut_lineage

#: Stands between the source id and the draw number in a synthetic row's id (a fixed value).
MARK = "\u001f"


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """H4: n / (classes x n_c) per row (two classes: n / (2 n_c))."""
    counts = cut_lineage(df.groupBy(label).agg(F.count(F.lit(1)).alias("__nc")))  # one row per class
    k = counts.count()
    tot = counts.agg(F.sum("__nc")).first()[0]
    w = counts.select(label, (F.lit(float(tot)) / (F.lit(float(k)) * F.col("__nc"))).alias(out))
    return df.join(bounded_broadcast(w), label)  # one row per class, size-checked


def _digest(*parts) -> "F.Column":
    """First 13 hex digits of the md5 of the parts, as a whole number below 16 ** 13."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("long")


def smote(df: DataFrame, id_col: str, vec_col: str, label: str, minority, k: int = 5,
          seed: int = 42, target: int | None = None, draws_per_chunk: int = 100_000) -> DataFrame:
    """H1: synthetic minority rows until the minority reaches ``target``
    (default: the majority size).  Returns only the synthetic rows (``synthetic``
    true) with ``vec_col`` and ``label``; their id is text, the source row's id
    and the draw's number around ``MARK``, so it is new by construction.

    Every minority row gets floor(need / n_min) draws, and the rows with the
    lowest seeded hash one more, so exactly ``need`` rows are made.  A minority of
    fewer than two rows has no neighbour to draw towards and is an error.
    """
    minority_rows = df.where(F.col(label) == F.lit(minority)).select(id_col, vec_col)
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    size = sizes.agg(F.max("n").alias("most"), F.sum(F.when(F.col(label) == F.lit(minority), F.col("n"))).alias("own")).first()
    n_min = size["own"] or 0
    need = (target if target is not None else size["most"] or 0) - n_min
    kind = df.schema[label].dataType
    if need <= 0:
        return df.sparkSession.createDataFrame([], f"{id_col} string, {vec_col} array<double>, "
                                                   f"{label} {kind.simpleString()}, synthetic boolean")
    if n_min < 2:
        raise ValueError(f"class {minority!r} has {n_min} rows; synthetic rows need at least two")
    text_id = F.col(id_col).cast("string")
    if not minority_rows.where(text_id.contains(MARK)).isEmpty():
        raise ValueError(f"an id holds the separator of synthetic ids, {MARK!r}")
    base, extra = divmod(need, n_min)
    # one class, as an empty text of each row: a literal would turn the join with the quotas into a nested loop
    quotas = df.sparkSession.createDataFrame([("", extra)], "__cls string, __quota long")
    order_hash = seeded_hash(id_col, seed)
    marked = mark_lowest(minority_rows, F.substring(order_hash, 1, 0), order_hash, id_col, quotas, "__extra")
    draws = marked.withColumn("__n", F.lit(base) + F.col("__extra").cast("long")).where(F.col("__n") > 0)
    # a tiny minority can owe millions of draws per row: they are cut into chunks,
    # and the chunks spread over tasks, before they are expanded
    chunk = F.lit(draws_per_chunk).cast("long")
    draws = draws.withColumn("__chunk", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("__n") - 1) / chunk).cast("long")))).repartition(id_col, "__chunk")
    first = F.col("__chunk") * chunk + 1
    last = F.least(F.col("__n"), (F.col("__chunk") + 1) * chunk)
    draws = draws.withColumn("__draw", F.explode(F.sequence(first, last))).drop("__chunk")
    kk = min(k, n_min - 1)
    nb = cut_lineage(knn_join(minority_rows, minority_rows, kk, id_col=id_col, vec_col=vec_col,
                              exclude_self=True))  # computed once, read by the check and the join
    seeds = (F.lit(str(seed)), text_id, F.col("__draw").cast("string"))
    draws = draws.withColumn("rank", (_digest(*seeds, F.lit("nb")) % F.lit(kk) + 1).cast("int")) \
        .withColumn("__lam", _digest(*seeds, F.lit("gap")) / F.lit(float(16 ** 13)))
    # both lookup tables are minority-sized; broadcast them when that is small
    pick = draws.join(bounded_broadcast(nb.select(F.col("qid").alias(id_col), "rank", "rid")), [id_col, "rank"])
    nvec = minority_rows.select(F.col(id_col).alias("rid"), F.col(vec_col).cast("array<double>").alias("__nv"))
    pick = pick.join(bounded_broadcast(nvec, materialize=True), "rid")
    x = F.col(vec_col).cast("array<double>")
    synth = F.zip_with(x, F.col("__nv"), lambda a, b: a + F.col("__lam") * (b - a))
    return pick.select(F.concat(text_id, F.lit(MARK), F.col("__draw").cast("string")).alias(id_col), synth.alias(vec_col),
                       F.lit(minority).cast(kind).alias(label), F.lit(True).alias("synthetic"))


def enn_clean(df: DataFrame, id_col: str, vec_col: str, label: str, k: int = 3) -> DataFrame:
    """H2: keep rows whose k nearest neighbours (self excluded) all share their class."""
    nb = knn_join(df, df, k, id_col=id_col, vec_col=vec_col, exclude_self=True)
    keep = enn_keep(nb, df.select(F.col(id_col).alias("id"), F.col(label).alias("label")))
    return df.join(keep.where("keep").select(F.col("qid").alias(id_col)), id_col, "left_semi")


def smoteenn(df: DataFrame, id_col: str, vec_col: str, label: str, minority, k_smote: int = 5,
             k_enn: int = 3, seed: int = 42) -> DataFrame:
    """H3: SMOTE then ENN over the union (errors are raised, never hidden); ids become text."""
    src = df.select(id_col, F.col(vec_col).cast("array<double>").alias(vec_col), label) \
        .withColumn("synthetic", F.lit(False))
    own = src.withColumn(id_col, F.col(id_col).cast("string"))
    grown = own.unionByName(smote(src, id_col, vec_col, label, minority, k_smote, seed))
    grown = cut_lineage(grown)  # reused by the neighbour search twice
    return enn_clean(grown, id_col, vec_col, label, k_enn)


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


__all__ = ["class_weights", "smote", "enn_clean", "smoteenn", "class_sizes"]
