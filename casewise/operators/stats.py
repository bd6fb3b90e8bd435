"""Distribution statistics (D20-D25): skew, chi-square, histogram, box, KDE."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from numpy.polynomial.hermite import herm2poly
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from casewise.operators.joins import bounded_broadcast
from casewise.operators.profile import _stack
from casewise.operators.quantiles import group_quantiles
from casewise.session import cut_lineage


# --- D20 ------------------------------------------------------------------
def skewness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Bias-corrected sample skewness per column (pandas ``skew``): Spark's
    population skewness x sqrt(n(n-1)) / (n-2); NULL for n < 3."""
    stacked = _stack(df, cols, "double").where(F.col("value").isNotNull())
    g = stacked.groupBy("column").agg(F.count("value").alias("n"), F.skewness("value").alias("g1"))
    n = F.col("n").cast("double")
    return g.select("column", F.when(F.col("n") > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2))
                    .alias("skew"))


# --- D21 ------------------------------------------------------------------
def _upper_gamma_q(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised upper incomplete gamma Q(a, x) (series / continued fraction)."""
    out = np.empty_like(x, dtype=float)
    for i, (ai, xi) in enumerate(zip(a, x)):
        if not (ai > 0) or xi is None or math.isnan(xi):
            out[i] = float("nan")
            continue
        if xi <= 0:
            out[i] = 1.0
            continue
        gln = math.lgamma(ai)
        if xi < ai + 1.0:
            ap, s, d = ai, 1.0 / ai, 1.0 / ai
            for _ in range(10000):
                ap += 1.0
                d *= xi / ap
                s += d
                if abs(d) < abs(s) * 1e-16:
                    break
            out[i] = 1.0 - s * math.exp(-xi + ai * math.log(xi) - gln)
        else:
            tiny = 1e-300
            b = xi + 1.0 - ai
            c, d = 1.0 / tiny, 1.0 / b
            h = d
            for k in range(1, 10000):
                an = -k * (k - ai)
                b += 2.0
                d = an * d + b
                d = tiny if abs(d) < tiny else d
                c = b + an / c
                c = tiny if abs(c) < tiny else c
                d = 1.0 / d
                delta = d * c
                h *= delta
                if abs(delta - 1.0) < 1e-16:
                    break
            out[i] = math.exp(-xi + ai * math.log(xi) - gln) * h
    return out


@F.pandas_udf(DoubleType())
def chi2_sf(stat: pd.Series, dof: pd.Series) -> pd.Series:
    """Upper tail of the chi-square distribution (applied to one row per feature)."""
    return pd.Series(_upper_gamma_q(dof.to_numpy(dtype=float) / 2.0, stat.to_numpy(dtype=float) / 2.0))


def chi2_statistic(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Pearson chi-square of each feature against ``label`` (rows with a NULL
    in either are left out, as a crosstab does); Yates' correction when
    dof == 1.  Zero cells are never materialised for dof > 1:
    sum_all (O-E)^2/E = sum_observed [(O-E)^2/E - E] + N."""
    stacked = _stack(df.where(F.col(label).isNotNull()), features, ids=[label]) \
        .where(F.col("value").isNotNull())
    # the only pass over the data; every later step reads this aggregate
    cells = cut_lineage(stacked.groupBy("column", "value", label).agg(F.count(F.lit(1)).alias("o")))
    rows = cells.groupBy("column", label).agg(F.sum("o").alias("r"))
    cols = cells.groupBy("column", "value").agg(F.sum("o").alias("c"))
    tot = rows.groupBy("column").agg(F.sum("r").alias("n"), F.count(F.lit(1)).alias("nr"))
    ncol = cols.groupBy("column").agg(F.count(F.lit(1)).alias("nc"))
    dims = tot.join(ncol, "column").withColumn("dof", (F.col("nr") - 1) * (F.col("nc") - 1))
    dims = bounded_broadcast(dims, materialize=True)  # one row per feature
    e = F.col("r") * F.col("c") / F.col("n")
    general = cells.join(rows, ["column", label]).join(cols, ["column", "value"]).join(dims, "column") \
        .where(F.col("dof") != 1) \
        .groupBy("column").agg(F.sum((F.col("o") - e) ** 2 / e - e).alias("s"), F.first("n").alias("n")) \
        .select("column", (F.col("s") + F.col("n")).alias("statistic"))
    # dof == 1: a 2 x 2 table, all four cells built from the two margins
    two = dims.where(F.col("dof") == 1).select("column", "n")
    grid = rows.join(two, "column").join(cols, "column")  # 2 x 2 rows per feature
    grid = grid.join(cells, ["column", "value", label], "left").withColumn("o", F.coalesce("o", F.lit(0)))
    diff = e - F.col("o")
    corrected = F.col("o") + F.signum(diff) * F.least(F.lit(0.5), F.abs(diff))
    yates = grid.groupBy("column").agg(F.sum((corrected - e) ** 2 / e).alias("statistic"))
    stats = general.unionByName(yates)
    return stats.join(dims.select("column", "dof"), "column")


def chi2_independence(df: DataFrame, features: Sequence[str], label: str,
                      alpha: float = 0.05) -> DataFrame:
    """Statistic, dof, p-value and the hypothesis decision per feature."""
    st = chi2_statistic(df, features, label)
    p = chi2_sf(F.col("statistic"), F.col("dof").cast("double"))
    return st.withColumn("p_value", p).withColumn(
        "hypothesis", F.when(F.col("p_value") < alpha, "Reject null Hypothesis")
        .otherwise("Fail to reject null Hypothesis"))


# --- D23 ------------------------------------------------------------------
def auto_bins(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, k): the 'auto' bin count per column, as current NumPy: width =
    min(max(FD, sqrt_width / 2), Sturges) with FD = 2*IQR*n^(-1/3), sqrt_width
    = range/sqrt(n), Sturges = range/(log2(n)+1); k = ceil(range/width)."""
    stacked = _stack(df, cols, "double").where(F.col("value").isNotNull())
    q = group_quantiles(stacked, ["column"], "value", [0.25, 0.75], ["q1", "q3"], with_count=True,
                        extra={"lo": F.min, "hi": F.max})
    n = F.col("n").cast("double")
    rng_ = F.col("hi") - F.col("lo")
    sturges = rng_ / (F.log2(n) + F.lit(1.0))
    fd = F.lit(2.0) * (F.col("q3") - F.col("q1")) * F.pow(n, F.lit(-1.0 / 3.0))
    sqrt_half = rng_ / F.sqrt(n) / F.lit(2.0)
    width = F.least(F.greatest(fd, sqrt_half), sturges)
    k = F.when(width > 0, F.ceil(rng_ / width)).otherwise(F.lit(1)).cast("int")
    return q.select("column", k.alias("k"))


def histogram(df: DataFrame, cols: Sequence[str], bins: int | str, by: str | None = None) -> DataFrame:
    """Equal-width bins between each column's min and max (last bin closed),
    counted per ``by`` value; ``bins`` is a count or ``"auto"`` (per column)."""
    ids = [by] if by else []
    stacked = _stack(df, cols, "double", ids=ids).where(F.col("value").isNotNull())
    rng = stacked.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    if bins == "auto":
        rng = rng.join(auto_bins(df, cols), "column")
    else:
        rng = rng.withColumn("k", F.lit(int(bins)))
    rng = bounded_broadcast(rng, materialize=True)  # one row per column
    width = F.col("hi") - F.col("lo")
    kd = F.col("k").cast("double")
    b = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("lo")) / width * kd),
                                  F.col("k") - 1)).otherwise(F.lit(0)).cast("int")
    counted = stacked.join(rng, "column").withColumn("bin", b) \
        .groupBy("column", *ids, "bin", "lo", "hi", "k").agg(F.count(F.lit(1)).alias("count"))
    step = (F.col("hi") - F.col("lo")) / F.col("k").cast("double")
    return counted.select("column", *ids, "bin",
                          (F.col("lo") + F.col("bin") * step).alias("lower"),
                          (F.col("lo") + (F.col("bin") + 1) * step).alias("upper"), "count")


# --- D24 ------------------------------------------------------------------
def box_stats(df: DataFrame, group: str, value: str, whis: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (furthest points within 1.5 IQR) and outlier count per group."""
    src = df.where(F.col(group).isNotNull()).select(group, F.col(value).cast("double").alias("__x"))
    q = group_quantiles(src, [group], "__x", [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1")) \
        .withColumn("__lf", F.col("q1") - F.lit(whis) * F.col("iqr")) \
        .withColumn("__uf", F.col("q3") + F.lit(whis) * F.col("iqr"))
    j = src.join(bounded_broadcast(q, materialize=True), group)
    inside = (F.col("__x") >= F.col("__lf")) & (F.col("__x") <= F.col("__uf"))
    agg = j.groupBy(group).agg(
        F.min(F.when(inside, F.col("__x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("__x"))).alias("whisker_high"),
        F.count_if(~inside & F.col("__x").isNotNull()).alias("outliers"))
    return q.join(agg, group).select(group, "q1", "median", "q3", "iqr", "whisker_low",
                                     "whisker_high", "outliers")


# --- D25 ------------------------------------------------------------------
def kde(df: DataFrame, value: str, by: str | None = None, grid: int = 200, cut: float = 3.0,
        common_norm: bool = False, terms: int = 12, reach: float = 7.5) -> DataFrame:
    """Gaussian KDE (Scott bandwidth = sample std * n^(-1/5)) on ``grid``
    points spanning min - cut*bw .. max + cut*bw.

    A fast Gauss transform: the rows of a bucket of half a bandwidth are summed up as ``terms``
    power sums around its centre, and a bucket's Hermite series is evaluated at the points
    within ``reach`` bandwidths.  With a kernel's peak as unit, the series errs by less than
    0.25^terms / sqrt(terms!) (3e-12) and what lies out of reach by exp(-reach^2 / 2) (6e-13),
    whatever the data; the work after the one pass over the rows is (buckets x points in
    reach), so an outlier adds one bucket and a few points.  ``common_norm``
    scales each group's density by its share of the rows (the groups then
    integrate to 1 together).
    """
    keys = [by] if by else []
    x = F.col(value).cast("double")
    src = df.select(*keys, x.alias("__x")).where(F.col("__x").isNotNull())
    if by:
        src = src.where(F.col(by).isNotNull())
    st = src.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("__x").alias("lo"),
                                F.max("__x").alias("hi"), F.stddev_samp("__x").alias("sd"))
    st = st.withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    st = st.where(F.col("bw") > 0)
    if keys:
        st = bounded_broadcast(st, materialize=True)  # one row per group
        stat = {c: F.col(c) for c in ("n", "lo", "hi", "bw")}
        attach = lambda d: d.join(st, keys)
    else:
        row = st.first()  # one global row -> four scalars
        if row is None:
            return df.sparkSession.createDataFrame([], "point int, x double, density double")
        stat = {c: F.lit(row[c]) for c in ("n", "lo", "hi", "bw")}
        attach = lambda d: d
    n, lo, hi, bw = stat["n"], stat["lo"], stat["hi"], stat["bw"]
    centre = lo + (F.col("__b") + F.lit(0.5)) * (bw / F.lit(2.0))
    u = (F.col("__x") - centre) / (bw * F.lit(math.sqrt(2)))
    sums = attach(src).withColumn("__b", F.floor((F.col("__x") - lo) / (bw / F.lit(2.0)))).withColumn("__u", u) \
        .groupBy(*keys, "__b").agg(*[F.sum(F.pow("__u", F.lit(float(p)))).alias(f"__s{p}") for p in range(terms)])
    # sum_p s_p / p! H_p(v) as a polynomial in v
    hermite = [herm2poly([0.0] * p + [1.0]) / math.factorial(p) for p in range(terms)]
    sums = sums.select(*keys, "__b", *[
        sum((F.col(f"__s{p}") * F.lit(float(hermite[p][q])) for p in range(q, terms) if hermite[p][q]), F.lit(0.0)).alias(f"__a{q}")
        for q in range(terms)])
    start = lo - F.lit(cut) * bw
    step = (hi - lo + F.lit(2 * cut) * bw) / F.lit(float(grid - 1))
    gx = start + F.col("__g") * step
    first = F.greatest(F.lit(0), F.ceil((centre - F.lit(reach) * bw - start) / step).cast("int"))
    last = F.least(F.lit(grid - 1), F.floor((centre + F.lit(reach) * bw - start) / step).cast("int"))
    near = attach(sums).withColumns({"__first": first, "__last": last}).where("__first <= __last") \
        .withColumn("__g", F.explode(F.sequence("__first", "__last"))) \
        .withColumn("__v", (gx - centre) / (bw * F.lit(math.sqrt(2))))
    series = F.col(f"__a{terms - 1}")
    for q in reversed(range(terms - 1)):
        series = series * F.col("__v") + F.col(f"__a{q}")
    near = near.select(*keys, "__g", (series * F.exp(-F.col("__v") * F.col("__v"))).alias("__d"))
    points = (st if keys else df.sparkSession.range(1)).select(*keys, F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("__g"))
    dens = near.unionByName(points.withColumn("__d", F.lit(0.0))).groupBy(*keys, "__g").agg(F.sum("__d").alias("__d"))
    dens = attach(dens).select(*keys, "__g", gx.alias("x"), (
        F.greatest(F.col("__d"), F.lit(0.0)) / (n * bw * F.lit(math.sqrt(2 * math.pi)))).alias("density"))
    if common_norm and keys:  # each group's density weighted by its share of the rows
        total = st.agg(F.sum("n")).first()[0]
        shares = st.select(*keys, (F.col("n") / F.lit(float(total))).alias("__share"))
        dens = dens.join(bounded_broadcast(shares), keys).withColumn("density", F.col("density") * F.col("__share"))
    return dens.select(*keys, F.col("__g").alias("point"), "x", "density")
