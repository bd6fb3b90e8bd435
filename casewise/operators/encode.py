"""Encoders and fitted column transforms as Spark ML stages.

Each estimator learns a handful of numbers per column in one or a few
aggregate passes and applies them with Column expressions (no UDF), so the
stages sit inside a ``Pipeline`` and persist with it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewise.operators.profile import _stack
from casewise.operators.quantiles import column_quantile


class _Cols(HasInputCols, HasOutputCols):
    def _pairs(self):
        ins = self.getInputCols()
        outs = self.getOutputCols() if self.isDefined(self.outputCols) else ins
        return list(zip(ins, outs))


def _with(df: DataFrame, pairs, exprs) -> DataFrame:
    """Replace / add output columns in one projection."""
    outs = {o: e for (_, o), e in zip(pairs, exprs)}
    cols = [outs.pop(c).alias(c) if c in outs else F.col(c) for c in df.columns]
    cols += [e.alias(o) for o, e in outs.items()]
    return df.select(*cols)


# --- F7 ---------------------------------------------------------------------
class ModeImputerModel(Model, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    fills = Param(Params._dummy(), "fills", "fill value per input column", TypeConverters.toListString)

    def _transform(self, df):
        pairs = self._pairs()
        vals = self.getOrDefault(self.fills)
        return _with(df, pairs, [F.coalesce(F.col(i).cast("string"), F.lit(v)) for (i, _), v in zip(pairs, vals)])


class ModeImputer(Estimator, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    """Most frequent non-NULL value per column; ties go to the smallest value."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df):
        cols = self.getInputCols()
        counts = _stack(df, cols).where(F.col("value").isNotNull()) \
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        top = counts.groupBy("column").agg(F.max("n").alias("n"))
        modes = counts.join(top, ["column", "n"]).groupBy("column").agg(F.min("value").alias("mode"))
        found = {r["column"]: r["mode"] for r in modes.collect()}  # one row per column
        m = ModeImputerModel()
        m._set(inputCols=cols, fills=[found.get(c) for c in cols])
        if self.isDefined(self.outputCols):
            m._set(outputCols=self.getOutputCols())
        return m


# --- F8 ---------------------------------------------------------------------
class MedianImputerModel(Model, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    fills = Param(Params._dummy(), "fills", "fill value per input column", TypeConverters.toListFloat)

    def _transform(self, df):
        pairs = self._pairs()
        vals = self.getOrDefault(self.fills)
        return _with(df, pairs, [F.coalesce(F.col(i).cast("double"), F.lit(v)) for (i, _), v in zip(pairs, vals)])


class MedianImputer(Estimator, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    """Exact median per column (``ml.feature.Imputer`` uses an approximate one)."""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df):
        cols = self.getInputCols()
        found = column_quantile(df, cols)  # one number per column
        m = MedianImputerModel()
        m._set(inputCols=cols, fills=[float(found.get(c) if found.get(c) is not None else float("nan"))
                                      for c in cols])
        if self.isDefined(self.outputCols):
            m._set(outputCols=self.getOutputCols())
        return m


# --- F13 --------------------------------------------------------------------
class PopulationScalerModel(Model, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "column means", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "population std (0 -> 1)", TypeConverters.toListFloat)

    def _transform(self, df):
        pairs = self._pairs()
        mu, sd = self.getOrDefault(self.means), self.getOrDefault(self.stds)
        return _with(df, pairs, [(F.col(i).cast("double") - F.lit(m)) / F.lit(s)
                                 for (i, _), m, s in zip(pairs, mu, sd)])


def _scale_stats(df: DataFrame, exprs: dict[str, Column]):
    aggs = []
    for c, e in exprs.items():
        aggs += [F.avg(e).alias(f"{c}__m"), F.stddev_pop(e).alias(f"{c}__s")]
    row = df.agg(*aggs).first()
    means = [float(row[f"{c}__m"]) if row[f"{c}__m"] is not None else 0.0 for c in exprs]
    stds = []
    for c in exprs:
        s = row[f"{c}__s"]
        stds.append(1.0 if s is None or s == 0 or math.isnan(s) else float(s))
    return means, stds


class PopulationScaler(Estimator, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / population std; a zero std divides by 1.
    (``ml.feature.StandardScaler`` uses the n-1 std.)"""

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df):
        cols = self.getInputCols()
        means, stds = _scale_stats(df, {c: F.col(c).cast("double") for c in cols})
        m = PopulationScalerModel()
        m._set(inputCols=cols, means=means, stds=stds)
        if self.isDefined(self.outputCols):
            m._set(outputCols=self.getOutputCols())
        return m


# --- F11 / F12 --------------------------------------------------------------
LAMBDA_EPS = 1e-12
LAMBDA_FAR = 1e4  # beyond it a column has no finite best exponent


def yeo_johnson(x: Column, lam: float) -> Column:
    """The four-branch Yeo-Johnson transform psi(x, lambda)."""
    pos = (F.log1p(x) if abs(lam) < LAMBDA_EPS
           else (F.pow(x + F.lit(1.0), F.lit(lam)) - F.lit(1.0)) / F.lit(lam))
    neg = (-F.log1p(-x) if abs(lam - 2.0) < LAMBDA_EPS
           else -(F.pow(F.lit(1.0) - x, F.lit(2.0 - lam)) - F.lit(1.0)) / F.lit(2.0 - lam))
    return F.when(x >= 0, pos).otherwise(neg)


def yeo_johnson_lam(x: Column, lam: Column) -> Column:
    """psi(x, lambda) with lambda given as a column (for grid evaluation)."""
    pos = F.when(F.abs(lam) < LAMBDA_EPS, F.log1p(x)) \
        .otherwise((F.pow(x + F.lit(1.0), lam) - F.lit(1.0)) / lam)
    neg = F.when(F.abs(lam - F.lit(2.0)) < LAMBDA_EPS, -F.log1p(-x)) \
        .otherwise(-(F.pow(F.lit(1.0) - x, F.lit(2.0) - lam) - F.lit(1.0)) / (F.lit(2.0) - lam))
    return F.when(x >= 0, pos).otherwise(neg)


def yeo_johnson_constants(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[int, float]]:
    """Per column the number of values and sum(sign(x) ln(1 + |x|)), which no lambda changes."""
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`").cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.sum(F.signum(x) * F.log1p(F.abs(x))).alias(f"k{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"n{i}"], row[f"k{i}"] or 0.0) for i, c in enumerate(cols)}


def yeo_johnson_llf(df: DataFrame, cols: Sequence[str], grid: dict[str, Sequence[float]],
                    constants: dict[str, tuple[int, float]] | None = None) -> DataFrame:
    """(column, lambda, llf) of every candidate lambda in one aggregate pass:
    -n/2 ln(var_pop(psi)) + (lambda - 1) sum(sign(x) ln(1 + |x|)).

    Each value is paired with its column's candidates; the partial aggregate right after
    keeps the shuffle at (columns x candidates) rows per task.  (All variances as columns
    of one aggregate compile for longer than they run.)
    """
    constants = constants or yeo_johnson_constants(df, cols)
    stacked = _stack(df, cols, "double").where(F.col("value").isNotNull())
    own = F.create_map(*[x for c in cols for x in (F.lit(c), F.array(*[F.lit(float(v)) for v in grid[c]]))])
    pairs = stacked.select("column", "value", F.explode(own[F.col("column")]).alias("lambda"))
    var = pairs.groupBy("column", "lambda").agg(F.var_pop(yeo_johnson_lam(F.col("value"), F.col("lambda"))).alias("v"))
    n = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(float(constants[c][0])))])
    k = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(float(constants[c][1])))])
    return var.select("column", "lambda", (F.lit(-0.5) * n[F.col("column")] * F.log("v")
                                           + (F.col("lambda") - F.lit(1.0)) * k[F.col("column")]).alias("llf"))


def yeo_johnson_llf_at(df: DataFrame, at: dict[str, float], constants: dict[str, tuple[int, float]]) -> dict[str, float | None]:
    """The log-likelihood of one lambda per column, from one aggregate over the columns as they stand.

    No row is unpivoted or multiplied, so a pass costs one power a value."""
    row = df.agg(*[F.var_pop(yeo_johnson(F.col(f"`{c}`").cast("double"), float(x))).alias(f"v{i}") for i, (c, x) in enumerate(at.items())]).first()
    out = {}
    for (c, x), v in zip(at.items(), row, strict=True):
        n, k = constants[c]
        out[c] = None if v is None or v <= 0 else -0.5 * n * math.log(v) + (x - 1.0) * k
    return out


class YeoJohnsonModel(Model, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    lambdas = Param(Params._dummy(), "lambdas", "lambda per column", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "mean of psi", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "population std of psi", TypeConverters.toListFloat)
    standardize = Param(Params._dummy(), "standardize", "standardise psi", TypeConverters.toBoolean)

    def _transform(self, df):
        pairs = self._pairs()
        lam = self.getOrDefault(self.lambdas)
        exprs = [yeo_johnson(F.col(i).cast("double"), l) for (i, _), l in zip(pairs, lam)]
        if self.getOrDefault(self.standardize):
            mu, sd = self.getOrDefault(self.means), self.getOrDefault(self.stds)
            exprs = [(e - F.lit(m)) / F.lit(s) for e, m, s in zip(exprs, mu, sd)]
        return _with(df, pairs, exprs)


GOLDEN = (3 - math.sqrt(5)) / 2


def parabolic_search(low: float, high: float, far: float, tolerance: float = 1e-8):
    """Brent's method as a coroutine: yields a point, is sent its value, returns the point of the greatest value.

    The bracket first moves outward until its middle is no lower than its ends (ValueError beyond
    ``far``); then each step tries the vertex of the parabola through the three best points, or a golden
    section where that would leave the bracket or does not shrink the steps.
    """
    middle = (low + high) / 2
    at = {}
    while True:
        for x in (low, middle, high):
            if x not in at:
                value = yield x
                at[x] = -math.inf if value is None or math.isnan(value) else value
        if at[middle] >= max(at[low], at[high]):
            break
        if max(abs(low), abs(high)) > far:
            raise ValueError("no maximum at a finite exponent")
        if at[low] > at[high]:
            low, middle, high = low - 2 * (high - low), low, middle
        else:
            low, middle, high = middle, high, high + 2 * (high - low)
    best, second, third = sorted(((at[x], x) for x in (low, middle, high)), key=lambda p: (p[1] != middle, -p[0]))
    step = before = high - low
    while True:
        x, centre = best[1], (low + high) / 2
        least = tolerance * abs(x) + tolerance / 10
        if abs(x - centre) + (high - low) / 2 <= 2 * least:
            return x
        move = None
        if abs(before) > least:
            r, q = (x - second[1]) * (best[0] - third[0]), (x - third[1]) * (best[0] - second[0])
            p, q = (x - third[1]) * q - (x - second[1]) * r, 2 * (q - r)
            if q and math.isfinite(p / q) and abs(p / q) < abs(before) / 2 and low < x - p / q < high:
                move = -p / q
                if min(x + move - low, high - x - move) < 2 * least:
                    move = math.copysign(least, centre - x)
        before, step = step, move
        if move is None:
            before = (low if x >= centre else high) - x
            step = move = GOLDEN * before
        new = x + (move if abs(move) >= least else math.copysign(least, move))
        value = yield new
        value = -math.inf if value is None or math.isnan(value) else value
        if value >= best[0]:
            low, high = (x, high) if new >= x else (low, x)
            best, second, third = (value, new), best, second
        else:
            low, high = (low, new) if new >= x else (new, high)
            if value >= second[0] or second[1] == x:
                second, third = (value, new), second
            elif value >= third[0] or third[1] in (x, second[1]):
                third = (value, new)


class YeoJohnson(Estimator, _Cols, DefaultParamsReadable, DefaultParamsWritable):
    """Maximum-likelihood lambda per column by Brent's method, then optional standardisation.

    The searches of all columns go side by side: one aggregate evaluates the next point of each."""

    standardize = Param(Params._dummy(), "standardize", "standardise psi", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, inputCols=None, outputCols=None, standardize=True):
        super().__init__()
        self._setDefault(standardize=True)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        cols = self.getInputCols()
        # every step reads the narrow columns alone, from memory as far as they fit, else from local disk
        src = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).persist()
        try:
            return self._search(src, cols)
        finally:
            src.unpersist()

    def _search(self, src, cols):
        constants = yeo_johnson_constants(src, cols)
        found = {c: 1.0 for c in cols}  # a column without two different values keeps its values
        spread = src.agg(*[(F.min(f"`{c}`") < F.max(f"`{c}`")).alias(f"s{i}") for i, c in enumerate(cols)]).first()
        searches = {c: parabolic_search(-2.0, 2.0, LAMBDA_FAR) for i, c in enumerate(cols) if spread[f"s{i}"]}
        ask = {c: next(s) for c, s in searches.items()}
        while ask:
            value = yeo_johnson_llf_at(src, ask, constants)  # one number a column
            for c in list(ask):
                try:
                    ask[c] = searches[c].send(value.get(c))
                except StopIteration as end:
                    found[c] = end.value
                    del ask[c]
                except ValueError as e:
                    raise ValueError(f"the likelihood of {c!r} has {e}") from None
        centre = found
        lambdas = [centre[c] for c in cols]
        means, stds = _scale_stats(src, {c: yeo_johnson(F.col(c), l) for c, l in zip(cols, lambdas)})
        m = YeoJohnsonModel()
        m._set(inputCols=cols, lambdas=lambdas, means=means, stds=stds,
               standardize=self.getOrDefault(self.standardize))
        if self.isDefined(self.outputCols):
            m._set(outputCols=self.getOutputCols())
        return m


# --- F9 / F10 / F14 ---------------------------------------------------------
def one_hot_stages(cols: Sequence[str], suffix: str = "_oh") -> list:
    """Sorted categories; unseen and NULL -> all-zero block; no real category dropped.

    ``handleInvalid='keep'`` appends an "unknown" index after the sorted
    categories; ``dropLast=True`` then drops exactly that slot.
    """
    idx = [f"{c}_idx" for c in cols]
    return [StringIndexer(inputCols=list(cols), outputCols=idx, stringOrderType="alphabetAsc",
                          handleInvalid="keep"),
            OneHotEncoder(inputCols=idx, outputCols=[f"{c}{suffix}" for c in cols], dropLast=True)]


def ordinal_stage(cols: Sequence[str], suffix: str = "_ord", invalid: str = "error") -> StringIndexer:
    """Position in the sorted category list."""
    return StringIndexer(inputCols=list(cols), outputCols=[f"{c}{suffix}" for c in cols],
                         stringOrderType="alphabetAsc", handleInvalid=invalid)


def column_transformer(onehot: Sequence[str], power: Sequence[str], numeric: Sequence[str],
                       output: str = "features") -> Pipeline:
    """mode-impute + one-hot, median-impute + Yeo-Johnson, median-impute +
    population scaling, concatenated into one vector; other columns dropped."""
    stages, parts = [], []
    if onehot:
        stages.append(ModeImputer(inputCols=list(onehot), outputCols=[f"{c}_imp" for c in onehot]))
        stages += one_hot_stages([f"{c}_imp" for c in onehot])
        parts += [f"{c}_imp_oh" for c in onehot]
    if power:
        stages.append(MedianImputer(inputCols=list(power), outputCols=[f"{c}_pimp" for c in power]))
        stages.append(YeoJohnson(inputCols=[f"{c}_pimp" for c in power],
                                 outputCols=[f"{c}_pow" for c in power]))
        parts += [f"{c}_pow" for c in power]
    if numeric:
        stages.append(MedianImputer(inputCols=list(numeric), outputCols=[f"{c}_nimp" for c in numeric]))
        stages.append(PopulationScaler(inputCols=[f"{c}_nimp" for c in numeric],
                                       outputCols=[f"{c}_sc" for c in numeric]))
        parts += [f"{c}_sc" for c in numeric]
    stages.append(VectorAssembler(inputCols=parts, outputCol=output, handleInvalid="keep"))
    return Pipeline(stages=stages)


def assembled_feature_names(df: DataFrame, output: str = "features") -> list[str]:
    """slot names from the assembled vector's ML attribute metadata."""
    meta = df.schema[output].metadata.get("ml_attr", {})
    attrs = meta.get("attrs", {})
    slots = []
    for group in attrs.values():
        slots += [(a["idx"], a.get("name", str(a["idx"]))) for a in group]
    return [n for _, n in sorted(slots)]
