"""Leakage-safe feature operators (F1-F8, F13): fit on training rows, apply anywhere.

Fitted statistics are small DataFrames (one row per group key) or scalars;
they are applied with size-checked broadcast joins, never collected as dicts.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewise.functions import features as fx
from casewise.operators.joins import lookup_with_default
from casewise.operators.quantiles import group_quantiles
from casewise.operators.stages import TableStage
from casewise.session import cut_lineage

# Fixed value: added to the group median before dividing.
RATIO_EPS = 1e-9


def derive_basic(df: DataFrame, as_of_year: int, id_col: str = "case_id",
                 year_col: str = "yr_of_estab", clamp: bool = False) -> DataFrame:
    """Drop the id, replace the establishment year by ``company_age``."""
    out = df.drop(id_col) if id_col in df.columns else df
    if year_col in out.columns:
        out = out.withColumn("company_age", fx.company_age(year_col, as_of_year, clamp)).drop(year_col)
    return out


def with_annual_wage(df: DataFrame, wage_col: str, unit_col: str, out: str = "annual_wage") -> DataFrame:
    """F2 + F6: annualised wage, or the wage as is without a unit column, or NULL."""
    if wage_col in df.columns and unit_col in df.columns:
        return df.withColumn(out, fx.annual_wage(wage_col, unit_col))
    if wage_col in df.columns:
        return df.withColumn(out, fx.to_number(wage_col))
    return df.withColumn(out, F.lit(None).cast("double"))


class _WageParams(Params):
    wageCol = Param(Params._dummy(), "wageCol", "wage", TypeConverters.toString)
    unitCol = Param(Params._dummy(), "unitCol", "unit of the wage", TypeConverters.toString)
    regionCol = Param(Params._dummy(), "regionCol", "region, key of a median", TypeConverters.toString)
    continentCol = Param(Params._dummy(), "continentCol", "continent, key of a median", TypeConverters.toString)
    employeesCol = Param(Params._dummy(), "employeesCol", "number of employees", TypeConverters.toString)

    def _columns(self) -> tuple[str, str, str, str, str]:
        return tuple(self.getOrDefault(p) for p in (self.wageCol, self.unitCol, self.regionCol, self.continentCol, self.employeesCol))


class WageFeatureModel(Model, _WageParams, TableStage):
    """Fitted wage features: a Spark ML transformer, usable and saved as a pipeline stage.

    The median tables are None where the column was absent at fit time.
    """
    globalMedian = Param(Params._dummy(), "globalMedian", "median of all annual wages (unset without any)", TypeConverters.toFloat)

    def __init__(self, region_medians: DataFrame | None = None, continent_medians: DataFrame | None = None,
                 global_median: float | None = None):
        super().__init__()
        self.region_medians, self.continent_medians = region_medians, continent_medians
        if global_median is not None:
            self._set(globalMedian=global_median)

    @property
    def global_median(self) -> float | None:
        return self.getOrDefault(self.globalMedian) if self.isDefined(self.globalMedian) else None

    def _tables(self):
        return {"region": self.region_medians, "continent": self.continent_medians}

    def _restore(self, tables):
        self.region_medians, self.continent_medians = tables.get("region"), tables.get("continent")

    @classmethod
    def load(cls, *where) -> "WageFeatureModel":
        """``load(path)`` as for any stage; ``load(spark, path)`` also does."""
        return cls.read().load(where[-1])

    def _ratio(self, df: DataFrame, key: str, medians: DataFrame | None, out: str) -> DataFrame:
        if key not in df.columns:
            return df.withColumn(out, F.lit(None).cast("double"))
        glob = F.lit(self.global_median).cast("double")
        if medians is None:
            med = glob
            return df.withColumn(out, F.col("annual_wage") / (med + F.lit(RATIO_EPS)))
        keyed = df.withColumn("__key", F.col(key).cast("string"))
        joined = lookup_with_default(keyed, "__key", medians, "key", "median", glob, "__med")
        return joined.withColumn(out, F.col("annual_wage") / (F.col("__med") + F.lit(RATIO_EPS))) \
            .drop("__key", "__med")

    def _transform(self, df: DataFrame) -> DataFrame:
        wage, unit, region, continent, employees = self._columns()
        out = with_annual_wage(df, wage, unit)
        if employees in out.columns:
            out = out.withColumn("wage_per_employee", fx.wage_per_employee(F.col("annual_wage"), employees))
        else:
            out = out.withColumn("wage_per_employee", F.lit(None).cast("double"))
        out = self._ratio(out, region, self.region_medians, "wage_vs_region_median")
        out = self._ratio(out, continent, self.continent_medians, "wage_vs_continent_median")
        for c in fx.LOG_FEATURES:
            if c in out.columns:
                out = out.withColumn(f"log1p_{c}", fx.log1p_clipped(c))
        return out


class WageFeatures(Estimator, _WageParams, DefaultParamsReadable, DefaultParamsWritable):
    """F4 estimator: train-only group medians of the annual wage."""

    def __init__(self, wage_col: str = "prevailing_wage", unit_col: str = "unit_of_wage", region_col: str = "region_of_employment",
                 continent_col: str = "continent", employees_col: str = "no_of_employees"):
        super().__init__()
        self._set(wageCol=wage_col, unitCol=unit_col, regionCol=region_col, continentCol=continent_col, employeesCol=employees_col)

    def _fit(self, df: DataFrame) -> WageFeatureModel:
        """Global, region and continent medians from ONE pass: every row is
        emitted once per statistic as (kind, key, wage) and the exact group
        quantile runs over (kind, key); the global group is handled by the
        distributed selection when it is large."""
        wage, unit, region, continent, _ = self._columns()
        base = with_annual_wage(df, wage, unit)
        kinds = [F.struct(F.lit("__all__").alias("kind"), F.lit("").alias("key"))]
        present = [k for k in (region, continent) if k in base.columns]
        for k in present:
            kinds.append(F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("key")))
        rows = base.select(F.explode(F.array(*kinds)).alias("g"), "annual_wage") \
            .select("g.kind", "g.key", "annual_wage").where(F.col("key").isNotNull())
        med = group_quantiles(rows, ["kind", "key"], "annual_wage", [0.5], ["median"])
        med = cut_lineage(med)  # one row per key: small, reused by every transform
        glob = med.where(F.col("kind") == "__all__").first()
        glob = glob["median"] if glob is not None else None
        tables = {}
        for key in (region, continent):
            tables[key] = (med.where((F.col("kind") == key) & F.col("median").isNotNull()).select("key", "median")
                           if key in present else None)
        return self._copyValues(WageFeatureModel(tables[region], tables[continent], glob))
