"""Scalar feature expressions (F1-F3, F5, F6, F17) as Spark Columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wage-unit multipliers to an annual figure.  The unit text is
# lower-cased and trimmed and matched by *containment*; when several match,
# the later entry of this list wins (so "hour/year" is annual).
UNIT_FACTORS = [("hour", 2080.0), ("week", 52.0), ("month", 12.0), ("year", 1.0)]

# The columns that get a log1p feature (those present).
LOG_FEATURES = ["annual_wage", "wage_per_employee", "company_age", "no_of_employees",
                "prevailing_wage"]


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c) -> Column:
    """Coerce to double; unparsable text becomes NULL (never an ANSI error)
    and NaN becomes NULL (pandas treats both as missing).  Numeric input is
    widened directly (no text round trip)."""
    x = as_col(c).try_cast("double")
    return F.nanvl(x, F.lit(None).cast("double"))


def unit_factor(unit) -> Column:
    norm = F.lower(F.trim(as_col(unit).cast("string")))
    expr = None
    for word, factor in reversed(UNIT_FACTORS):  # last listed has priority
        cond = norm.contains(word)
        expr = F.when(cond, F.lit(factor)) if expr is None else expr.when(cond, F.lit(factor))
    return expr.otherwise(F.lit(1.0))


def annual_wage(wage, unit=None) -> Column:
    """wage x unit factor; without a unit column the wage is taken as annual."""
    w = to_number(wage)
    return w if unit is None else w * unit_factor(unit)


def clip_low(x: Column, low: float = 0.0) -> Column:
    """``clip(lower=low)`` that keeps NULL (``greatest`` would skip it)."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(low)))


def wage_per_employee(annual: Column, employees) -> Column:
    """annual / (clip(employees, 0) + 1)."""
    return annual / (clip_low(to_number(employees)) + F.lit(1.0))


def company_age(yr, as_of_year: int, clamp: bool = False) -> Column:
    """as_of_year - year of establishment; serving clamps at 0."""
    age = F.lit(float(as_of_year)) - to_number(yr)
    return clip_low(age) if clamp else age


def log1p_clipped(x) -> Column:
    """log1p(clip(x, 0))."""
    return F.log1p(clip_low(to_number(x)))


def format_pct(x, clamp: bool = False) -> Column:
    """0..1 -> whole-percent text; non-finite or NULL -> dash.

    Rounds half up (towards +inf) as the browser's ``Math.round`` does;
    ``clamp`` limits the percentage to 0..100 first (meter display).
    """
    v = as_col(x).cast("double")
    finite = v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
    pct = v * F.lit(100.0)
    if clamp:
        pct = F.least(F.greatest(pct, F.lit(0.0)), F.lit(100.0))
    whole = F.floor(pct + F.lit(0.5)).cast("bigint")
    return F.when(finite, F.concat(whole.cast("string"), F.lit("%"))).otherwise(F.lit("\u2014"))


# The what-if presets of the scoring form.  Each field is filled from a
# learnt statistic ("min", "max", "p50"), from the present year minus an age ("age"), or
# from a place in the field's sorted domain (0, 1); the second entry is the value to use
# when nothing was learnt (for "age": the age).  Fields that are not listed stay.
PRESETS = {
    "Low wage / New company": {
        "prevailing_wage": ("min", 25000), "yr_of_estab": ("age", 5), "has_job_experience": (1, "N"),
        "full_time_position": (1, "N"), "requires_job_training": (0, "Y")},
    "High wage / Experienced": {
        "prevailing_wage": ("max", 120000), "yr_of_estab": ("min", 1998), "has_job_experience": (0, "Y"),
        "full_time_position": (0, "Y"), "requires_job_training": (1, "N")},
    "Mid wage / Training required": {
        "prevailing_wage": ("p50", 65000), "yr_of_estab": ("p50", 2008), "has_job_experience": (0, "Y"),
        "requires_job_training": (0, "Y")},
}
PRESET_FIELDS = list(dict.fromkeys(f for rules in PRESETS.values() for f in rules))


def fill_presets(ranges: dict[str, dict], domains: dict[str, list], now_year: int, presets: dict = PRESETS) -> list[dict]:
    """F16: the presets as rows.  ``ranges`` has min, max, p50 of numeric fields, ``domains``
    the first values of sorted text domains; numbers are rounded half up."""
    def value(field, source, otherwise):
        if source == "age":
            return now_year - otherwise
        if isinstance(source, int):
            known = domains.get(field) or []
            return known[source] if source < len(known) else otherwise
        learnt = (ranges.get(field) or {}).get(source)
        return otherwise if learnt is None else math.floor(learnt + 0.5)
    return [{"preset": name} | {f: value(f, *rules[f]) if f in rules else None for f in PRESET_FIELDS}
            for name, rules in presets.items()]


def scenario_expand(df, presets: list[dict]):
    """F16: every row once per preset; preset fields override, others kept.

    The presets are a three-element literal array exploded per row (no join).
    """
    fields = PRESET_FIELDS
    types = {"prevailing_wage": "double", "yr_of_estab": "bigint"}
    arr = F.array(*[F.struct(F.lit(p["preset"]).alias("preset"),
                             *[F.lit(p[f]).cast(types.get(f, "string")).alias(f) for f in fields])
                    for p in presets])
    out = df.withColumn("__p", F.explode(arr))
    cols = []
    for c in df.columns:
        if c in fields:
            cols.append(F.coalesce(F.col(f"__p.{c}"), F.col(c).cast(types.get(c, "string"))).alias(c))
        else:
            cols.append(F.col(c))
    return out.select(*cols, F.col("__p.preset").alias("preset"))
