"""Registered distribution-statistics queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from casewise.operators import stats as ST
from casewise.plans import sql as S
from casewise.plans.catalog import register
from casewise.plans.common import dround, r6
from casewise.plans.q_features import power_ctes, recursive
from casewise.plans.q_metrics import SCORED, scored
from casewise.plans.q_profile import stack_sql
from casewise.sources.views import CATEGORICAL, NUMERIC, cases_nulls


@register("skewness", S.with_cases(
    "SELECT \"column\", round(skewness(value), 6) AS skew FROM s WHERE value IS NOT NULL GROUP BY 1",
    nulls=True, s=stack_sql(NUMERIC, cast="DOUBLE")))
def q_skewness(spark, sf_dir):
    """Bias-corrected skew of the numeric columns."""
    return ST.skewness(cases_nulls(spark, sf_dir), NUMERIC).select("column", r6("skew"))


_LABELLED = "SELECT * FROM cases_nulls WHERE case_status IN ('F', 'O')"


def _chi2_sql() -> str:
    return S.with_cases(
        """SELECT "column", round(sum(CASE WHEN dof = 1
              THEN power(o + sign(e - o) * least(0.5, abs(e - o)) - e, 2) / e
              ELSE power(o - e, 2) / e END), 6) AS statistic, any_value(dof) AS dof
FROM (SELECT g.*, coalesce(cells.o, 0) AS o, g.r * g.c / g.n AS e
      FROM (SELECT r."column", r.case_status, c.value, r.r, c.c, d.n, d.dof
            FROM rws r JOIN cls c ON r."column" = c."column" JOIN dims d ON d."column" = r."column") g
      LEFT JOIN cells ON g."column" = cells."column" AND g.value = cells.value
                      AND g.case_status = cells.case_status)
GROUP BY 1""", nulls=True,
        lab=_LABELLED,
        s=stack_sql(CATEGORICAL, src="lab", extra=", case_status"),
        cells="SELECT \"column\", value, case_status, count(*) AS o FROM s WHERE value IS NOT NULL GROUP BY 1, 2, 3",
        rws="SELECT \"column\", case_status, sum(o) AS r FROM cells GROUP BY 1, 2",
        cls="SELECT \"column\", value, sum(o) AS c FROM cells GROUP BY 1, 2",
        dims="SELECT t.\"column\", n, (nr - 1) * (nc - 1) AS dof FROM "
             "(SELECT \"column\", sum(r) AS n, count(*) AS nr FROM rws GROUP BY 1) t JOIN "
             "(SELECT \"column\", count(*) AS nc FROM cls GROUP BY 1) u ON t.\"column\" = u.\"column\"")


def _labelled(spark, sf_dir):
    return cases_nulls(spark, sf_dir).where(F.col("case_status").isin("F", "O"))


@register("chi2_statistic", _chi2_sql())
def q_chi2_statistic(spark, sf_dir):
    """D21 statistic and dof (Yates' correction on the 2 x 2 flag tables)."""
    out = ST.chi2_statistic(_labelled(spark, sf_dir), CATEGORICAL, "case_status")
    return out.select("column", r6("statistic"), "dof")


# upper tail of the chi-square distribution: one less the series of the lower incomplete gamma function
_CHI2_TAIL = """1 - CASE WHEN statistic <= 0 THEN 0 ELSE list_sum(list_transform(range(2000), lambda k: exp(
    (dof / 2.0 + k) * ln(statistic / 2) - statistic / 2 - lgamma(dof / 2.0 + k + 1)))) END"""


@register("chi2_independence", f"""SELECT "column", round(statistic, 6) AS statistic, dof, round(p, 6) AS p_value, CASE WHEN p < 0.05 THEN 'Reject null Hypothesis'
       ELSE 'Fail to reject null Hypothesis' END AS hypothesis
FROM (SELECT *, {_CHI2_TAIL} AS p FROM ({_chi2_sql().replace('round(sum(CASE', '(sum(CASE').replace('END), 6) AS statistic', 'END)) AS statistic')}))""")
def q_chi2_independence(spark, sf_dir):
    """D21 with p-value and decision."""
    out = ST.chi2_independence(_labelled(spark, sf_dir), CATEGORICAL, "case_status")
    return out.select("column", r6("statistic"), "dof", r6("p_value"), "hypothesis")


_BINS = 20


@register("histogram", S.with_cases(
    f"""SELECT "column", case_status, CAST(bin AS INTEGER) AS bin,
       round(lo + bin * ((hi - lo) / {_BINS}.0), 6) AS lower,
       round(lo + (bin + 1) * ((hi - lo) / {_BINS}.0), 6) AS upper, count(*) AS count
FROM (SELECT s.*, r.lo, r.hi, CASE WHEN r.hi - r.lo > 0
        THEN least(floor((value - r.lo) / (r.hi - r.lo) * {_BINS}.0), {_BINS - 1}) ELSE 0 END AS bin
      FROM s JOIN (SELECT "column", min(value) AS lo, max(value) AS hi FROM s GROUP BY 1) r
      ON s."column" = r."column")
GROUP BY "column", case_status, bin, lo, hi""", nulls=True,
    s=f"SELECT * FROM ({stack_sql(NUMERIC, cast='DOUBLE', extra=', case_status')}) WHERE value IS NOT NULL"))
def q_histogram(spark, sf_dir):
    """20 equal-width bins per numeric column, counted by label."""
    out = ST.histogram(cases_nulls(spark, sf_dir), NUMERIC, _BINS, by="case_status")
    return out.select("column", "case_status", "bin", r6("lower"), r6("upper"), "count")


@register("histogram_auto", S.with_cases(
    """SELECT "column", case_status, CAST(bin AS INTEGER) AS bin,
       round(lo + bin * ((hi - lo) / k), 6) AS lower, round(lo + (bin + 1) * ((hi - lo) / k), 6) AS upper,
       count(*) AS count
FROM (SELECT s.*, r.lo, r.hi, r.k, CASE WHEN r.hi - r.lo > 0
        THEN least(floor((value - r.lo) / (r.hi - r.lo) * r.k), r.k - 1) ELSE 0 END AS bin
      FROM s JOIN r ON s."column" = r."column")
GROUP BY "column", case_status, bin, lo, hi, k""", nulls=True,
    s=f"SELECT * FROM ({stack_sql(NUMERIC, cast='DOUBLE', extra=', case_status')}) WHERE value IS NOT NULL",
    q0="SELECT \"column\", count(value) AS n, min(value) AS lo, max(value) AS hi, "
       "quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM s GROUP BY 1",
    r="SELECT \"column\", lo, hi, CAST(CASE WHEN w > 0 THEN ceil((hi - lo) / w) ELSE 1 END AS INTEGER) AS k "
      "FROM (SELECT *, least(greatest(2.0 * (q3 - q1) * pow(CAST(n AS DOUBLE), -1.0 / 3.0), "
      "(hi - lo) / sqrt(CAST(n AS DOUBLE)) / 2.0), (hi - lo) / (log2(CAST(n AS DOUBLE)) + 1.0)) AS w FROM q0)"))
def q_histogram_auto(spark, sf_dir):
    """D23 with the 'auto' bin rule per column."""
    out = ST.histogram(cases_nulls(spark, sf_dir), NUMERIC, "auto", by="case_status")
    return out.select("column", "case_status", "bin", r6("lower"), r6("upper"), "count")


@register("box_stats", S.with_cases(
    """SELECT q.continent, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
       round(q3 - q1, 6) AS iqr,
       round(min(x) FILTER (WHERE x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
       round(max(x) FILTER (WHERE x >= q1 - 1.5 * (q3 - q1) AND x <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
       count(*) FILTER (WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS outliers
FROM src JOIN (SELECT continent, quantile_cont(x, 0.25) AS q1, median(x) AS med, quantile_cont(x, 0.75) AS q3
               FROM src GROUP BY 1) q ON src.continent = q.continent
GROUP BY q.continent, q1, med, q3""", nulls=True,
    src="SELECT continent, prevailing_wage AS x FROM cases_nulls WHERE continent IS NOT NULL"))
def q_box_stats(spark, sf_dir):
    """Box-plot numbers of the wage per continent."""
    out = ST.box_stats(cases_nulls(spark, sf_dir), "continent", "prevailing_wage")
    return out.select("continent", *[r6(c) for c in ("q1", "median", "q3", "iqr", "whisker_low",
                                                      "whisker_high")], "outliers")


_G = 200


@register("kde", S.with_cases(
    f"""SELECT s.label, CAST(g.i AS INTEGER) AS point,
       round(any_value(st.lo - 3.0 * st.bw + g.i * ((st.hi - st.lo + 6.0 * st.bw) / {_G - 1}.0)), 6) AS x,
       round(sum(exp(-0.5 * power(((st.lo - 3.0 * st.bw + g.i * ((st.hi - st.lo + 6.0 * st.bw) / {_G - 1}.0)) - s.score) / st.bw, 2)))
             / (any_value(st.n) * any_value(st.bw) * {math.sqrt(2 * math.pi)!r}), 6) AS density
FROM scored s JOIN st ON s.label = st.label, range({_G}) g(i)
GROUP BY 1, 2""",
    scored=SCORED,
    st="SELECT label, n, lo, hi, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw FROM "
       "(SELECT label, count(*) AS n, min(score) AS lo, max(score) AS hi, stddev_samp(score) AS sd "
       "FROM scored GROUP BY 1)"))
def q_kde(spark, sf_dir):
    """Gaussian density of the score per label on a 200-point grid."""
    out = ST.kde(scored(spark, sf_dir), "score", by="label", grid=_G)
    return out.select("label", "point", r6("x"), r6("density"))


_POWERED = stack_sql(NUMERIC, cast="DOUBLE")


@register("skewness_after_power", recursive(S.with_cases(
    """SELECT "column", round(skewness(CASE WHEN value >= 0 THEN (pow(1 + value, "lambda") - 1) / "lambda"
         ELSE -(pow(1 - value, 2 - "lambda") - 1) / (2 - "lambda") END), 3) AS skew
FROM s JOIN yj_best USING ("column") WHERE value IS NOT NULL GROUP BY 1""", nulls=True,
    s=_POWERED, **power_ctes("SELECT * FROM s", 30.0))))
def q_skewness_after_power(spark, sf_dir):
    """D20 after the power transform: skew of the Yeo-Johnson outputs (lambda fitted per
    column by maximum likelihood; years lie so close together that it is flat there: 3 digits)."""
    from casewise.operators.encode import YeoJohnson
    df = cases_nulls(spark, sf_dir).select(*NUMERIC)
    out = [f"{c}_pow" for c in NUMERIC]
    tr = YeoJohnson(inputCols=list(NUMERIC), outputCols=out).fit(df).transform(df)
    skew = ST.skewness(tr.select(*out), out)
    return skew.select(F.regexp_replace("column", "_pow$", "").alias("column"), dround(F.col("skew"), 3).alias("skew"))


@register("histogram_year_40", S.with_cases(
    """SELECT 'yr_of_estab' AS "column", case_status, CAST(bin AS INTEGER) AS bin,
       round(lo + bin * ((hi - lo) / 40.0), 6) AS lower, round(lo + (bin + 1) * ((hi - lo) / 40.0), 6) AS upper,
       count(*) AS count
FROM (SELECT case_status, lo, hi, CASE WHEN hi - lo > 0
        THEN least(floor((CAST(yr_of_estab AS DOUBLE) - lo) / (hi - lo) * 40.0), 39) ELSE 0 END AS bin
      FROM cases_nulls, (SELECT CAST(min(yr_of_estab) AS DOUBLE) AS lo, CAST(max(yr_of_estab) AS DOUBLE) AS hi
                         FROM cases_nulls))
GROUP BY case_status, bin, lo, hi""", nulls=True))
def q_histogram_year_40(spark, sf_dir):
    """Establishment year in 40 bins by label."""
    out = ST.histogram(cases_nulls(spark, sf_dir), ["yr_of_estab"], 40, by="case_status")
    return out.select("column", "case_status", "bin", r6("lower"), r6("upper"), "count")
