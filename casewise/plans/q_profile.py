"""Registered profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewise.operators import profile as P
from casewise.operators.quantiles import group_quantiles
from casewise.plans import sql as S
from casewise.plans.catalog import register
from casewise.plans.common import r6
from casewise.sources.views import CATEGORICAL, NUMERIC, cases_nulls, cases_view

CAT_WITH_LABEL = CATEGORICAL + ["case_status"]


def stack_sql(cols, src="cases_nulls", cast="VARCHAR", extra=""):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS {cast}) AS value{extra} FROM {src}" for c in cols)


@register("value_counts", S.with_cases(
    "SELECT continent AS value, count(*) AS count FROM cases_nulls WHERE continent IS NOT NULL GROUP BY 1",
    nulls=True))
def q_value_counts(spark, sf_dir):
    return P.value_counts(cases_nulls(spark, sf_dir), "continent")


@register("value_counts_keepna", S.with_cases(
    "SELECT continent AS value, count(*) AS count FROM cases_nulls GROUP BY 1", nulls=True))
def q_value_counts_keepna(spark, sf_dir):
    return P.value_counts(cases_nulls(spark, sf_dir), "continent", dropna=False)


@register("value_share", S.with_cases(
    """SELECT c."column", c.value, c.count, round(100.0 * c.count / t.total, 6) AS percent
FROM c JOIN (SELECT "column", sum(count) AS total FROM c GROUP BY 1) t ON c."column" = t."column" """,
    nulls=True,
    s=stack_sql(CAT_WITH_LABEL),
    c="SELECT \"column\", value, count(*) AS count FROM s WHERE value IS NOT NULL GROUP BY 1, 2"))
def q_value_share(spark, sf_dir):
    out = P.value_share(cases_nulls(spark, sf_dir), CAT_WITH_LABEL)
    return out.select("column", "value", "count", r6("percent"))


@register("status_share_by", S.with_cases(
    """SELECT c.continent, c.case_status, c.count, round(100.0 * c.count / t.total, 6) AS percent
FROM c JOIN (SELECT continent, sum(count) AS total FROM c GROUP BY 1) t ON c.continent = t.continent""",
    nulls=True,
    c="SELECT continent, case_status, count(*) AS count FROM cases_nulls "
      "WHERE continent IS NOT NULL AND case_status IS NOT NULL GROUP BY 1, 2"))
def q_status_share_by(spark, sf_dir):
    out = P.status_share_by(cases_nulls(spark, sf_dir), "continent", "case_status")
    return out.select("continent", "case_status", "count", r6("percent"))


@register("positive_rate_by", S.with_cases(
    """SELECT continent, round(100.0 * nullif(count(*) FILTER (WHERE case_status = 'F'), 0) / count(*), 6)
       AS positive_rate, count(*) AS count FROM cases_nulls WHERE continent IS NOT NULL GROUP BY 1""",
    nulls=True))
def q_positive_rate_by(spark, sf_dir):
    out = P.positive_rate_by(cases_nulls(spark, sf_dir), "continent", "case_status", "F")
    return out.select("continent", r6("positive_rate"), "count")


@register("rate_by_align", S.with_cases(
    """SELECT case_status, round(100.0 * nullif(count(*) FILTER (WHERE case_status = 'F'), 0) / count(*), 6)
       AS positive_rate, count(*) AS count FROM cases_nulls WHERE case_status IS NOT NULL GROUP BY 1""",
    nulls=True))
def q_rate_by_align(spark, sf_dir):
    """A group without positives gets NULL, not 0."""
    out = P.positive_rate_by(cases_nulls(spark, sf_dir), "case_status", "case_status", "F")
    return out.select("case_status", r6("positive_rate"), "count")


@register("count_by_two", S.with_cases(
    "SELECT continent, case_status, count(*) AS count FROM cases_nulls "
    "WHERE continent IS NOT NULL AND case_status IS NOT NULL GROUP BY 1, 2", nulls=True))
def q_count_by_two(spark, sf_dir):
    return P.count_by_two(cases_nulls(spark, sf_dir), "continent", "case_status")


@register("crosstab", S.with_cases(
    """SELECT continent, count(*) FILTER (WHERE case_status = 'F') AS "F",
       count(*) FILTER (WHERE case_status = 'O') AS "O", count(*) FILTER (WHERE case_status = 'P') AS "P"
       FROM cases_nulls WHERE continent IS NOT NULL AND case_status IS NOT NULL GROUP BY 1""", nulls=True))
def q_crosstab(spark, sf_dir):
    return P.crosstab(cases_nulls(spark, sf_dir), "continent", "case_status", ["F", "O", "P"])


@register("group_mean_sorted", S.with_cases(
    "SELECT education_of_employee, round(avg(prevailing_wage), 6) AS mean FROM cases "
    "GROUP BY 1 ORDER BY mean DESC"))
def q_group_mean_sorted(spark, sf_dir):
    out = P.group_mean_sorted(cases_view(spark, sf_dir), "education_of_employee", "prevailing_wage")
    return out.select("education_of_employee", r6("mean"))


@register("group_median", S.with_cases(
    "SELECT region_of_employment, round(median(prevailing_wage), 6) AS median FROM cases_nulls "
    "WHERE region_of_employment IS NOT NULL GROUP BY 1", nulls=True))
def q_group_median(spark, sf_dir):
    out = P.group_median(cases_nulls(spark, sf_dir), "region_of_employment", "prevailing_wage")
    return out.select("region_of_employment", r6("median"))


@register("group_median_selection", S.with_cases(
    "SELECT region_of_employment, round(median(prevailing_wage), 6) AS median FROM cases_nulls "
    "WHERE region_of_employment IS NOT NULL GROUP BY 1", nulls=True))
def q_group_median_selection(spark, sf_dir):
    """D8 by distributed rank selection (the way of groups that outgrow one task's buffer)."""
    df = cases_nulls(spark, sf_dir).where(F.col("region_of_employment").isNotNull())
    out = group_quantiles(df, ["region_of_employment"], "prevailing_wage", [0.5], ["median"], cap=0, sort_rows=200)
    return out.select("region_of_employment", r6("median"))


@register("global_median", S.with_cases(
    "SELECT round(median(prevailing_wage), 6) AS median FROM cases_nulls", nulls=True))
def q_global_median(spark, sf_dir):
    return P.global_median(cases_nulls(spark, sf_dir), "prevailing_wage").select(r6("median"))


@register("describe", S.with_cases(
    """SELECT "column", count(value) AS count, round(avg(value), 6) AS mean,
       round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min,
       round(quantile_cont(value, 0.25), 6) AS p25, round(median(value), 6) AS p50,
       round(quantile_cont(value, 0.75), 6) AS p75, round(max(value), 6) AS max
       FROM s GROUP BY 1""", nulls=True, s=stack_sql(NUMERIC, cast="DOUBLE")))
def q_describe(spark, sf_dir):
    out = P.describe(cases_nulls(spark, sf_dir), NUMERIC)
    return out.select("column", "count", *[r6(c) for c in
                                           ("mean", "std", "min", "p25", "p50", "p75", "max")])


_TYPES = {"case_id": "bigint", "no_of_employees": "bigint", "yr_of_estab": "bigint",
          "prevailing_wage": "double", "score": "double"}
_ALL = list(cases_view.__globals__["CASE_COLUMNS"])


@register("info", S.with_cases(" UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", count({c}) AS non_null, "
    f"'{_TYPES.get(c, 'string')}' AS dtype FROM cases_nulls" for i, c in enumerate(_ALL)), nulls=True))
def q_info(spark, sf_dir):
    return P.info(cases_nulls(spark, sf_dir))


@register("missing_counts", S.with_cases(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing FROM cases_nulls"
    for c in _ALL), nulls=True))
def q_missing_counts(spark, sf_dir):
    return P.missing_counts(cases_nulls(spark, sf_dir))


@register("missing_percent_over", S.with_cases(
    "SELECT \"column\", round_even(100.0 * missing / (SELECT count(*) FROM cases_nulls), 4) "
    "AS missing_percent FROM m WHERE missing > 1", nulls=True,
    m=" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing FROM cases_nulls"
        for c in _ALL)))
def q_missing_percent_over(spark, sf_dir):
    return P.missing_percent_over(cases_nulls(spark, sf_dir))


_DUP = ["continent", "education_of_employee", "has_job_experience", "requires_job_training",
        "full_time_position", "unit_of_wage", "case_status"]


@register("duplicate_count", S.with_cases(
    f"SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates FROM "
    f"(SELECT count(*) AS n FROM cases_nulls GROUP BY {', '.join(_DUP)})", nulls=True))
def q_duplicate_count(spark, sf_dir):
    return P.duplicate_count(cases_nulls(spark, sf_dir).select(*_DUP))


@register("distinct_count", S.with_cases(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct FROM cases_nulls"
    for c in CAT_WITH_LABEL), nulls=True))
def q_distinct_count(spark, sf_dir):
    return P.distinct_count(cases_nulls(spark, sf_dir), CAT_WITH_LABEL)


@register("distinct_count_with_null", S.with_cases(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) "
    f"AS BIGINT) AS n_distinct FROM cases_nulls" for c in CAT_WITH_LABEL), nulls=True))
def q_distinct_count_with_null(spark, sf_dir):
    return P.distinct_count(cases_nulls(spark, sf_dir), CAT_WITH_LABEL, count_null=True)


@register("category_domain", S.with_cases(
    "SELECT \"column\", CAST(row_number() OVER (PARTITION BY \"column\" ORDER BY value) AS INTEGER) "
    "AS position, value FROM (SELECT DISTINCT \"column\", value FROM s WHERE value IS NOT NULL)",
    nulls=True, s=stack_sql(CATEGORICAL)))
def q_category_domain(spark, sf_dir):
    return P.category_domain(cases_nulls(spark, sf_dir), CATEGORICAL)


@register("numeric_range", S.with_cases(
    """SELECT "column", round(min(value), 6) AS min, round(max(value), 6) AS max,
       round(median(value), 6) AS p50 FROM s GROUP BY 1 HAVING count(value) > 0""",
    nulls=True, s=stack_sql(NUMERIC, cast="DOUBLE")))
def q_numeric_range(spark, sf_dir):
    out = P.numeric_range(cases_nulls(spark, sf_dir), NUMERIC)
    return out.select("column", r6("min"), r6("max"), r6("p50"))


@register("label_domain", S.with_cases(
    "SELECT DISTINCT CAST(case_status AS VARCHAR) AS value FROM cases_nulls WHERE case_status IS NOT NULL", nulls=True))
def q_label_domain(spark, sf_dir):
    return P.label_domain(cases_nulls(spark, sf_dir), "case_status")


@register("expected_classes_found", S.with_cases(
    "SELECT count(DISTINCT case_status) FILTER (WHERE case_status IN ('F', 'O')) = 2 AS all_found "
    "FROM cases_nulls", nulls=True))
def q_expected_classes_found(spark, sf_dir):
    return P.expected_classes_found(cases_nulls(spark, sf_dir), "case_status", ["F", "O"])


@register("majority_baseline", S.with_cases(
    "SELECT round(max(n) / sum(n), 6) AS majority_share, CAST(sum(n) AS BIGINT) AS rows "
    "FROM (SELECT count(*) AS n FROM cases_nulls GROUP BY case_status)", nulls=True))
def q_majority_baseline(spark, sf_dir):
    out = P.majority_baseline(cases_nulls(spark, sf_dir), "case_status")
    return out.select(r6("majority_share"), F.col("rows").cast("bigint"))
