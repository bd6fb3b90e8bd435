"""Registered projection / predicate queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewise.functions import columns as C
from casewise.plans import sql as S
from casewise.plans.catalog import register
from casewise.plans.common import AS_OF_YEAR
from casewise.sources.views import CASE_COLUMNS, cases_nulls, cases_view


@register("resolve_column", S.with_cases("SELECT case_status, case_id, prevailing_wage FROM cases"))
def q_resolve_column(spark, sf_dir):
    df = cases_view(spark, sf_dir)
    names = [C.resolve_column(df, n) for n in ("CASE_STATUS", "Case Id", "Prevailing-Wage")]
    return df.select(*names)


_NORM = "upper(trim(coalesce(case_status, 'nan')))"


@register("label_filter_map", S.with_cases(
    f"SELECT case_id, CAST({_NORM} = 'F' AS INTEGER) AS label FROM cases_nulls "
    f"WHERE {_NORM} IN ('F', 'O')", nulls=True))
def q_label_filter_map(spark, sf_dir):
    df = cases_nulls(spark, sf_dir).select("case_id", "case_status")
    return C.label_filter_map(df, "case_status", " f", "o ").select("case_id", "label")


@register("label_filter_counts", S.with_cases(
    f"SELECT count(*) FILTER (WHERE {_NORM} IN ('F', 'O')) AS kept, "
    f"count(*) FILTER (WHERE {_NORM} NOT IN ('F', 'O')) AS dropped FROM cases_nulls", nulls=True))
def q_label_filter_counts(spark, sf_dir):
    return C.label_filter_counts(cases_nulls(spark, sf_dir), "case_status", "F", "O")


@register("label_encode_neg", S.with_cases(
    "SELECT case_id, CAST(CASE WHEN case_status = 'O' THEN 1 ELSE 0 END AS INTEGER) AS label "
    "FROM cases_nulls", nulls=True))
def q_label_encode_neg(spark, sf_dir):
    df = cases_nulls(spark, sf_dir)
    return df.select("case_id", C.label_encode_neg("case_status", "O").alias("label"))


_KEPT = [c for c in CASE_COLUMNS if c not in ("case_id", "case_status")]


@register("drop_columns", S.with_cases(f"SELECT {', '.join(_KEPT)} FROM cases"))
def q_drop_columns(spark, sf_dir):
    return C.drop_columns(cases_view(spark, sf_dir), ["case_id", "case_status", "not_there"])


@register("head_n", S.with_cases(
    "SELECT * FROM cases ORDER BY prevailing_wage DESC, case_id LIMIT 10"))
def q_head_n(spark, sf_dir):
    return C.head_n(cases_view(spark, sf_dir), 10, [F.desc("prevailing_wage"), "case_id"])


@register("shape", S.with_cases(
    f"SELECT count(*) AS rows, CAST({len(CASE_COLUMNS)} AS BIGINT) AS columns FROM cases"))
def q_shape(spark, sf_dir):
    return C.shape(cases_view(spark, sf_dir))


@register("row_by_index", S.with_cases("SELECT * FROM cases ORDER BY case_id LIMIT 1 OFFSET 42"))
def q_row_by_index(spark, sf_dir):
    return C.row_by_index(cases_view(spark, sf_dir), 42, "case_id")


_ALIGN = [("case_id", "bigint"), ("continent", "string"), ("company_size", "bigint"),
          ("prevailing_wage", "double")]


@register("align_columns", S.with_cases(
    "SELECT case_id, continent, CAST(NULL AS BIGINT) AS company_size, prevailing_wage FROM cases"))
def q_align_columns(spark, sf_dir):
    return C.align_columns(cases_view(spark, sf_dir), _ALIGN)


@register("numeric_coerce", S.with_cases(
    "SELECT case_id, TRY_CAST(education_of_employee AS DOUBLE) AS education_num, "
    "TRY_CAST(CAST(no_of_employees AS VARCHAR) AS DOUBLE) AS employees_num, "
    "TRY_CAST(has_job_experience AS DOUBLE) AS flag_num FROM cases"))
def q_numeric_coerce(spark, sf_dir):
    df = cases_view(spark, sf_dir)
    return df.select("case_id", C.numeric_coerce("education_of_employee").alias("education_num"),
                     C.numeric_coerce("no_of_employees").alias("employees_num"),
                     C.numeric_coerce("has_job_experience").alias("flag_num"))


_E1 = "(no_of_employees IS NULL OR no_of_employees < 1)"
_E2 = "(prevailing_wage IS NULL OR prevailing_wage <= 0)"
_E3 = f"(yr_of_estab IS NULL OR yr_of_estab < 1900 OR yr_of_estab > {AS_OF_YEAR})"


@register("rule_validate", S.with_cases(
    f"""SELECT case_id,
       ({_E1}::INT + {_E2}::INT + {_E3}::INT) = 0 AS valid,
       CAST({_E1}::INT + {_E2}::INT + {_E3}::INT AS INTEGER) AS n_errors,
       concat_ws('|', CASE WHEN {_E1} THEN 'no_of_employees: {C.EMPLOYEES_MSG}' END,
                      CASE WHEN {_E2} THEN 'prevailing_wage: {C.WAGE_MSG}' END,
                      CASE WHEN {_E3} THEN 'yr_of_estab: {C.YEAR_MSG.format(year=AS_OF_YEAR)}' END) AS errors
FROM cases_nulls""", nulls=True))
def q_rule_validate(spark, sf_dir):
    out = C.rule_validate(cases_nulls(spark, sf_dir), AS_OF_YEAR)
    return out.select("case_id", "valid", F.size("errors").alias("n_errors"),
                      F.concat_ws("|", "errors").alias("errors"))


def _padded_payload(spark, sf_dir):
    df = cases_view(spark, sf_dir)
    cols = [F.col("case_id")]
    for c in C.PAYLOAD_STRINGS:
        cols.append(F.concat(F.lit("  "), F.col(c), F.lit(" ")).alias(c))
    for c in C.PAYLOAD_NUMBERS:
        cols.append(F.col(c).cast("string").alias(c))
    return df.select(*cols)


@register("trim_cast_payload", S.with_cases(
    "SELECT case_id, " + ", ".join(f"{c}" for c in C.PAYLOAD_STRINGS) + ", "
    + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in C.PAYLOAD_NUMBERS) + " FROM cases"))
def q_trim_cast_payload(spark, sf_dir):
    return C.trim_cast_payload(_padded_payload(spark, sf_dir))


@register("snap_to_domain", S.with_cases(
    """SELECT case_id, CASE WHEN region_of_employment IN (SELECT v FROM dom) THEN region_of_employment
       ELSE (SELECT min(v) FROM dom) END AS region_of_employment FROM cases""",
    dom="SELECT DISTINCT region_of_employment AS v FROM cases WHERE continent <> 'ASIA'"))
def q_snap_to_domain(spark, sf_dir):
    df = cases_view(spark, sf_dir)
    domain = df.where(F.col("continent") != "ASIA").select(F.col("region_of_employment").alias("value"))
    return C.snap_to_domain(df.select("case_id", "region_of_employment"), "region_of_employment", domain)


_TYPES = {"case_id": "bigint", "no_of_employees": "bigint", "yr_of_estab": "bigint",
          "prevailing_wage": "double", "score": "double"}


def _classify_sql() -> str:
    parts = []
    for i, c in enumerate(CASE_COLUMNS):
        t = _TYPES.get(c, "string")
        kind = "numeric" if t != "string" else "categorical"
        parts.append(
            f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", '{t}' AS dtype, '{kind}' AS kind, "
            f"CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_unique "
            f"FROM cases")
    body = " UNION ALL ".join(parts)
    return S.with_cases(
        "SELECT position, \"column\", dtype, kind, n_unique, "
        "kind = 'numeric' AND n_unique <= 25 AS is_discrete, "
        "kind = 'numeric' AND n_unique > 25 AS is_continuous, "
        "kind = 'numeric' AND n_unique >= 10 AS is_continuous_ge10 FROM u", u=body)


@register("classify_columns", _classify_sql())
def q_classify_columns(spark, sf_dir):
    return C.classify_columns(cases_view(spark, sf_dir))
