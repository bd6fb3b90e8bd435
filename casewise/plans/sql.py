"""DuckDB oracle building blocks mirroring ``casewise.sources.views``."""

CASES = """
SELECT o.o_orderkey AS case_id,
       r.r_name AS continent,
       o.o_orderpriority AS education_of_employee,
       CASE WHEN o.o_orderkey % 2 = 0 THEN 'Y' ELSE 'N' END AS has_job_experience,
       CASE WHEN o.o_orderkey % 3 = 0 THEN 'Y' ELSE 'N' END AS requires_job_training,
       CAST(floor(c.c_acctbal) AS BIGINT) AS no_of_employees,
       CAST(year(o.o_orderdate) AS BIGINT) AS yr_of_estab,
       n.n_name AS region_of_employment,
       o.o_totalprice AS prevailing_wage,
       CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'Hour' WHEN 'FURNITURE' THEN 'Week'
            WHEN 'BUILDING' THEN 'Month' ELSE 'Year' END AS unit_of_wage,
       CASE WHEN o.o_orderkey % 5 = 0 THEN 'Y' ELSE 'N' END AS full_time_position,
       o.o_orderstatus AS case_status,
       o.o_totalprice / CAST(500000.0 AS DOUBLE) AS score
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""

CASES_NULLS = """
SELECT case_id,
       CASE WHEN case_id % 19 = 0 THEN NULL ELSE continent END AS continent,
       education_of_employee, has_job_experience, requires_job_training, no_of_employees,
       yr_of_estab, region_of_employment,
       CASE WHEN case_id % 17 = 0 THEN NULL ELSE prevailing_wage END AS prevailing_wage,
       unit_of_wage, full_time_position,
       CASE WHEN case_id % 23 = 0 THEN NULL ELSE case_status END AS case_status,
       score
FROM cases
"""

ANNUAL_FACTOR = """CAST(CASE WHEN lower(trim({u})) LIKE '%year%' THEN 1.0
     WHEN lower(trim({u})) LIKE '%month%' THEN 12.0
     WHEN lower(trim({u})) LIKE '%week%' THEN 52.0
     WHEN lower(trim({u})) LIKE '%hour%' THEN 2080.0 ELSE 1.0 END AS DOUBLE)"""


def annual(wage: str = "prevailing_wage", unit: str = "unit_of_wage") -> str:
    return f"(CAST({wage} AS DOUBLE) * {ANNUAL_FACTOR.format(u=unit)})"


def with_cases(body: str, nulls: bool = False, **ctes: str) -> str:
    """Prefix ``body`` with the ``cases`` (and optionally ``cases_nulls``) CTEs."""
    parts = [f"cases AS ({CASES})"]
    if nulls:
        parts.append(f"cases_nulls AS ({CASES_NULLS})")
    parts += [f"{k} AS ({v})" for k, v in ctes.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body
