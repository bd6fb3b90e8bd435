"""Registered split / sample / ordering queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewise.functions.columns import is_numeric_type, label_filter_map, resolve_column
from casewise.operators import ordering as O
from casewise.operators import profile as P
from casewise.operators import quality as Q
from casewise.operators import sampling as SM
from casewise.plans import sql as S
from casewise.plans.catalog import register
from casewise.plans.common import run_dir
from casewise.session import cut_lineage
from casewise.sources.tables import read_table
from casewise.sources.views import CASE_COLUMNS, cases_nulls, cases_view

SEED = 42

# DuckDB twin of ``split_sizes`` + ``mark_lowest``: row_number over the whole class.
SPLIT_CTES = dict(
    h=f"SELECT *, coalesce(CAST(case_status AS VARCHAR), chr(0) || 'null') AS cls, "
      f"md5(concat_ws('|', '{SEED}', CAST(case_id AS VARCHAR))) AS hh FROM {{src}}",
    cc="SELECT cls, count(*) AS n_c FROM h GROUP BY 1",
    tot="SELECT sum(n_c) AS n, sum(n_c) - CAST(ceil(CAST(0.2 AS DOUBLE) * sum(n_c)) AS BIGINT) AS n_train "
        "FROM cc",
    al="SELECT cls, n_c, CAST(n_train AS DOUBLE) * n_c / n AS cont, floor(CAST(n_train AS DOUBLE) * n_c / n) AS fl, "
       "n_train FROM cc, tot",
    al2="SELECT *, n_train - sum(fl) OVER () AS need, "
        "row_number() OVER (ORDER BY cont - fl DESC, cls) AS rk FROM al",
    q="SELECT cls, n_c - (fl + CASE WHEN rk <= need THEN 1 ELSE 0 END) AS quota FROM al2",
    sp="SELECT h.*, CASE WHEN row_number() OVER (PARTITION BY h.cls ORDER BY hh, case_id) <= q.quota "
       "THEN 'test' ELSE 'train' END AS split FROM h JOIN q ON h.cls = q.cls",
)


def split_ctes(src: str) -> dict:
    d = dict(SPLIT_CTES)
    d["h"] = d["h"].format(src=src)
    return d


@register("stratified_split", S.with_cases(
    "SELECT case_id, case_status, split FROM sp", **split_ctes("cases")))
def q_stratified_split(spark, sf_dir):
    df = cases_view(spark, sf_dir).select("case_id", "case_status")
    return SM.stratified_split(df, "case_status", "case_id", 0.2, SEED)


_SAMPLE = 1000
_LAB = "upper(trim(coalesce(case_status, 'nan')))"


@register("stratified_sample", S.with_cases(
    f"""SELECT case_id, label FROM (
  SELECT case_id, label, row_number() OVER (PARTITION BY label ORDER BY
         md5(concat_ws('|', '{SEED + _SAMPLE}', CAST(case_id AS VARCHAR))), case_id) AS rn,
         CASE WHEN label = 1 THEN least(sp, n_pos) ELSE least({_SAMPLE} - sp, n_neg) END AS quota
  FROM lab, (SELECT count(*) FILTER (WHERE label = 1) AS n_pos, count(*) FILTER (WHERE label = 0) AS n_neg,
                    CAST(round_even({_SAMPLE} * (count(*) FILTER (WHERE label = 1) / count(*)), 0) AS BIGINT) AS sp
             FROM lab)) WHERE rn <= quota""",
    lab=f"SELECT case_id, CAST({_LAB} = 'F' AS INTEGER) AS label FROM cases WHERE {_LAB} IN ('F', 'O')"))
def q_stratified_sample(spark, sf_dir):
    lab = label_filter_map(cases_view(spark, sf_dir).select("case_id", "case_status"),
                           "case_status", "F", "O")
    return SM.stratified_sample(lab, "label", "case_id", _SAMPLE, SEED)


def _nulls_split(spark, sf_dir):
    return SM.stratified_split(cases_nulls(spark, sf_dir), "case_status", "case_id", 0.2, SEED)


def _missing_sql() -> str:
    parts = []
    for c in CASE_COLUMNS:
        parts.append(
            f"SELECT '{c}' AS \"column\", "
            f"round_even(100.0 * avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) FILTER (WHERE split = 'train'), 2) AS missing_train_percent, "
            f"round_even(100.0 * avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) FILTER (WHERE split = 'test'), 2) AS missing_test_percent "
            f"FROM sp")
    return S.with_cases(" UNION ALL ".join(parts), nulls=True, **split_ctes("cases_nulls"))


@register("missing_percent", _missing_sql())
def q_missing_percent(spark, sf_dir):
    """D13 + C3 + E3 on the E1 split of the NULL-injected view (one pass)."""
    return P.missing_percent_split(_nulls_split(spark, sf_dir))


@register("recent_top10", """
SELECT user_id, event_id, ts, event_type, value,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS INTEGER) AS rank
FROM events QUALIFY rank <= 10""")
def q_recent_top10(spark, sf_dir):
    """The ten newest events per user, newest first."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return O.top_k_per_group(ev, ["user_id"], [F.desc("ts")], 10, "event_id")


@register("column_diff", S.with_cases(
    "SELECT 'score' AS \"column\", 'train' AS side, count(score) AS non_null FROM cases_nulls "
    "UNION ALL SELECT 'wage_text', 'test', count(prevailing_wage) FROM cases_nulls", nulls=True))
def q_column_diff(spark, sf_dir):
    """Columns that only one of two written tables has, with their values counted."""
    path = run_dir(spark, "drift")
    view = cases_nulls(spark, sf_dir)
    view.write.parquet(f"{path}/train")
    view.drop("score").withColumn("wage_text", F.col("prevailing_wage").cast("string")).write.parquet(f"{path}/test")
    sides = {side: spark.read.parquet(f"{path}/{side}") for side in ("train", "test")}
    counts = [df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).unpivot([], df.columns, "column", "non_null")
              .withColumn("side", F.lit(side)) for side, df in sides.items()]
    return Q.column_diff(sides["train"], sides["test"]).join(counts[0].unionByName(counts[1]), ["column", "side"])


@register("validation_report", S.with_cases(
    """SELECT true AS status, count(*) FILTER (WHERE split = 'train') AS train_rows,
       CAST(12 AS BIGINT) AS train_cols, count(*) FILTER (WHERE split = 'test') AS test_rows,
       CAST(12 AS BIGINT) AS test_cols, 'CASE_STATUS' AS configured_target, 'case_status' AS resolved_target,
       (SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT CAST(case_status AS VARCHAR) AS v FROM sp
         WHERE split = 'train' AND case_status IS NOT NULL ORDER BY v LIMIT 20)) AS target_sample,
       true AS has_positive, true AS has_negative,
       (SELECT CAST(count(*) - count(DISTINCT (continent, education_of_employee, has_job_experience,
          requires_job_training, no_of_employees, yr_of_estab, region_of_employment, prevailing_wage,
          unit_of_wage, full_time_position, case_status, score)) AS BIGINT) FROM sp WHERE split = 'train')
         AS duplicates_train,
       (SELECT CAST(count(*) - count(DISTINCT (continent, education_of_employee, has_job_experience,
          requires_job_training, no_of_employees, yr_of_estab, region_of_employment, prevailing_wage,
          unit_of_wage, full_time_position, case_status, score)) AS BIGINT) FROM sp WHERE split = 'test')
         AS duplicates_test,
       '' AS issues
FROM sp""", nulls=True, **split_ctes("cases_nulls")))
def q_validation_report(spark, sf_dir):
    """G12 over the E1 split (id dropped, as the derive step does before validation)."""
    sp = cut_lineage(_nulls_split(spark, sf_dir).drop("case_id"))
    train = sp.where(F.col("split") == "train").drop("split")
    test = sp.where(F.col("split") == "test").drop("split")
    return Q.validation_report(train, test, "CASE_STATUS", "F", "O")


def _align_sql() -> str:
    parts = [f"SELECT '{c}' AS \"column\", count({c}) FILTER (WHERE split = 'train') AS non_null_train, "
             f"count({c}) FILTER (WHERE split = 'test') AS non_null_test FROM sp" for c in CASE_COLUMNS]
    return S.with_cases(" UNION ALL ".join(parts), nulls=True, **split_ctes("cases_nulls"))


@register("column_report_align", _align_sql())
def q_column_report_align(spark, sf_dir):
    """Per-column train and test statistics aligned on the column name
    (both splits in one pass; ``P.missing_percent`` aligns two separate frames
    with a full outer join)."""
    sp = _nulls_split(spark, sf_dir)
    cols = [c for c in sp.columns if c != "split"]
    is_tr, is_te = F.col("split") == "train", F.col("split") == "test"
    wide = sp.agg(*[F.count(F.when(is_tr, F.col(c))).alias(f"{c}__tr") for c in cols],
                  *[F.count(F.when(is_te, F.col(c))).alias(f"{c}__te") for c in cols])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__tr").alias("non_null_train"),
                                        F.col(f"{c}__te").alias("non_null_test")) for c in cols]))
    return wide.select(rows.alias("r")).select("r.*")


@register("sort_report", S.with_cases(
    "SELECT education_of_employee AS name, count(*) AS count FROM cases GROUP BY 1 ORDER BY count DESC, name"))
def q_sort_report(spark, sf_dir):
    """A report ordered by value, highest first, ties by name."""
    df = cases_view(spark, sf_dir).groupBy(F.col("education_of_employee").alias("name")) \
        .agg(F.count(F.lit(1)).alias("count"))
    return O.sort_report(df, "count", "name")


_SCHEMA_TYPES = {"case_id": "bigint", "no_of_employees": "bigint", "yr_of_estab": "bigint",
                 "prevailing_wage": "double", "score": "double"}


@register("schema_report", S.with_cases(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{_SCHEMA_TYPES.get(c, 'string')}' AS dtype, "
    f"{str(_SCHEMA_TYPES.get(c, 'string') != 'string').lower()} AS is_numeric, "
    f"{str(c == 'case_status').lower()} AS is_target, count({c}) AS non_null FROM cases_nulls" for c in CASE_COLUMNS), nulls=True))
def q_schema_report(spark, sf_dir):
    """A4: schema of a written and reread table (column, dtype, numeric?, target?, values)."""
    path = run_dir(spark, "schema")
    cases_nulls(spark, sf_dir).write.parquet(path)
    df = spark.read.parquet(path)
    target = resolve_column(df, "CASE_STATUS")
    rows = [(f.name, f.dataType.simpleString(), is_numeric_type(f.dataType), f.name == target)
            for f in df.schema.fields]
    meta = spark.createDataFrame(rows, "column string, dtype string, is_numeric boolean, is_target boolean")
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).unpivot([], df.columns, "column", "non_null")
    return meta.join(counts, "column")
