"""Registered feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from casewise.functions import features as FX
from casewise.operators import encode as EN
from casewise.operators import profile as PR
from casewise.operators.features import WageFeatures
from casewise.plans import sql as S
from casewise.plans.catalog import register
from casewise.plans.common import AS_OF_YEAR, dround, r6
from casewise.sources.views import cases_nulls, cases_view

WAGE_RATIO_SQL = S.with_cases(
    """
SELECT aw.case_id,
       round(aw.annual_wage, 6) AS annual_wage,
       round(aw.annual_wage / (coalesce(rm.m, g.m) + 1e-9), 6) AS wage_vs_region_median,
       round(aw.annual_wage / (coalesce(cm.m, g.m) + 1e-9), 6) AS wage_vs_continent_median
FROM aw CROSS JOIN g
LEFT JOIN rm ON aw.region_of_employment = rm.k
LEFT JOIN cm ON aw.continent = cm.k
""",
    aw=f"SELECT *, {S.annual()} AS annual_wage FROM cases",
    g="SELECT median(annual_wage) AS m FROM aw",
    rm="SELECT region_of_employment AS k, median(annual_wage) AS m FROM aw "
       "WHERE region_of_employment IS NOT NULL GROUP BY 1",
    cm="SELECT continent AS k, median(annual_wage) AS m FROM aw WHERE continent IS NOT NULL GROUP BY 1",
)


@register("wage_vs_group_median", WAGE_RATIO_SQL)
def wage_vs_group_median(spark, sf_dir):
    """F4 (with F2, D8, D9, C1): train medians by region/continent, ratio per row."""
    cases = cases_view(spark, sf_dir)
    model = WageFeatures().fit(cases)
    out = model.transform(cases)
    return out.select("case_id", r6("annual_wage"), r6("wage_vs_region_median"),
                      r6("wage_vs_continent_median"))


# --- F1, F3, F5, F6 -----------------------------------------------------------


@register("company_age", S.with_cases(
    f"SELECT case_id, CAST({AS_OF_YEAR} AS DOUBLE) - yr_of_estab AS company_age, "
    f"greatest(CAST({AS_OF_YEAR} AS DOUBLE) - (yr_of_estab + 30), CAST(0 AS DOUBLE)) AS company_age_clamped "
    f"FROM cases"))
def q_company_age(spark, sf_dir):
    """F1 (training form and serving clamp; the second shifts years to reach the clamp)."""
    df = cases_view(spark, sf_dir)
    return df.select("case_id", FX.company_age("yr_of_estab", AS_OF_YEAR).alias("company_age"),
                     FX.company_age(F.col("yr_of_estab") + 30, AS_OF_YEAR, clamp=True)
                     .alias("company_age_clamped"))


@register("wage_per_employee", S.with_cases(
    f"SELECT case_id, round({S.annual()} / (greatest(CAST(no_of_employees AS DOUBLE), 0.0) + 1.0), 6) "
    f"AS wage_per_employee FROM cases"))
def q_wage_per_employee(spark, sf_dir):
    df = cases_view(spark, sf_dir)
    return df.select("case_id", r6(FX.wage_per_employee(FX.annual_wage("prevailing_wage", "unit_of_wage"),
                                                        "no_of_employees"), "wage_per_employee"))


@register("log1p_features", S.with_cases(
    "SELECT case_id, round(ln(1 + CASE WHEN no_of_employees < 0 THEN 0.0 ELSE CAST(no_of_employees AS DOUBLE) END), 6) "
    "AS log1p_no_of_employees, "
    "round(ln(1 + CASE WHEN prevailing_wage < 0 THEN 0.0 ELSE prevailing_wage END), 6) AS log1p_prevailing_wage, "
    f"round(ln(1 + CASE WHEN {AS_OF_YEAR}.0 - yr_of_estab < 0 THEN 0.0 ELSE {AS_OF_YEAR}.0 - yr_of_estab END), 6) "
    "AS log1p_company_age FROM cases_nulls",
    nulls=True))
def q_log1p_features(spark, sf_dir):
    df = cases_nulls(spark, sf_dir).withColumn("company_age", FX.company_age("yr_of_estab", AS_OF_YEAR))
    return df.select("case_id", *[r6(FX.log1p_clipped(c), f"log1p_{c}")
                                  for c in ("no_of_employees", "prevailing_wage", "company_age")])


@register("missing_input_fallback", S.with_cases(
    """SELECT case_id, prevailing_wage AS annual_wage,
       round(prevailing_wage / (coalesce(cm.m, g.m) + 1e-9), 6) AS wage_vs_continent_median,
       CAST(NULL AS DOUBLE) AS wage_vs_region_median
FROM cases LEFT JOIN cm ON cases.continent = cm.k CROSS JOIN g""",
    g="SELECT median(prevailing_wage) AS m FROM cases",
    cm="SELECT continent AS k, median(prevailing_wage) AS m FROM cases GROUP BY 1"))
def q_missing_input_fallback(spark, sf_dir):
    """no unit column -> wage taken as annual; no region column -> NULL ratio."""
    df = cases_view(spark, sf_dir).drop("unit_of_wage", "region_of_employment")
    out = WageFeatures().fit(df).transform(df)
    return out.select("case_id", "annual_wage", r6("wage_vs_continent_median"), "wage_vs_region_median")


# --- F7, F8, F13 ----------------------------------------------------------------
@register("impute_mode", S.with_cases(
    "SELECT case_id, coalesce(continent, (SELECT continent FROM cases_nulls WHERE continent IS NOT NULL "
    "GROUP BY 1 ORDER BY count(*) DESC, continent LIMIT 1)) AS continent FROM cases_nulls", nulls=True))
def q_impute_mode(spark, sf_dir):
    df = cases_nulls(spark, sf_dir).select("case_id", "continent")
    return EN.ModeImputer(inputCols=["continent"]).fit(df).transform(df)


@register("impute_median", S.with_cases(
    "SELECT case_id, round(coalesce(prevailing_wage, (SELECT median(prevailing_wage) FROM cases_nulls)), 6) "
    "AS prevailing_wage FROM cases_nulls", nulls=True))
def q_impute_median(spark, sf_dir):
    df = cases_nulls(spark, sf_dir).select("case_id", "prevailing_wage")
    out = EN.MedianImputer(inputCols=["prevailing_wage"]).fit(df).transform(df)
    return out.select("case_id", r6("prevailing_wage"))


@register("standard_scale", S.with_cases(
    "SELECT case_id, round((prevailing_wage - (SELECT avg(prevailing_wage) FROM cases)) / "
    "(SELECT stddev_pop(prevailing_wage) FROM cases), 6) AS prevailing_wage, "
    "round((no_of_employees - (SELECT avg(no_of_employees) FROM cases)) / "
    "(SELECT stddev_pop(no_of_employees) FROM cases), 6) AS no_of_employees FROM cases"))
def q_standard_scale(spark, sf_dir):
    df = cases_view(spark, sf_dir).select("case_id", "prevailing_wage", "no_of_employees")
    cols = ["prevailing_wage", "no_of_employees"]
    out = EN.PopulationScaler(inputCols=cols).fit(df).transform(df)
    return out.select("case_id", *[r6(c) for c in cols])


# --- F9, F10, F14, F15 ----------------------------------------------------------
@register("one_hot", S.with_cases(
    """SELECT case_id, CAST(d.slot AS INTEGER) AS continent_slot, CAST((SELECT count(*) FROM dom) AS INTEGER) AS block_size
FROM cases LEFT JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS slot FROM dom) d ON cases.continent = d.v""",
    dom="SELECT DISTINCT continent AS v FROM cases WHERE continent <> 'EUROPE'"))
def q_one_hot(spark, sf_dir):
    """categories learnt without EUROPE; EUROPE rows get the all-zero block."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array
    df = cases_view(spark, sf_dir).select("case_id", "continent")
    model = Pipeline(stages=EN.one_hot_stages(["continent"])).fit(df.where(F.col("continent") != "EUROPE"))
    arr = vector_to_array(F.col("continent_oh"))
    out = model.transform(df)
    return out.select("case_id", F.nullif(F.array_position(arr, 1.0) - 1, F.lit(-1)).cast("int")
                      .alias("continent_slot"), F.size(arr).cast("int").alias("block_size"))


@register("ordinal_encode", S.with_cases(
    "SELECT case_id, CAST(dense_rank() OVER (ORDER BY education_of_employee) - 1 AS INTEGER) AS education_ord, "
    "CAST(dense_rank() OVER (ORDER BY unit_of_wage) - 1 AS INTEGER) AS unit_ord FROM cases"))
def q_ordinal_encode(spark, sf_dir):
    df = cases_view(spark, sf_dir).select("case_id", "education_of_employee", "unit_of_wage")
    st = EN.ordinal_stage(["education_of_employee", "unit_of_wage"])
    out = st.fit(df).transform(df)
    return out.select("case_id", F.col("education_of_employee_ord").cast("int").alias("education_ord"),
                      F.col("unit_of_wage_ord").cast("int").alias("unit_ord"))


_YJ_GRID = [-2.0, -1.0, -0.5, 0.0, 0.5, 1.0, 2.0]


def _psi_sql(x: str, lam: float) -> str:
    pos = f"ln(1 + {x})" if lam == 0 else f"(pow({x} + 1, {lam!r}) - 1) / {lam!r}"
    neg = f"-ln(1 - {x})" if lam == 2 else f"-(pow(1 - {x}, {2 - lam!r}) - 1) / {2 - lam!r}"
    return f"CASE WHEN {x} >= 0 THEN {pos} ELSE {neg} END"


def _yj_llf_sql() -> str:
    parts = []
    for c in ("no_of_employees", "prevailing_wage"):
        x = f"CAST({c} AS DOUBLE)"
        for lam in _YJ_GRID:
            parts.append(
                f"SELECT '{c}' AS \"column\", CAST({lam!r} AS DOUBLE) AS lambda, round(-0.5 * count({x}) * ln(var_pop({_psi_sql(x, lam)})) "
                f"+ {lam - 1.0!r} * sum(sign({x}) * ln(1 + abs({x}))), 4) AS llf FROM cases")
    return S.with_cases(" UNION ALL ".join(parts))


@register("yeo_johnson_llf", _yj_llf_sql())
def q_yeo_johnson_llf(spark, sf_dir):
    """F11, one grid round: log-likelihood of each candidate lambda."""
    cols = ["no_of_employees", "prevailing_wage"]
    out = EN.yeo_johnson_llf(cases_view(spark, sf_dir), cols, {c: _YJ_GRID for c in cols})
    return out.select("column", "lambda", dround(F.col("llf"), 4).alias("llf"))


def power_ctes(stacked: str, reach: float = 8.0) -> dict[str, str]:
    """CTEs that find each column's best exponent in SQL: bisection on the derivative of the likelihood
    (from ends that do not halve to 0 or 2, where the formulas have a gap).

    ``stacked`` selects ("column", value); ``yj_best`` then holds ("column", lambda).
    """
    g = "(exp(e * l) - 1) / e"
    slope = "(exp(e * l) * (e * l - 1) + 1) / (e * e)"
    return {
        "yj_rows": f"SELECT \"column\" AS c, value >= 0 AS up, ln(1 + abs(value)) AS l FROM ({stacked}) WHERE value IS NOT NULL",
        "yj_sums": "SELECT c, count(*) AS n, sum(CASE WHEN up THEN l ELSE -l END) AS k FROM yj_rows GROUP BY c",
        "yj_steps": f"""SELECT c, -{0.9 * reach!r}::DOUBLE AS lo, {1.1 * reach!r}::DOUBLE AS hi, 0 AS step FROM yj_sums UNION ALL
  SELECT c, CASE WHEN d > 0 THEN mid ELSE lo END, CASE WHEN d > 0 THEN hi ELSE mid END, step + 1 FROM (
    SELECT c, lo, hi, mid, step, k - n * covar_pop(t, u) / var_pop(t) AS d FROM (
      SELECT c, lo, hi, mid, step, n, k, CASE WHEN up THEN {g} ELSE -({g}) END AS t, {slope} AS u FROM (
        SELECT s.c, lo, hi, (lo + hi) / 2 AS mid, step, n, k, up, l,
               CASE WHEN up THEN (lo + hi) / 2 ELSE 2 - (lo + hi) / 2 END AS e
        FROM yj_steps s JOIN yj_rows r ON r.c = s.c JOIN yj_sums m ON m.c = s.c WHERE step < 45))
    GROUP BY c, lo, hi, mid, step, n, k)""",
        "yj_best": "SELECT c AS \"column\", (lo + hi) / 2 AS \"lambda\" FROM yj_steps WHERE step = 45"}


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@register("yeo_johnson_fit", recursive(S.with_cases(
    'SELECT "column", round("lambda", 4) AS "lambda" FROM yj_best',
    **power_ctes(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM cases" for c in ("no_of_employees", "prevailing_wage"))))))
def q_yeo_johnson_fit(spark, sf_dir):
    """maximum-likelihood lambda per column by Brent's method."""
    cols = ["no_of_employees", "prevailing_wage"]
    m = EN.YeoJohnson(inputCols=cols).fit(cases_view(spark, sf_dir))
    lam = m.getOrDefault(m.lambdas)
    return spark.createDataFrame([(c, round(x, 4)) for c, x in zip(cols, lam)], "column string, lambda double")


@register("yeo_johnson_apply", S.with_cases(
    f"SELECT case_id, round((p - avg(p) OVER ()) / stddev_pop(p) OVER (), 6) AS no_of_employees "
    f"FROM (SELECT case_id, {_psi_sql('CAST(no_of_employees AS DOUBLE)', 0.5)} AS p FROM cases)"))
def q_yeo_johnson_apply(spark, sf_dir):
    """psi at a given lambda, then standardised."""
    df = cases_view(spark, sf_dir).select("case_id", "no_of_employees")
    psi = EN.yeo_johnson(F.col("no_of_employees").cast("double"), 0.5)
    means, stds = EN._scale_stats(df, {"p": psi})
    return df.select("case_id", r6((psi - F.lit(means[0])) / F.lit(stds[0]), "no_of_employees"))


ONEHOT = ["continent", "unit_of_wage", "region_of_employment", "education_of_employee",
          "has_job_experience", "requires_job_training", "full_time_position"]
POWER = ["company_age", "no_of_employees", "annual_wage", "wage_per_employee"]


OTHER = ["prevailing_wage", "wage_vs_region_median", "wage_vs_continent_median", "log1p_annual_wage", "log1p_wage_per_employee",
         "log1p_company_age", "log1p_no_of_employees", "log1p_prevailing_wage"]


def column_transformer_sql() -> str:
    """Width and sum of the feature vector: each block of categories sums to 1, numbers are imputed, transformed and scaled.

    Not an oracle to the last digit: an exponent that maximises a flat likelihood is known to about eight digits,
    so sums agree to about 1e-4 of a deviation; a test compares them.
    """
    def filled(c):
        return f"coalesce(CAST({c} AS DOUBLE), median(CAST({c} AS DOUBLE)) OVER ()) AS {c}"

    def scaled(x):
        return f"({x} - avg({x}) OVER ()) / stddev_pop({x}) OVER ()"
    logs = {f"log1p_{c}": f"ln(1 + CASE WHEN {c} < 0 THEN 0.0 ELSE CAST({c} AS DOUBLE) END)" for c in FX.LOG_FEATURES}
    psi = 'CASE WHEN value >= 0 THEN (pow(1 + value, "lambda") - 1) / "lambda" ELSE -(pow(1 - value, 2 - "lambda") - 1) / (2 - "lambda") END'
    width = " + ".join(f"(SELECT count(DISTINCT {c}) FROM cases)" for c in ONEHOT)
    return recursive(S.with_cases(
        f"""SELECT case_id, CAST({width} + {len(POWER) + len(OTHER)} AS INTEGER) AS n_features, power + other + {len(ONEHOT)} AS total
FROM (SELECT case_id, sum(z) AS power FROM (SELECT case_id, (t - avg(t) OVER w) / stddev_pop(t) OVER w AS z FROM powered WINDOW w AS (PARTITION BY "column"))
      GROUP BY case_id) JOIN (SELECT case_id, {" + ".join(scaled(c) for c in OTHER)} AS other FROM filled) USING (case_id)""",
        aw=f"SELECT *, {S.annual()} AS annual_wage, CAST({AS_OF_YEAR} AS DOUBLE) - yr_of_estab AS company_age FROM cases",
        ratios="""SELECT *, annual_wage / (greatest(CAST(no_of_employees AS DOUBLE), 0.0) + 1.0) AS wage_per_employee,
       annual_wage / (median(annual_wage) OVER (PARTITION BY region_of_employment) + 1e-9) AS wage_vs_region_median,
       annual_wage / (median(annual_wage) OVER (PARTITION BY continent) + 1e-9) AS wage_vs_continent_median FROM aw""",
        logged=f"SELECT *, {', '.join(f'{e} AS {n}' for n, e in logs.items())} FROM ratios",
        filled=f"SELECT case_id, {', '.join(filled(c) for c in dict.fromkeys(POWER + OTHER))} FROM logged",
        stacked=" UNION ALL ".join(f"SELECT case_id, '{c}' AS \"column\", {c} AS value FROM filled" for c in POWER),
        **power_ctes('SELECT "column", value FROM stacked', 30.0),
        powered=f'SELECT case_id, "column", {psi} AS t FROM stacked JOIN yj_best USING ("column")'))


@register("column_transformer")
def q_column_transformer(spark, sf_dir):
    """the full preprocessing pipeline fitted on all cases; width and sum of each case's vector."""
    from pyspark.ml.functions import vector_to_array
    df = derived_cases(cases_view(spark, sf_dir))
    pipe = EN.column_transformer(ONEHOT, POWER, OTHER)
    out = pipe.fit(df).transform(df)
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, b: a + b)
    return out.select("case_id", F.size(vector_to_array("features")).alias("n_features"), total.alias("total"))


def derived_cases(df):
    """cases with company_age and the wage features (fitted on the same rows)."""
    from casewise.operators.features import derive_basic
    base = derive_basic(df.withColumnRenamed("case_id", "__id"), AS_OF_YEAR, id_col="case_id")
    out = WageFeatures().fit(base).transform(base)
    return out.withColumnRenamed("__id", "case_id")


def _feature_names_sql() -> str:
    parts = [f"SELECT {i} AS blk, '{c}_imp_oh_' || v AS name, v FROM (SELECT DISTINCT {c} AS v FROM cases)"
             for i, c in enumerate(ONEHOT)]
    tail = [f"{c}_pow" for c in POWER] + ["prevailing_wage_sc"]
    parts += [f"SELECT {len(ONEHOT) + j} AS blk, '{n}' AS name, '' AS v" for j, n in enumerate(tail)]
    return S.with_cases("SELECT CAST(row_number() OVER (ORDER BY blk, v) - 1 AS INTEGER) AS slot, name FROM n",
                        n=" UNION ALL ".join(parts))


@register("feature_names", _feature_names_sql())
def q_feature_names(spark, sf_dir):
    """names of the assembled feature slots."""
    df = derived_cases(cases_view(spark, sf_dir))
    out = EN.column_transformer(ONEHOT, POWER, ["prevailing_wage"]).fit(df).transform(df)
    names = EN.assembled_feature_names(out)
    return spark.createDataFrame(list(enumerate(names)), "slot int, name string")


# --- F16, F17 -----------------------------------------------------------------
def _presets(spark, sf_dir):
    df = cases_view(spark, sf_dir)
    ranges = {r["column"]: r.asDict() for r in PR.numeric_range(df, ["prevailing_wage", "yr_of_estab"]).collect()}
    domains = {}
    first_two = PR.category_domain(df, ["has_job_experience", "full_time_position", "requires_job_training"]) \
        .where(F.col("position") <= 2)  # the presets name the first two values at most
    for r in first_two.orderBy("column", "position").collect():
        domains.setdefault(r["column"], []).append(r["value"])
    return df, FX.fill_presets(ranges, domains, AS_OF_YEAR)


_PRESET_NAMES = list(FX.PRESETS)


@register("scenario_expand", S.with_cases(
    f"""SELECT case_id, p.preset,
       CAST(coalesce(p.wage, cases.prevailing_wage) AS DOUBLE) AS prevailing_wage,
       CAST(coalesce(p.yr, cases.yr_of_estab) AS BIGINT) AS yr_of_estab,
       coalesce(p.exp, has_job_experience) AS has_job_experience,
       coalesce(p.ft, full_time_position) AS full_time_position,
       coalesce(p.tr, requires_job_training) AS requires_job_training
FROM cases CROSS JOIN (
  SELECT '{_PRESET_NAMES[0]}' AS preset, floor(min(prevailing_wage) + 0.5) AS wage, {AS_OF_YEAR - 5} AS yr,
         'Y' AS exp, 'Y' AS ft, 'N' AS tr FROM cases
  UNION ALL SELECT '{_PRESET_NAMES[1]}', floor(max(prevailing_wage) + 0.5), floor(min(yr_of_estab) + 0.5),
         'N', 'N', 'Y' FROM cases
  UNION ALL SELECT '{_PRESET_NAMES[2]}', floor(median(prevailing_wage) + 0.5), floor(median(yr_of_estab) + 0.5),
         'N', NULL, 'N' FROM cases) p"""))
def q_scenario_expand(spark, sf_dir):
    """F16: each case under the three what-if presets (sorted Y/N domains are [N, Y])."""
    df, presets = _presets(spark, sf_dir)
    out = FX.scenario_expand(df.select("case_id", "prevailing_wage", "yr_of_estab", "has_job_experience",
                                       "full_time_position", "requires_job_training"), presets)
    return out


@register("format_pct", S.with_cases(
    "SELECT case_id, CAST(CAST(floor(score * 100.0 + 0.5) AS BIGINT) AS VARCHAR) || '%' AS score_pct FROM cases"))
def q_format_pct(spark, sf_dir):
    df = cases_view(spark, sf_dir)
    return df.select("case_id", FX.format_pct("score").alias("score_pct"))


@register("annual_wage", S.with_cases(f"SELECT case_id, unit_of_wage, round({S.annual()}, 6) AS annual_wage FROM cases_nulls",
                                      nulls=True))
def q_annual_wage(spark, sf_dir):
    """wage x unit factor (containment match, later unit wins)."""
    df = cases_nulls(spark, sf_dir)
    return df.select("case_id", "unit_of_wage", r6(FX.annual_wage("prevailing_wage", "unit_of_wage"), "annual_wage"))


@register("group_median_lookup", S.with_cases(
    """SELECT case_id, continent, round(coalesce(m.med, (SELECT median(prevailing_wage) FROM cases_nulls)), 6) AS median
FROM cases_nulls LEFT JOIN (SELECT continent AS k, median(prevailing_wage) AS med FROM cases_nulls
                            WHERE continent IS NOT NULL GROUP BY 1) m ON cases_nulls.continent = m.k""", nulls=True))
def q_group_median_lookup(spark, sf_dir):
    """Each row's group median (train statistics), global median for NULL / unseen keys."""
    from casewise.operators.joins import lookup_with_default
    from casewise.operators.quantiles import group_quantiles
    df = cases_nulls(spark, sf_dir)
    glob = group_quantiles(df, [], "prevailing_wage", [0.5], ["m"]).first()["m"]
    med = group_quantiles(df.where(F.col("continent").isNotNull()), ["continent"], "prevailing_wage",
                          [0.5], ["median"]).withColumnRenamed("continent", "k")
    out = lookup_with_default(df.select("case_id", "continent"), "continent", med, "k", "median",
                              F.lit(glob), "median")
    return out.select("case_id", "continent", r6("median"))
