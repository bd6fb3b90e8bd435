"""Hand-made fixtures for projections, predicates and scalar features."""

import math

import pytest
from pyspark.sql import functions as F

from casewise.functions import columns as C
from casewise.functions import features as FX
from casewise.operators.features import WageFeatures


def test_resolve_column():
    assert C.resolve_column(["case id", "case status"], "CASE_STATUS") == "case status"
    assert C.resolve_column(["a", "CASE_STATUS"], "CASE_STATUS") == "CASE_STATUS"
    assert C.resolve_column(["a"], "b") is None


def test_label_filter_map(spark):
    df = spark.createDataFrame([(1, " certified "), (2, "DENIED"), (3, "Pending"), (4, None)],
                               "id int, s string")
    out = C.label_filter_map(df, "s", "CERTIFIED", "Denied").orderBy("id").collect()
    assert [(r.id, r.label) for r in out] == [(1, 1), (2, 0)]
    cnt = C.label_filter_counts(df, "s", "CERTIFIED", "Denied").first()
    assert (cnt.kept, cnt.dropped) == (2, 2)


def test_label_encode_neg(spark):
    df = spark.createDataFrame([("Denied",), ("Certified",), (None,)], "s string")
    assert [r[0] for r in df.select(C.label_encode_neg("s", "Denied")).collect()] == [1, 0, 0]


def test_annual_wage_units(spark):
    units = ["Hour", "week", "MONTH", "Year", "hour/year", "??", None]
    df = spark.createDataFrame([(10.0, u) for u in units], "w double, u string")
    got = [r[0] for r in df.select(FX.annual_wage("w", "u")).collect()]
    assert got == [20800.0, 520.0, 120.0, 10.0, 10.0, 10.0, 10.0]


def test_wage_per_employee(spark):
    df = spark.createDataFrame([(100.0, -5), (100.0, 0), (100.0, 9), (100.0, None)], "a double, e int")
    got = [r[0] for r in df.select(FX.wage_per_employee(F.col("a"), "e")).collect()]
    assert got == [100.0, 100.0, 10.0, None]


def test_company_age(spark):
    df = spark.createDataFrame([("2005",), ("2030",), ("x",)], "y string")
    got = [r[0] for r in df.select(FX.company_age("y", 2025)).collect()]
    clamped = [r[0] for r in df.select(FX.company_age("y", 2025, clamp=True)).collect()]
    assert got == [20.0, -5.0, None]
    assert clamped == [20.0, 0.0, None]


def test_wage_vs_group_median(spark):
    train = spark.createDataFrame([(10.0, "A"), (20.0, "A"), (30.0, "A"), (100.0, "B")],
                                  "prevailing_wage double, region_of_employment string")
    model = WageFeatures().fit(train)
    assert model.global_median == 25.0
    apply = spark.createDataFrame([(1, 40.0, "A"), (2, 40.0, "Z"), (3, 40.0, None)],
                                  "id int, prevailing_wage double, region_of_employment string")
    out = {r.id: r.wage_vs_region_median for r in model.transform(apply).collect()}
    assert out[1] == pytest.approx(40 / (20 + 1e-9), rel=1e-15)
    assert out[2] == pytest.approx(40 / (25 + 1e-9), rel=1e-15)
    assert out[3] == pytest.approx(40 / (25 + 1e-9), rel=1e-15)


def test_missing_inputs_fallback(spark):
    df = spark.createDataFrame([(1, 50.0)], "id int, prevailing_wage double")
    out = WageFeatures().fit(df).transform(df).first()
    assert out.annual_wage == 50.0 and out.wage_per_employee is None
    assert out.wage_vs_region_median is None and out.wage_vs_continent_median is None


def test_rule_validate(spark):
    df = spark.createDataFrame([(0, 0.0, 1899), (5, 10.0, 2000)], "e int, w double, y int")
    out = C.rule_validate(df, 2025, "e", "w", "y").collect()
    assert len(out[0].errors) == 3 and not out[0].valid
    assert out[1].errors == [] and out[1].valid


def test_snap_to_domain(spark):
    df = spark.createDataFrame([("Mars",), ("Asia",)], "continent string")
    dom = spark.createDataFrame([("Asia",), ("Africa",)], "value string")
    got = [r[0] for r in C.snap_to_domain(df, "continent", dom).collect()]
    assert sorted(got) == ["Africa", "Asia"]


def test_format_pct(spark):
    df = spark.createDataFrame([(0.955,), (float("nan"),), (None,), (0.005,)], "x double")
    got = [r[0] for r in df.select(FX.format_pct("x")).collect()]
    assert got[0] == "96%" and got[1] == "—" and got[2] == "—" and got[3] == "1%"


def test_scenario_presets():
    ranges = {"prevailing_wage": {"min": 1000.4, "max": 5000.5, "p50": 2500.0}, "yr_of_estab": {"min": 1995, "p50": 1998.5}}
    yn = {f: ["N", "Y"] for f in ("has_job_experience", "full_time_position", "requires_job_training")}
    low, high, mid = FX.fill_presets(ranges, yn, 2025)
    assert (low["prevailing_wage"], low["yr_of_estab"], low["has_job_experience"], low["requires_job_training"]) == (1000, 2020, "Y", "N")
    assert (high["prevailing_wage"], high["yr_of_estab"], high["full_time_position"]) == (5001, 1995, "N")
    assert mid["yr_of_estab"] == 1999 and mid["full_time_position"] is None
    low, high, mid = FX.fill_presets({}, {}, 2025)
    assert [p["prevailing_wage"] for p in (low, high, mid)] == [25000, 120000, 65000]
    assert (low["has_job_experience"], high["yr_of_estab"], mid["requires_job_training"]) == ("N", 1998, "Y")


def test_resolve_column_and_ambiguous_names():
    cols = ["case_id", "Case Status", "CASE-STATUS", "wage"]
    assert C.resolve_column(cols, "case_status") == "Case Status" and C.resolve_column(cols, "CASE-STATUS") == "CASE-STATUS"
    assert C.resolve_column(cols, "nope") is None and C.ambiguous_columns(cols) == [["Case Status", "CASE-STATUS"]]


def test_align_columns(spark):
    df = spark.createDataFrame([(1, "x", 9)], "a int, b string, z int")
    out = C.align_columns(df, [("b", "string"), ("c", "double"), ("a", "bigint")])
    assert out.columns == ["b", "c", "a"] and out.first().c is None


def test_row_by_index(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert C.row_by_index(df, 42, "k").first().k == 42
    with pytest.raises(IndexError):
        C.row_by_index(df, 100, "k")


def test_classify_columns(spark):
    df = spark.createDataFrame([(i, str(i % 3), float(i)) for i in range(40)], "a int, b string, c double")
    out = {r.column: r for r in C.classify_columns(df).collect()}
    assert out["b"].kind == "categorical" and out["b"].n_unique == 3
    assert out["a"].is_continuous and not out["a"].is_discrete
    assert math.isclose(out["c"].n_unique, 40)


def test_to_number_text_and_nan(spark):
    df = spark.createDataFrame([(" 12 ",), ("x",), ("NaN",), ("1e3",)], "s string")
    assert [r[0] for r in df.select(FX.to_number("s")).collect()] == [12.0, None, None, 1000.0]


def test_wage_model_save_load_without_region(spark, tmp_path):
    from casewise.operators.features import WageFeatureModel
    df = spark.createDataFrame([(1, 10.0, "Asia"), (2, 30.0, "Asia")], "id int, prevailing_wage double, continent string")
    m = WageFeatures().fit(df)
    m.save(str(tmp_path / "w"))
    back = WageFeatureModel.load(spark, str(tmp_path / "w"))
    a = sorted(r.wage_vs_continent_median for r in m.transform(df).collect())
    b = sorted(r.wage_vs_continent_median for r in back.transform(df).collect())
    assert a == b and back.region_medians is None


@pytest.mark.parametrize("f, best", [
    (lambda x: -(x - 0.3) ** 2, 0.3), (lambda x: -abs(x - 17.5), 17.5), (lambda x: -math.cosh((x + 40) / 9), -40.0),
    (lambda x: float("nan") if x > 1 else -(x - 0.9) ** 4, 0.9), (lambda x: math.log(x + 3) - x if x > -3 else -math.inf, -2.0)])
def test_parabolic_search_finds_the_maximum(f, best):
    from casewise.operators.encode import parabolic_search
    search = parabolic_search(-2.0, 2.0, 1e4)
    x, asked = next(search), 0
    try:
        while True:
            x, asked = search.send(f(x)), asked + 1
    except StopIteration as end:
        assert abs(end.value - best) < (1e-3 if best == 0.9 else 2e-6) and asked < 90
    with pytest.raises(ValueError, match="no maximum"):
        search = parabolic_search(-2.0, 2.0, 1e4)
        x = next(search)
        while True:
            x = search.send(x)


def test_power_likelihood_of_one_exponent_needs_no_unpivot(spark):
    """one pass over the columns as they stand gives the likelihoods of the stacked pass, also for odd columns."""
    import pytest
    from pyspark.sql import functions as F
    from casewise.operators import encode as EN
    df = spark.range(500).select(((F.col("id") * 37 % 101) - 20).cast("double").alias("a b"),
                                 F.when(F.col("id") % 3 > 0, F.col("id") / 7.0).alias("n"),
                                 F.lit(None).cast("double").alias("none"))
    at = {"a b": 0.0, "n": 2.0, "none": 0.7}
    constants = EN.yeo_johnson_constants(df, list(at))
    want = {r["column"]: r["llf"] for r in EN.yeo_johnson_llf(df, list(at), {c: [x] for c, x in at.items()}, constants).collect()}
    got = EN.yeo_johnson_llf_at(df, at, constants)
    assert got["none"] is None and want.get("none") is None
    assert got["a b"] == pytest.approx(want["a b"], rel=1e-12) and got["n"] == pytest.approx(want["n"], rel=1e-12)
