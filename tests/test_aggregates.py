"""Profiling, quantiles, prefix sums and statistics."""

import math
import random
import statistics
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewise.functions import columns as C
from casewise.operators import profile as P
from casewise.operators import quality as Q
from casewise.operators import quantiles as QT
from casewise.operators import stats as ST
from casewise.operators.prefix import running_totals
from casewise.operators.quantiles import group_quantiles


def test_duplicate_count(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,), (None,)], "v string")
    assert P.duplicate_count(df).first().duplicates == 3


def test_positive_rate_null_when_no_positive(spark):
    df = spark.createDataFrame([("g1", "F"), ("g1", "O"), ("g2", "O")], "g string, s string")
    out = {r.g: r.positive_rate for r in P.positive_rate_by(df, "g", "s", "F").collect()}
    assert out == {"g1": 50.0, "g2": None}


def test_exact_quantiles_slow_path_matches_fast(spark):
    rng = np.random.default_rng(0)
    vals = [(int(g), float(v)) for g, v in zip(rng.integers(0, 3, 3000), rng.lognormal(3, 2, 3000))]
    vals += [(0, 5.0)] * 500  # heavy ties
    df = spark.createDataFrame(vals, "g int, v double")
    probs, names = [0.25, 0.5, 0.75], ["a", "b", "c"]
    fast = {r.g: (r.a, r.b, r.c) for r in group_quantiles(df, ["g"], "v", probs, names).collect()}
    slow = {r.g: (r.a, r.b, r.c) for r in group_quantiles(df, ["g"], "v", probs, names, cap=0, sort_rows=20).collect()}
    for g in fast:
        assert slow[g] == pytest.approx(fast[g], rel=1e-12)
        arr = np.array([v for gg, v in vals if gg == g])
        assert fast[g] == pytest.approx(tuple(np.quantile(arr, probs)), rel=1e-12)


def test_quantiles_resolve_every_rank(spark):
    rng = np.random.default_rng(3)
    xs = np.concatenate([10.0 ** rng.uniform(-300, 300, 2000), [0.0] * 500, -(10.0 ** rng.uniform(-300, 300, 500))])
    df = spark.createDataFrame([(float(x),) for x in xs], "v double")
    probs = [0.0, 0.1, 0.4, 0.5, 0.77, 1.0]
    names = [f"p{i}" for i in range(len(probs))]
    got = group_quantiles(df, [], "v", probs, names, cap=0, sort_rows=5).first()
    for p, n in zip(probs, names):
        pos = p * (len(xs) - 1)
        lo, hi = int(np.floor(pos)), int(np.ceil(pos))
        s = np.sort(xs)
        want = s[lo] if lo == hi else (hi - pos) * s[lo] + (pos - lo) * s[hi]
        assert got[n] == pytest.approx(want, rel=1e-12)


def test_kde_follows_the_bandwidth(spark):
    rng = np.random.default_rng(0)
    xs = np.append(rng.normal(size=20000), 5000.0)
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    out = sorted((r.x, r.density) for r in ST.kde(df, "x", grid=2001).collect())
    bw = xs.std(ddof=1) * len(xs) ** -0.2
    near = [(x, d) for x, d in out if -20 < x < 20]
    exact = [np.exp(-0.5 * ((x - xs) / bw) ** 2).sum() / (len(xs) * bw * np.sqrt(2 * np.pi)) for x, _ in near]
    assert np.abs(np.array(exact) - [d for _, d in near]).max() < 1e-10 * max(exact)


def test_label_check_reads_all_classes(spark):
    rows = [(f"c{i:02d}", i) for i in range(24)] + [("zz", 99)]
    df = spark.createDataFrame(rows, "label string, v int")
    r = Q.validation_report(df, df, "LABEL", "zz", "c00").first()
    assert r.has_positive and r.has_negative and len(r.target_sample.split(",")) == 20
    assert P.label_domain(df, "label").count() == 25


def test_row_by_index_with_text_keys(spark):
    df = spark.createDataFrame([(f"EZ{i:03d}", i) for i in range(57)], "k string, v int").repartition(5)
    assert C.row_by_index(df, 13, "k").first().v == 13
    with pytest.raises(IndexError):
        C.row_by_index(df, 57, "k")


def test_running_totals_matches_cumsum(spark):
    rng = np.random.default_rng(1)
    xs = rng.normal(size=2000)
    df = spark.createDataFrame([(float(x), 1) for x in xs], "x double, one int")
    out = running_totals(df, "x", ["one"], 8, inclusive=False, suffix="_below").collect()
    for r in out:
        assert r.one_below == int((xs < r.x).sum())
    desc = running_totals(df, "x", ["one"], 8, descending=True).collect()
    for r in desc[:200]:
        assert r.one_cum == int((xs >= r.x).sum())


def test_describe_matches_numpy(spark):
    xs = [1.0, 2.0, 4.0, 8.0, 16.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    r = P.describe(df, ["x"]).first()
    assert r["std"] == pytest.approx(np.std(xs, ddof=1))
    assert (r.p25, r.p50, r.p75) == pytest.approx(tuple(np.quantile(xs, [0.25, 0.5, 0.75])))


def test_skewness_matches_pandas(spark):
    import pandas as pd
    xs = [1.0, 2.0, 3.0, 10.0, 7.5]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert ST.skewness(df, ["x"]).first().skew == pytest.approx(pd.Series(xs).skew())


def test_chi2_sf_known_values():
    got = ST._upper_gamma_q(np.array([0.5, 1.0, 2.5]), np.array([3.841458820694124 / 2, 5.991464547107979 / 2,
                                                                  11.070497693516351 / 2]))
    assert got == pytest.approx([0.05, 0.05, 0.05], abs=1e-9)


def test_chi2_yates_2x2(spark):
    # 2 x 2 table [[10, 20], [30, 40]]: Yates-corrected statistic 0.4464285714...
    rows = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 30 + [("b", "y")] * 40
    df = spark.createDataFrame(rows, "f string, lab string")
    r = ST.chi2_statistic(df, ["f"], "lab").first()
    assert r.dof == 1
    o = np.array([[10, 20], [30, 40]], dtype=float)
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    corr = o + np.sign(e - o) * np.minimum(0.5, np.abs(e - o))
    assert r.statistic == pytest.approx(((corr - e) ** 2 / e).sum())


def test_chi2_larger_table_uses_identity(spark):
    rng = np.random.default_rng(3)
    f = rng.integers(0, 4, 500)
    lab = rng.integers(0, 3, 500)
    df = spark.createDataFrame([(str(a), str(b)) for a, b in zip(f, lab)], "f string, lab string")
    r = ST.chi2_statistic(df, ["f"], "lab").first()
    o = np.zeros((4, 3))
    for a, b in zip(f, lab):
        o[a, b] += 1
    e = o.sum(1, keepdims=True) * o.sum(0, keepdims=True) / o.sum()
    assert r.dof == 6 and r.statistic == pytest.approx(((o - e) ** 2 / e).sum())


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "x double")
    out = {r.bin: r["count"] for r in ST.histogram(df, ["x"], 2).collect()}
    assert out == {0: 1, 1: 2}


def test_box_stats(spark):
    xs = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("g", x) for x in xs], "g string, x double")
    r = ST.box_stats(df, "g", "x").first()
    assert (r.q1, r.median, r.q3) == (2.0, 3.0, 4.0)
    assert r.whisker_high == 4.0 and r.outliers == 1


def test_missing_percent_split_equals_two_frames(spark):
    df = spark.createDataFrame([(1, None, "train"), (None, "a", "train"), (3, "b", "test"), (None, None, "test"),
                                (5, "c", "train")], "x int, y string, split string")
    a = {r.column: (r.missing_train_percent, r.missing_test_percent)
         for r in P.missing_percent_split(df).collect()}
    tr = df.where("split = 'train'").drop("split")
    te = df.where("split = 'test'").drop("split")
    b = {r.column: (r.missing_train_percent, r.missing_test_percent) for r in P.missing_percent(tr, te).collect()}
    assert a == b == {"x": (33.33, 50.0), "y": (33.33, 50.0)}


def test_positions_within_match_rank(spark):
    from casewise.operators.prefix import positions_within
    rows = [(g, f"v{(i * 7919) % 1000:04d}") for g in ("a", "b") for i in range(300 if g == "a" else 40)]
    df = spark.createDataFrame(rows, "g string, v string").distinct()
    got = {(r.g, r.v): r.position for r in positions_within(df, "g", "v", 7).collect()}
    for g in ("a", "b"):
        vals = sorted(v for gg, v in got if gg == g)
        assert [got[(g, v)] for v in vals] == list(range(1, len(vals) + 1))


def test_auto_bins_match_numpy(spark):
    rng = np.random.default_rng(5)
    for xs in (rng.lognormal(2, 1, 3000), rng.normal(size=500), np.r_[np.zeros(100), np.arange(10.0)]):
        df = spark.createDataFrame([(float(x),) for x in xs], "x double")
        k = ST.auto_bins(df, ["x"]).first().k
        assert k == len(np.histogram_bin_edges(xs, "auto")) - 1


def test_quantiles_ignore_nan_on_both_paths(spark):
    rows = [("g", float(v)) for v in range(1, 11)] + [("g", float("nan"))] * 3
    df = spark.createDataFrame(rows, "g string, v double")
    fast = group_quantiles(df, ["g"], "v", [0.5], ["m"]).first().m
    slow = group_quantiles(df, ["g"], "v", [0.5], ["m"], cap=0, sort_rows=3).first().m
    assert fast == slow == 5.5


def test_power_transform_reduces_skew(spark):
    from casewise.operators.encode import YeoJohnson
    rng = np.random.default_rng(11)
    df = spark.createDataFrame([(float(x),) for x in rng.lognormal(0, 1, 2000)], "x double")
    before = ST.skewness(df, ["x"]).first().skew
    tr = YeoJohnson(inputCols=["x"], outputCols=["y"]).fit(df).transform(df)
    after = ST.skewness(tr.select("y"), ["y"]).first().skew
    assert before > 2 and abs(after) < 0.2


def test_kde_integrates_to_one_and_common_norm(spark):
    rng = np.random.default_rng(2)
    rows = [("a", float(x)) for x in rng.normal(0, 1, 600)] + [("b", float(x)) for x in rng.normal(3, 0.5, 200)]
    df = spark.createDataFrame(rows, "g string, x double")
    own = ST.kde(df, "x", by="g").toPandas()
    joint = ST.kde(df, "x", by="g", common_norm=True).toPandas()
    for g, share in (("a", 0.75), ("b", 0.25)):
        a = own[own.g == g].sort_values("point")
        b = joint[joint.g == g].sort_values("point")
        assert np.trapezoid(a.density, a.x) == pytest.approx(1.0, abs=0.01)
        assert np.trapezoid(b.density, b.x) == pytest.approx(share, abs=0.01)


def test_kde_equals_the_sum_over_rows(spark):
    rnd = random.Random(4)
    rows = [("a", rnd.gauss(0, 1)) for _ in range(700)] + [("a", 400.0), ("a", None), (None, 1.0)]  # an outlier far off
    rows += [("b", rnd.expovariate(1)) for _ in range(50)] + [("b", 0.25)] * 300 + [("c", 5.0), ("c", 5.0)]  # c has no spread
    got = defaultdict(list)
    for r in ST.kde(spark.createDataFrame(rows, "g string, x double"), "x", by="g").orderBy("g", "point").collect():
        got[r.g].append((r.point, r.x, r.density))
    assert sorted(got) == ["a", "b"]
    for g, points in got.items():
        xs = [x for k, x in rows if k == g and x is not None]
        bw = statistics.stdev(xs) * len(xs) ** -0.2
        at = [min(xs) - 3 * bw + i * (max(xs) - min(xs) + 6 * bw) / 199 for i in range(200)]
        want = [sum(math.exp(-0.5 * ((t - x) / bw) ** 2) for x in xs) / (len(xs) * bw * math.sqrt(2 * math.pi)) for t in at]
        assert [p for p, _, _ in points] == list(range(200))
        assert all(abs(x - t) < 1e-9 and abs(d - w) < 1e-10 / bw for (_, x, d), t, w in zip(points, at, want, strict=True))
    one = ST.kde(spark.createDataFrame([(x,) for k, x in rows if k == "a"], "x double"), "x").orderBy("point").collect()
    assert all(abs(r.density - d) < 1e-12 for r, (_, _, d) in zip(one, got["a"], strict=True))
    assert ST.kde(spark.createDataFrame([], "x double"), "x").count() == 0


def test_column_quantile_is_the_group_quantile_of_each_column(spark):
    rnd = random.Random(3)
    inf, nan = math.inf, math.nan
    rows = [(rnd.gauss(0, 1) if i % 7 else None, float(i % 2), rnd.choice([0.0, 0.0, 0.0, 5.0]), rnd.choice([-inf, inf, nan, 1.5, None]),
             None, int(rnd.expovariate(1) * 1e6), 3.0, float(i)) for i in range(3000)]
    names = list("abcdefgh")
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f long, g double, h double").repartition(5)
    for part in (df, df.where("h < 2999"), df.where("h < 1"), df.limit(0)):
        one = part.select(*[F.col(c).cast("double").alias(c) for c in names]).unpivot([], names, "column", "value")
        for p in (0.5, 0.0, 0.9):
            want = {r["column"]: r["q"] for r in group_quantiles(one, ["column"], "value", [p], ["q"]).collect()}
            for sort_rows in (0, 4, 10_000):
                got = QT.column_quantile(part, names, p, sort_rows)
                assert list(got) == names and all(got[c] == want.get(c) for c in names), (p, sort_rows, got, want)


def test_medians_of_large_tables_store_no_rows(spark, monkeypatch):
    from casewise.operators import encode as EN
    df = spark.range(4000).selectExpr("cast(id as double) as x", "cast(id * 7 % 1000 as double) as y", "id % 3 as g").localCheckpoint()
    plain, stored, held = QT.cut_lineage, [], len(spark.sparkContext._jsc.getPersistentRDDs())

    def noted(part, *more):
        out = plain(part, *more)
        stored.append(out.count())
        return out
    monkeypatch.setattr(QT, "cut_lineage", noted)
    monkeypatch.setattr(QT, "DEFAULT_CAP", 100)
    assert EN.MedianImputer(inputCols=["x", "y"]).fit(df).getOrDefault("fills") == [1999.5, 499.5]
    assert {r.g: r.m for r in group_quantiles(df, ["g"], "x", [0.5], ["m"], sort_rows=50).collect()} == {0: 1999.5, 1: 1999.0, 2: 2000.0}
    assert max(stored, default=0) < 100
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == held
