"""Splits, samples, top-k and metrics (golden numbers from the reference's reports)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from casewise.operators import metrics as M
from casewise.operators import ordering as O
from casewise.operators import quality as Q
from casewise.operators import sampling as SM


def test_stratified_split_sizes_and_partition_independence(spark):
    df = spark.createDataFrame([(i, "a" if i < 6 else "b") for i in range(10)], "id int, y string")
    a = SM.stratified_split(df, "y", "id", 0.5, 7)
    b = SM.stratified_split(df.repartition(5), "y", "id", 0.5, 7)
    ta = sorted(r.id for r in a.where("split = 'test'").collect())
    tb = sorted(r.id for r in b.where("split = 'test'").collect())
    assert ta == tb
    got = {r.y: r["count"] for r in a.where("split = 'test'").groupBy("y").count().collect()}
    assert got == {"a": 3, "b": 2}


def test_split_reference_sizes(spark):
    # 25,480 rows, 17,018 positive: 20,384 / 5,096 with 3,404 positives in test
    df = spark.range(25480).withColumn("y", (F.col("id") < 17018).cast("int"))
    counts = {str(r.y): r["count"] for r in df.groupBy("y").count().collect()}
    assert SM.allocate_split(counts, 0.2) == {"1": 3404, "0": 1692}


def test_auc_of_many_pairs_and_missing_scores(spark):
    from casewise.operators.metrics import _auc_of
    big = spark.createDataFrame([(0.1, 0, 4 * 10**9), (0.9, 4 * 10**9, 0)], "score double, pos long, neg long")
    assert _auc_of(big).first().roc_auc == 1.0
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None), (1, float("nan")), (0, None)], "y int, s double")
    assert M.roc_auc(df, "y", "s").first().roc_auc == 1.0
    r = M.metrics_at_threshold(df, "y", "s", 0.5).first()
    assert (r.tn, r.fp, r.fn, r.tp, r.roc_auc) == (1, 0, 0, 1, 1.0)
    without = M.metrics_at_threshold(df, "y", "s", 0.5, with_auc=False).first()
    assert (without.tn, without.fp, without.fn, without.tp) == (1, 0, 0, 1)


def test_mark_lowest_equals_global_rank(spark):
    df = spark.range(3000).withColumn("c", (F.col("id") % 3).cast("string"))
    quotas = spark.createDataFrame([("0", 10), ("1", 500), ("2", 0)], "__cls string, __quota long")
    got = SM.mark_lowest(df, F.col("c"), SM.seeded_hash("id", 5), "id", quotas, "sel", prefix=1)
    got = sorted(r.id for r in got.where("sel").collect())
    w = Window.partitionBy("c").orderBy(SM.seeded_hash("id", 5), "id")
    ref = df.withColumn("rn", F.row_number().over(w)).join(
        quotas.withColumnRenamed("__cls", "c"), "c").where(F.col("rn") <= F.col("__quota"))
    assert got == sorted(r.id for r in ref.collect())


def test_stratified_sample_sizes(spark):
    df = spark.range(1000).withColumn("label", (F.col("id") < 300).cast("int"))
    s = SM.stratified_sample(df, "label", "id", 101, 42)
    got = {r.label: r["count"] for r in s.groupBy("label").count().collect()}
    assert got == {1: 30, 0: 71}  # round(30.3) = 30


def test_top_k_per_group_salted(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("u"), F.col("id").alias("ev"),
                                 (F.col("id") * 37 % 500).alias("ts"))
    out = O.top_k_per_group(df, ["u"], [F.desc("ts")], 10, "ev", salts=7)
    w = Window.partitionBy("u").orderBy(F.desc("ts"), F.desc("ev"))
    ref = df.withColumn("rank", F.row_number().over(w)).where("rank <= 10")
    assert sorted(map(tuple, out.select("u", "ev", "rank").collect())) == \
        sorted(map(tuple, ref.select("u", "ev", "rank").collect()))


def test_golden_metrics_from_reference_matrix(spark):
    cells = spark.createDataFrame([(1228, 464, 1071, 2333)], "tn long, fp long, fn long, tp long")
    r = M.metrics_from_cells(cells).first()
    assert r.accuracy == pytest.approx(0.6987833594976453, abs=1e-15)
    assert r.precision == pytest.approx(0.8341079728280301, abs=1e-15)
    assert r.recall == pytest.approx(0.6853701527614571, abs=1e-15)
    assert r.f1 == pytest.approx(0.7524592807611676, abs=1e-15)
    assert r.balanced_accuracy == pytest.approx(0.7055692371372297, abs=1e-15)
    assert r.positive_rate == pytest.approx(0.548861852433281, abs=1e-15)


def test_zero_division_and_single_class(spark):
    df = spark.createDataFrame([(1, 0.1), (0, 0.2)], "label int, score double")
    r = M.metrics_at_threshold(df, "label", "score", 0.9).first()
    assert r.precision == 0.0 and r.f1 == 0.0
    one = spark.createDataFrame([(1, 0.1), (1, 0.7)], "label int, score double")
    assert M.roc_auc(one, "label", "score").first().roc_auc is None


def test_sweep_ties_pick_first(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5)], "label int, score double")
    best = M.best_threshold(M.threshold_sweep(df, "label", "score")).first()
    assert best.threshold == 0.05 and best.position == 0
    assert M.THRESHOLDS[10] == 0.5499999999999999


def test_auc_with_ties(spark):
    data = [(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1), (1, 0.1), (0, 0.3)]
    df = spark.createDataFrame(data, "label int, score double")
    pos = [s for l, s in data if l == 1]
    neg = [s for l, s in data if l == 0]
    u = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert M.roc_auc(df, "label", "score").first().roc_auc == pytest.approx(u / (len(pos) * len(neg)))


def test_column_diff_and_report(spark):
    a = spark.createDataFrame([(1, "F", 3)], "x int, case_status string, z int")
    b = spark.createDataFrame([(1, "F")], "x int, case_status string")
    diff = {(r.column, r.side) for r in Q.column_diff(a, b).collect()}
    assert diff == {("z", "train")}
    rep = Q.validation_report(a, b, "CASE_STATUS", "F", "O").first()
    assert rep.status is False and "column_mismatch" in rep.issues
    with pytest.raises(ValueError):
        Q.validation_report(a.drop("case_status"), b, "CASE_STATUS", "F", "O")
