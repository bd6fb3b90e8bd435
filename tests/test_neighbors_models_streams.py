"""KNN / resampling invariants, encoders, save-load, streams and plan shape."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from casewise.operators import encode as EN
from casewise.operators import inverted as IV
from casewise.operators import neighbors as NB
from casewise.operators import resample as RS

from sf_paths import SF_SMALL


def _points(spark, n=300, d=5, seed=0):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, d))
    y = (X[:, 0] > 0.8).astype(int)
    df = spark.createDataFrame([(i, X[i].tolist(), int(y[i])) for i in range(n)], "id long, vec array<double>, label int")
    return df, X, y


def _brute(X, k, exclude_self=True):
    d = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    if exclude_self:
        np.fill_diagonal(d, np.inf)
    out = {}
    for i in range(len(X)):
        order = np.lexsort((np.arange(len(X)), d[i]))[:k]
        out[i] = list(order)
    return out


def test_knn_multi_block_equals_brute_force(spark):
    df, X, _ = _points(spark)
    got = NB.knn_join(df, df, 4, exclude_self=True, block_rows=70).collect()
    by = {}
    for r in got:
        by.setdefault(r.qid, []).append((r.rank, r.rid))
    ref = _brute(X, 4)
    for q, lst in by.items():
        assert [rid for _, rid in sorted(lst)] == ref[q]
    assert len(by) == len(X)


def test_knn_vote_exact_hit(spark):
    nb = spark.createDataFrame([(1, 10, 0.0, 1), (1, 11, 1.0, 2), (1, 12, 2.0, 3)],
                               "qid long, rid long, dist double, rank int")
    labels = spark.createDataFrame([(10, 0), (11, 1), (12, 1)], "id long, label int")
    r = NB.knn_vote(nb, labels).first()
    assert r.pred == 0 and r.prob == 1.0


def test_smote_sizes_and_segments(spark):
    df, X, y = _points(spark)
    syn = RS.smote(df, "id", "vec", "label", 1, k=3, seed=1).collect()
    n1, n0 = int(y.sum()), int((1 - y).sum())
    assert len(syn) == n0 - n1
    mins = X[y == 1].min(0) - 1e-9
    maxs = X[y == 1].max(0) + 1e-9
    for r in syn:
        v = np.array(r.vec)
        assert (v >= mins).all() and (v <= maxs).all()


def test_enn_idempotent_on_separable(spark):
    rows = [(i, [float(i % 2) * 100 + (i // 2) * 0.01, 0.0], i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, vec array<double>, label int")
    once = RS.enn_clean(df, "id", "vec", "label", 3)
    twice = RS.enn_clean(once, "id", "vec", "label", 3)
    assert once.count() == 40 and twice.count() == 40


def test_one_hot_unseen_is_all_zero(spark):
    train = spark.createDataFrame([("Asia",), ("Africa",)], "c string")
    model = Pipeline(stages=EN.one_hot_stages(["c"])).fit(train)
    test = spark.createDataFrame([("Mars",), ("Asia",), (None,)], "c string")
    arrs = [list(r[0]) for r in model.transform(test).select(vector_to_array("c_oh")).collect()]
    assert arrs == [[0.0, 0.0], [0.0, 1.0], [0.0, 0.0]]


def test_population_scaler_and_yeo_johnson(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 50]], "x double")
    sc = EN.PopulationScaler(inputCols=["x"], outputCols=["s"]).fit(df).transform(df)
    vals = np.array([r.s for r in sc.collect()])
    assert vals.mean() == pytest.approx(0, abs=1e-12) and vals.std() == pytest.approx(1)
    yj = EN.YeoJohnson(inputCols=["x"], outputCols=["t"]).fit(df)
    lam = yj.getOrDefault(yj.lambdas)[0]
    assert -2 <= lam <= 2
    t = np.array([r.t for r in yj.transform(df).collect()])
    assert t.std() == pytest.approx(1)


def test_stage_persistence(spark, tmp_path):
    df = spark.createDataFrame([(1.0, None), (None, "b"), (3.0, "b")], "x double, c string")
    pipe = Pipeline(stages=[EN.MedianImputer(inputCols=["x"]), EN.ModeImputer(inputCols=["c"])]).fit(df)
    p = str(tmp_path / "pipe")
    pipe.write().overwrite().save(p)
    from pyspark.ml import PipelineModel
    back = PipelineModel.load(p).transform(df).collect()
    assert [r.x for r in back] == [1.0, 2.0, 3.0] and [r.c for r in back] == ["b", "b", "b"]


def test_stream_rate_equals_batch(spark, tmp_path):
    from casewise.plans.catalog import QUERIES, load_all
    load_all()
    a = QUERIES["stream_positive_rate"](spark, SF_SMALL).orderBy("window_start").collect()
    b = QUERIES["batch_positive_rate"](spark, SF_SMALL).orderBy("window_start").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]


def test_stream_rate_loses_nothing_across_triggers(spark, tmp_path):
    """Files far out of time order, one per trigger: every event counts, late ones are told."""
    from casewise.streaming import rate_stream as RT
    rows = [(i, f"2024-01-{1 + (i * 7) % 28:02d} {(i * 5) % 24:02d}:{i % 60:02d}:00", float(i % 100)) for i in range(400)]
    ev = spark.createDataFrame(rows, "event_id long, t string, value double").select(
        "event_id", F.col("t").cast("timestamp_ntz").alias("ts"), "value")
    for k in range(5):
        ev.where(F.col("event_id") % 5 == k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    out = RT.run_rate_stream(spark, f"{tmp_path}/in", ev.schema, f"{tmp_path}/out", f"{tmp_path}/ckpt", files_per_trigger=1)
    want = sorted(tuple(r) for r in RT.batch_positive_rate(ev).select("window_start", "events", "positives").collect())
    assert sorted(tuple(r) for r in out.select("window_start", "events", "positives").collect()) == want
    assert out.agg(F.sum("events"), F.sum("late_events")).first()[0] == 400 and out.agg(F.sum("late_events")).first()[0] > 0


def test_stream_rate_state_holds_open_windows_only(spark, tmp_path):
    """Events in time order over several triggers: nothing is late, closed windows have left the state."""
    from casewise.streaming import rate_stream as RT
    rows = [(i, f"2024-01-{1 + i // 96:02d} {(i // 4) % 24:02d}:{15 * (i % 4):02d}:00", float(i % 100)) for i in range(960)]
    ev = spark.createDataFrame(rows, "event_id long, t string, value double").select(
        "event_id", F.col("t").cast("timestamp_ntz").alias("ts"), "value")
    ev.repartitionByRange(6, "ts").write.parquet(f"{tmp_path}/in")
    out = RT.run_rate_stream(spark, f"{tmp_path}/in", ev.schema, f"{tmp_path}/out", f"{tmp_path}/ckpt", files_per_trigger=1)
    want = sorted(tuple(r) for r in RT.batch_positive_rate(ev).select("window_start", "events", "positives").collect())
    assert sorted(tuple(r) for r in out.select("window_start", "events", "positives").collect()) == want and len(want) == 240
    state = spark.read.format("statestore").load(f"{tmp_path}/ckpt").count()
    assert 1 <= state <= 2


class _Halves:
    """Stands for a bundle: scores by the wage."""

    def score(self, df, norm=None, clamp_age=False):
        return df.select("case_id", F.lit("Certified").alias("label_text"), F.lit(1).alias("pred"),
                         (F.col("prevailing_wage") / 100.0).alias("score"), F.lit(0.5).alias("threshold"))


def test_stream_score_one_row_a_payload_across_triggers(spark, tmp_path):
    from casewise.streaming import score_stream as SC
    line = '{"case_id": "%s", "no_of_employees": "5", "prevailing_wage": "%s", "yr_of_estab": "2000"}'
    first = [line % ("5", 10), line % (" 5", 20), line % ("6", 30), "not json"]
    second = [line % ("6", 30), line % ("7", 40), line % ("6", 31), "not json", line % ("7", 40)]
    (tmp_path / "in").mkdir()
    for k, lines in enumerate((first, second)):
        (tmp_path / "in" / f"{k}.txt").write_text("\n".join(lines) + "\n")
    out = SC.run_score_stream(spark, _Halves(), f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ckpt", 2025, files_per_trigger=1)
    got = sorted(((r.case_id or "").strip(), r.ok, r.score_pos_class or 0.0) for r in out.collect())
    assert got == [("", False, 0.0), ("5", True, 0.1), ("5", True, 0.2), ("6", True, 0.3), ("6", True, 0.31), ("7", True, 0.4)]
    # sent again in a later run of the same stream: still once
    (tmp_path / "in" / "3.txt").write_text(line % ("7", 40) + "\n" + line % ("8", 50) + "\n")
    out = SC.run_score_stream(spark, _Halves(), f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/ckpt", 2025, files_per_trigger=1)
    assert out.count() == 7 and out.filter("case_id = '7'").count() == 1


def test_payload_parse_bad_json(spark):
    from casewise.streaming.score_stream import parse_payloads
    good = '{"case_id": "EZYV1", "continent": "Asia", "no_of_employees": "5", "prevailing_wage": "10", "yr_of_estab": "2000"}'
    no_id = '{"no_of_employees": 5, "prevailing_wage": 10.5, "yr_of_estab": 2000}'
    lines = spark.createDataFrame([(good,), ('{"case_id": 2, "con',), (no_id,), ("",), ("[1]",), (None,)], "value string")
    out = {r.value: r for r in parse_payloads(lines, 2025).collect()}
    assert out[good].ok and out[good].payload_key == "EZYV1"
    assert out[no_id].ok and out[no_id].case_id is None and out[no_id].payload_key.startswith("payload-")
    for bad in ('{"case_id": 2, "con', "", "[1]", None):
        assert not out[bad].ok and out[bad].error == "invalid JSON payload"


def test_knn_prunes_on_clustered_data(spark):
    rng = np.random.default_rng(5)
    X = np.concatenate([rng.normal(size=(60, 3)) + c for c in rng.uniform(-1000, 1000, (40, 3))])
    df = spark.createDataFrame([(f"p{i:05d}", [float(v) for v in x]) for i, x in enumerate(X)], "id string, vec array<double>")
    visits, cells, sizes = NB.knn_plan(df, df, 4, exclude_self=True, block_rows=128)
    pairs = sizes.agg(F.sum(F.col("queries") * F.col("refs"))).first()[0]
    assert pairs < 0.2 * len(X) ** 2
    by = {}
    for r in NB.knn_join(df, df, 4, exclude_self=True, block_rows=128).collect():
        by.setdefault(int(r.qid[1:]), []).append((r.rank, int(r.rid[1:])))
    ref = _brute(X, 4)
    assert {q: [i for _, i in sorted(v)] for q, v in by.items()} == {i: ref[i] for i in range(len(X))}


def test_smote_ids_are_new_and_too_small_a_class_raises(spark):
    rows = [(f"c{i}", [float(i), 0.0], 1 if i < 3 else 0) for i in range(40)]
    df = spark.createDataFrame(rows, "id string, vec array<double>, label int")
    out = RS.smoteenn(df, "id", "vec", "label", 1, k_smote=2)
    assert out.select("id").distinct().count() == out.count()
    syn = RS.smote(df, "id", "vec", "label", 1, k=2)
    ids = [r.id for r in syn.collect()]
    assert len(set(ids)) == 34 and not set(ids) & {r[0] for r in rows}
    with pytest.raises(ValueError):
        RS.smote(df.where("id = 'c0' or label = 0"), "id", "vec", "label", 1)


def test_workflow_train_with_text_ids_duplicates_and_resampling(spark, tmp_path):
    from casewise import workflow as PL
    from casewise.config import parse_config
    from casewise.sources.views import cases_view
    csv = str(tmp_path / "cases_csv")
    view = cases_view(spark, SF_SMALL).drop("score").withColumn("case_id", F.concat(F.lit("EZ"), F.col("case_id")))
    view.unionByName(view.where("case_id like '%7'")).coalesce(2).write.option("header", True).csv(csv)
    cfg = parse_config({"dataset": {"csv_path": csv},
                        "training": {"target_column": "CASE_STATUS", "positive_class": "F", "negative_class": "O"},
                        "artifacts": {"root_dir": str(tmp_path / "artifacts")}})
    out = PL.train(spark, cfg, models=["decision_tree", "knn"], params={"decision_tree": {"maxDepth": 3}}, resample=True)
    assert out["best_model_name"] in ("decision_tree", "knn")


def test_core_plans_stay_in_jvm(spark):
    from casewise.plans.catalog import QUERIES, load_all
    load_all()
    for name in ["wage_vs_group_median", "value_share", "threshold_sweep", "stratified_split", "describe"]:
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_bundle_roundtrip_scores_equal(spark):
    from casewise.plans.catalog import QUERIES, load_all
    load_all()
    out = QUERIES["model_bundle_roundtrip"](spark, SF_SMALL)
    assert out.where(~F.col("same_score")).count() == 0


def test_oracle_sample_at_small_scale(spark):
    """A few registered queries against their DuckDB oracle at sf0.001."""
    import duckdb
    import __spark_entry__ as E
    from casewise.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    qs, sqls = E.queries(), E.oracle_sql()
    for name in ["wage_vs_group_median", "stratified_split", "roc_auc", "knn_join", "chi2_statistic",
                 "missing_percent", "describe"]:
        a = qs[name](spark, SF_SMALL).toPandas()
        b = con.sql(sqls[name]).df()
        assert sorted(a.columns) == sorted(b.columns), name
        a = a[sorted(a.columns)].round(6).astype(str).sort_values(sorted(a.columns)).reset_index(drop=True)
        b = b[sorted(b.columns)].round(6).astype(str).sort_values(sorted(b.columns)).reset_index(drop=True)
        assert a.equals(b), name


def test_entry_smoke(spark):
    import __spark_entry__ as E
    assert E.entry(spark).count() > 0


def test_smote_chunked_draws(spark):
    rows = [(i, [float(i), 0.0], 1 if i < 3 else 0) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, vec array<double>, label int")
    syn = RS.smote(df, "id", "vec", "label", 1, k=2, seed=3, draws_per_chunk=7)
    assert syn.count() == 54 and syn.select("id").distinct().count() == 54
    xs = [r.vec[0] for r in syn.collect()]
    assert min(xs) >= 0.0 and max(xs) <= 2.0


def test_stream_rate_independent_of_session_zone(spark):
    from casewise.plans.catalog import QUERIES, load_all
    load_all()
    ref = QUERIES["batch_positive_rate"](spark, SF_SMALL).orderBy("window_start").collect()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        got = QUERIES["stream_positive_rate"](spark, SF_SMALL).orderBy("window_start").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [tuple(r) for r in got] == [tuple(r) for r in ref]


def test_config_loading(tmp_path):
    from casewise.config import ConfigError, load_config
    p = tmp_path / "c.yaml"
    p.write_text("dataset:\n  csv_path: x.csv\ntraining:\n  target_column: CASE_STATUS\n"
                 "  positive_class: CERTIFIED\n  negative_class: DENIED\n  test_size: 0.2\n"
                 "  random_state: 42\nartifacts:\n  root_dir: artifacts\n")
    cfg = load_config(str(p))
    assert cfg.training.positive_class == "CERTIFIED" and cfg.training.as_of_year == 2025
    with pytest.raises(FileNotFoundError):
        load_config(str(tmp_path / "missing.yaml"))
    bad = tmp_path / "bad.yaml"
    bad.write_text("- a\n- b\n")
    with pytest.raises(ConfigError):
        load_config(str(bad))
    bad.write_text("dataset:\n  csv_path: x.csv\n  colour: red\ntraining:\n  target_column: T\nartifacts: 3\nmore: 1\n")
    with pytest.raises(ConfigError) as e:
        load_config(str(bad))
    assert set(str(e.value).splitlines()) == {"dataset.colour: unknown key", "training.positive_class: missing",
                                              "training.negative_class: missing", "artifacts: expected keys and values, found int"}
    assert cfg.extra == {}


def test_no_single_task_exchange_in_core_plans(spark):
    """Global sorts/windows would show as SinglePartition exchanges of the data.
    (A global aggregate's final merge of one partial row per task is fine and
    is not among these queries.)"""
    from casewise.plans.catalog import QUERIES, load_all
    load_all()
    for name in ["wage_vs_group_median", "value_share", "status_share_by", "chi2_statistic", "histogram",
                 "box_stats", "recent_top10", "knn_join", "category_domain", "stratified_split"]:
        df = QUERIES[name](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SinglePartition" not in plan, name


def test_yeo_johnson_optimum_beyond_initial_window(spark):
    rng = np.random.default_rng(0)
    x = 10 - rng.exponential(1.0, 2000)
    x = x[x > 0]
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    m = EN.YeoJohnson(inputCols=["x"]).fit(df)
    lam = m.getOrDefault(m.lambdas)[0]

    def llf(l):
        p = ((x + 1) ** l - 1) / l
        return -len(x) / 2 * np.log(np.var(p)) + (l - 1) * np.sum(np.log1p(x))
    grid = np.linspace(5, 9, 4001)
    best = grid[int(np.argmax([llf(g) for g in grid]))]
    assert lam == pytest.approx(best, abs=2e-3)


def test_knn_many_blocks_on_embeddings(spark):
    """Regression: block ids of both cogroup sides must share a type."""
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    pdf = e.toPandas()
    X = np.array(pdf.vec.tolist(), dtype=np.float64)
    ids = pdf.id.to_numpy()
    got = NB.knn_join(e, e, 3, exclude_self=True, block_rows=37).collect()
    by = {}
    for r in got:
        by.setdefault(r.qid, []).append((r.rank, r.rid))
    assert len(by) == len(ids)
    for i, q in enumerate(ids):
        d = np.sqrt(((X - X[i]) ** 2).sum(1))
        d[i] = np.inf
        assert [rid for _, rid in sorted(by[q])] == list(ids[np.lexsort((ids, d))[:3]])


def test_quantiles_scale_path_on_cases(spark, monkeypatch):
    from casewise.operators import quantiles as QT
    from casewise.sources.views import cases_view
    df = cases_view(spark, SF_SMALL)
    fast = {r.continent: r.m for r in QT.group_quantiles(df, ["continent"], "prevailing_wage", [0.5], ["m"]).collect()}
    monkeypatch.setattr(QT, "DEFAULT_CAP", 50)
    slow = {r.continent: r.m for r in QT.group_quantiles(df, ["continent"], "prevailing_wage", [0.5], ["m"]).collect()}
    assert slow == pytest.approx(fast, rel=1e-12)


def test_split_disjoint_and_exhaustive(spark):
    from casewise.operators.sampling import stratified_split
    from casewise.sources.views import cases_view
    df = cases_view(spark, SF_SMALL)
    sp = stratified_split(df, "case_status", "case_id", 0.2, 42)
    ids = [r.case_id for r in sp.select("case_id").collect()]
    assert len(ids) == len(set(ids)) == df.count()
    assert {r.split for r in sp.select("split").distinct().collect()} == {"train", "test"}


def test_stream_scores_equal_batch_scores(spark):
    from casewise.plans.catalog import QUERIES, load_all
    load_all()
    batch = {r.case_id: (r.score, r.pred, r.label_text, r.threshold)
             for r in QUERIES["batch_score"](spark, SF_SMALL).collect()}
    stream = QUERIES["stream_score"](spark, SF_SMALL).collect()
    ok = [r for r in stream if r.ok]
    bad = [r for r in stream if not r.ok]
    assert ok and bad  # some payloads are cut short on purpose
    for r in ok:
        s, p, lab, thr = batch[r.case_id]
        assert (r.score_pos_class, r.pred, r.label, r.threshold) == (s, p, lab, thr)
        assert r.pred == int(r.score_pos_class >= r.threshold)
    n_cut = sum(1 for k in batch if k % 97 == 0)  # payloads cut short by the fixture builder
    assert sum(1 for r in bad if r.error == "invalid JSON payload") == n_cut
    assert all(r.error == "invalid JSON payload" or "Value must be" in r.error for r in bad)


def test_workflow_train_and_score_from_csv(spark, tmp_path):
    """Entry 1 and 2 end to end: CSV in, artifacts out, the saved bundle scores new rows."""
    from casewise import workflow as PL
    from casewise.config import parse_config
    from casewise.sources.views import cases_view
    csv = str(tmp_path / "cases_csv")
    cases_view(spark, SF_SMALL).drop("score").write.option("header", True).csv(csv)
    cfg = parse_config({"dataset": {"csv_path": csv},
                        "training": {"target_column": "CASE_STATUS", "positive_class": "F",
                                     "negative_class": "O", "test_size": 0.2, "random_state": 42},
                        "artifacts": {"root_dir": str(tmp_path / "artifacts")}})
    out = PL.train(spark, cfg, models=["logreg", "decision_tree"],
                   params={"logreg": {"maxIter": 20}, "decision_tree": {"maxDepth": 4}}, resample=False)
    assert out["best_model_name"] in ("logreg", "decision_tree")
    cm = out["confusion_matrix"]
    assert sum(map(sum, cm)) > 0
    scored = PL.score(spark, str(tmp_path / "artifacts" / "model"), csv, str(tmp_path / "scored"))
    assert scored.count() == cases_view(spark, SF_SMALL).count()
    assert scored.where((F.col("score") >= F.col("threshold")).cast("int") != F.col("pred")).count() == 0
    prof = {(r.kind, r.column) for r in PL.profile(spark, csv).collect()}
    assert ("range", "prevailing_wage") in prof and ("category", "continent") in prof
    diag = PL.diagnose_splits(spark, str(tmp_path / "artifacts"), "CASE_STATUS").collect()
    assert {r.split for r in diag} == {"train", "test"}
    assert sum(r["count"] for r in diag) == cases_view(spark, SF_SMALL).count()


def _recall(found, exact):
    got, want = ({(r.qid, r.rid) for r in rows} for rows in (found, exact))
    return len(got & want) / len(want)


def test_inverted_lists_on_noise_and_on_clusters(spark):
    """Recall against the exact join, exact distances, the smaller share of lists where there is structure."""
    rng = np.random.default_rng(5)
    noise = rng.normal(size=(900, 12))
    heart = np.concatenate([np.repeat(rng.normal(0, 20, (1, 12)), 300, 0), np.repeat(rng.normal(0, 20, (20, 12)), 30, 0)])
    clusters = heart + rng.normal(size=heart.shape)  # one cluster holds a third of the rows
    for x, structured in ((noise, False), (clusters, True)):
        df = spark.createDataFrame([(f"v{i:03d}", [float(c) for c in v]) for i, v in enumerate(x)], "id string, vec array<double>")
        model = IV.fit(df, 5, lists=24)
        assert model.centres.shape == (24, 12) and model.books.shape == (6, 64, 2)
        found = IV.search(df, df, model, 5, exclude_self=True, block_rows=100).collect()
        assert _recall(found, NB.knn_join(df, df, 5, exclude_self=True).collect()) >= 0.9
        assert sorted((r.qid, r["rank"]) for r in found) == sorted((f"v{i:03d}", k) for i in range(len(x)) for k in range(1, 6))
        at = {f"v{i:03d}": v for i, v in enumerate(x)}
        assert all(r.dist == pytest.approx(np.linalg.norm(at[r.qid] - at[r.rid]), rel=1e-9) for r in found)
        if structured:
            assert model.probes <= 12
    whole = IV.search(df, df, model, 5, exclude_self=True).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, found))


def test_inverted_lists_edges(spark):
    df = spark.createDataFrame([(i, [float(i // 4), 1.0, 2.0]) for i in range(8)] + [(99, None)], "id long, vec array<double>")
    model = IV.fit(df, 2)
    got = IV.search(df, df, model, 2, exclude_self=True).collect()
    assert {r.qid for r in got} == set(range(8))
    assert sorted((r.rid, r.dist) for r in got if r.qid == 0) == [(1, 0.0), (2, 0.0)]
    assert IV.fit(df.limit(0)) is None and IV.search(df, df.limit(0), None, 2).count() == 0
    assert IV.search(df.limit(0), df, model, 2).count() == 0
    one = df.where("id = 3")
    assert [tuple(r) for r in IV.search(one, one, IV.fit(one, 2), 2).collect()] == [(3, 3, 0.0, 1)]


def test_approximate_query_recall(spark):
    from casewise.plans import QUERIES, load_all
    load_all()
    assert _recall(QUERIES["knn_approximate"](spark, SF_SMALL).collect(), QUERIES["knn_join"](spark, SF_SMALL).collect()) >= 0.9


def test_reference_grids_sizes():
    from casewise.operators.select import REFERENCE_GRIDS
    assert {k: int(np.prod([len(v) for v in g.values()])) for k, g in REFERENCE_GRIDS.items()} == {"xgboost": 12, "random_forest": 60}


def test_knn_search_matches_brute_force(spark):
    from pyspark.ml.functions import array_to_vector
    from casewise.operators import select as SL
    df, X, y = _points(spark, n=120, d=3, seed=4)
    train = df.select(F.col("id").alias("case_id"), array_to_vector("vec").alias("features"), "label")
    prep = SL.Prepared(train, train, None)
    got = {(r.k, r.weights): r.cv_accuracy for r in SL.knn_search(prep, (3, 5), ("uniform", "distance"), 3, 7).collect()}
    folds = {r.case_id: r.f for r in train.select("case_id", F.pmod(F.xxhash64(F.lit(7), F.col("case_id")),
                                                                       F.lit(3)).alias("f")).collect()}
    fold = np.array([folds[i] for i in range(len(X))])
    for k in (3, 5):
        for w in ("uniform", "distance"):
            accs = []
            for f in range(3):
                q, r = np.where(fold == f)[0], np.where(fold != f)[0]
                ok = 0
                for i in q:
                    d = np.sqrt(((X[r] - X[i]) ** 2).sum(1))
                    nn = r[np.lexsort((r, d))[:k]]
                    dn = np.sqrt(((X[nn] - X[i]) ** 2).sum(1))
                    wt = np.ones(k) if w == "uniform" else (1.0 / dn)
                    score = {c: wt[y[nn] == c].sum() for c in (0, 1)}
                    pred = 0 if score[0] >= score[1] else 1
                    ok += int(pred == y[i])
                accs.append(ok / len(q))
            assert got[(k, w)] == pytest.approx(np.mean(accs))


def test_knn_ties_and_duplicates_resolve_by_id(spark):
    pts = [(i, [float(i % 5), float((i // 5) % 4)]) for i in range(60)]  # 20 grid points, each 3 times
    df = spark.createDataFrame(pts, "id long, vec array<double>")
    X = np.array([p[1] for p in pts])
    ids = np.arange(60)
    got = NB.knn_join(df, df, 6, exclude_self=True, block_rows=16).collect()
    by = {}
    for r in got:
        by.setdefault(r.qid, []).append((r.rank, r.rid))
    for i in range(60):
        d = np.sqrt(((X - X[i]) ** 2).sum(1))
        d[i] = np.inf
        assert [rid for _, rid in sorted(by[i])] == list(ids[np.lexsort((ids, d))[:6]])


def test_own_learners_are_ml_stages(spark):
    """Wage features, KNN and AdaBoost fit and transform inside a Spark ML pipeline."""
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import array_to_vector
    from casewise.operators.features import WageFeatures
    from casewise.operators.models import AdaBoost, KnnClassifier
    df, X, y = _points(spark, n=80, d=3, seed=2)
    df = df.select(F.col("id").alias("case_id"), array_to_vector("vec").alias("features"), "label")
    for stage in (KnnClassifier(k=3), AdaBoost(rounds=3)):
        out = Pipeline(stages=[stage]).fit(df).transform(df)
        assert out.count() == 80 and out.where("score < 0 or score > 1 or score is null").isEmpty()
    same = Pipeline(stages=[KnnClassifier(k=3)]).fit(df.repartition(7)).transform(df).select("case_id", "score")
    again = Pipeline(stages=[KnnClassifier(k=3)]).fit(df).transform(df.repartition(3)).select("case_id", "score")
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, again.collect()))
    wages = spark.createDataFrame([("A", "Year", 10.0, 5, "r")] * 3, "continent string, unit_of_wage string, prevailing_wage double, no_of_employees int, region_of_employment string")
    assert "wage_vs_region_median" in Pipeline(stages=[WageFeatures()]).fit(wages).transform(wages).columns


def test_stages_with_tables_are_saved_in_a_pipeline(spark, tmp_path):
    """A PipelineModel holding wage features, KNN or AdaBoost gives equal rows once saved and loaded; so do the estimators."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.functions import array_to_vector
    from casewise.operators.features import WageFeatures
    from casewise.operators.models import AdaBoost, KnnClassifier
    df, X, y = _points(spark, n=60, d=3, seed=4)
    df = df.select(F.col("id").alias("case_id"), array_to_vector("vec").alias("inputs"), F.col("label").alias("target"))
    wages = spark.createDataFrame([(i, "AB"[i % 2], "Year", 10.0 * i, 5, None) for i in range(1, 9)], "case_id int, continent string, "
                                  "unit_of_wage string, prevailing_wage double, no_of_employees int, region_of_employment string")
    cases = [(KnnClassifier("inputs", "target", k=3), df, ["score"]), (AdaBoost("inputs", "target", rounds=4, seed=1), df, ["score"]),
             (WageFeatures(), wages, ["wage_vs_continent_median", "wage_vs_region_median"]),
             (WageFeatures(), wages.drop("continent", "unit_of_wage", "prevailing_wage"), ["wage_per_employee", "wage_vs_continent_median"])]
    for i, (est, rows, cols) in enumerate(cases):
        Pipeline(stages=[est]).write().save(str(tmp_path / f"e{i}"))
        fitted = Pipeline.load(str(tmp_path / f"e{i}")).fit(rows)
        fitted.write().overwrite().save(str(tmp_path / f"m{i}"))
        back = PipelineModel.load(str(tmp_path / f"m{i}"))
        want, got = (sorted(map(tuple, m.transform(rows).select("case_id", *cols).collect())) for m in (Pipeline(stages=[est]).fit(rows), back))
        assert got == want and len(got) == rows.count()
        if hasattr(back.stages[0], "saved_at"):
            with pytest.raises(ValueError):
                back.stages[0].write().overwrite().save(back.stages[0].saved_at)


def test_own_learners_are_tuned(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    from casewise.operators.models import KnnClassifier
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=2).tolist(), int(i % 4 == 0)) for i in range(80)]  # no structure: one neighbour is worse than many
    df = spark.createDataFrame(rows, "case_id int, vec array<double>, label int")
    df = df.select("case_id", array_to_vector("vec").alias("features"), F.col("label").cast("double").alias("label"))
    knn = KnnClassifier()
    grid = ParamGridBuilder().addGrid(knn.k, [1, 15]).build()
    cv = CrossValidator(estimator=knn, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(rawPredictionCol="score"), numFolds=2, seed=1)
    best = cv.fit(df)
    assert len(best.avgMetrics) == 2 and best.avgMetrics[0] != best.avgMetrics[1]
    assert best.bestModel.getK() == [1, 15][int(np.argmax(best.avgMetrics))]


def test_bundle_keeps_knn_and_adaboost(spark, tmp_path):
    from casewise.operators import models as MD
    from casewise.operators import select as SL
    from casewise.operators.features import WageFeatures
    cases = [(i, ["Year", "Month"][i % 2], float(5 * i % 37 + 1), i % 11, 1990 + i % 9, int(i % 3 == 0)) for i in range(60)]
    df = spark.createDataFrame(cases, "case_id int, unit_of_wage string, prevailing_wage double, no_of_employees int, yr_of_estab int, label int")
    wage = WageFeatures().fit(df)
    pipe = EN.column_transformer([], ["no_of_employees"], ["prevailing_wage", "wage_per_employee"]).fit(wage.transform(df))
    pre = SL.Preprocessor(wage, pipe, 2025, "engineered")
    feats = pre.transform(df).select("case_id", "features", "label")
    for name, params in (("knn", {"k": 3}), ("adaboost", {"rounds": 3})):
        bundle = SL.Bundle(pre, MD.fit_model(name, feats, params=params), 0.5, "F", "O", "case_status")
        bundle.save(str(tmp_path / name))
        back = SL.Bundle.load(spark, str(tmp_path / name))
        a, b = (sorted(map(tuple, m.score(df).select("case_id", "score", "pred").collect())) for m in (bundle, back))
        assert a == b and len(a) == 60


def test_column_transformer_equals_sql(spark):
    """Width exactly, sums of the vectors within what the flat likelihood of the power transform allows."""
    import duckdb
    from casewise.plans.catalog import QUERIES, load_all
    from casewise.plans.q_features import column_transformer_sql
    load_all()
    con = duckdb.connect()
    for t in ("orders", "customer", "nation", "region"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    want = {i: (n, t) for i, n, t in con.sql(column_transformer_sql()).fetchall()}
    got = {r.case_id: (r.n_features, r.total) for r in QUERIES["column_transformer"](spark, SF_SMALL).collect()}
    assert got.keys() == want.keys() and all(got[i][0] == n and abs(got[i][1] - t) < 1e-3 for i, (n, t) in want.items())


def test_knn_sends_a_query_once_to_a_bundle_of_cells(spark):
    """on data without structure a query needs every cell; it is stored once, whatever their number."""
    X = np.random.default_rng(11).normal(size=(900, 24))
    df = spark.createDataFrame([(f"p{i:04d}", [float(v) for v in x]) for i, x in enumerate(X)], "id string, vec array<double>")
    visits, _, sizes = NB.knn_plan(df, df, 4, exclude_self=True, block_rows=32)
    assert sizes.count() > 40 and visits.count() == len(X)
    ref = _brute(X, 4)
    for task_bytes in (8 * 24 * 100, NB.TASK_BYTES):  # many bundles, and one
        by = {}
        for r in NB.knn_join(df, df, 4, exclude_self=True, block_rows=32, task_bytes=task_bytes).collect():
            by.setdefault(int(r.qid[1:]), []).append((r.rank, int(r.rid[1:])))
        assert {q: [i for _, i in sorted(v)] for q, v in by.items()} == {i: ref[i] for i in range(len(X))}


def test_approximate_search_gives_the_same_over_any_bundles(spark, monkeypatch):
    """lists are bundled; bundles and blocks change no result."""
    X = np.random.default_rng(12).normal(size=(1500, 12))
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "id long, vec array<double>")
    model = IV.fit(df, 5, lists=30)

    def found(**kw):
        return sorted(tuple(r) for r in IV.search(df, df, model, 5, exclude_self=True, **kw).collect())
    whole = found()
    assert _recall(IV.search(df, df, model, 5, exclude_self=True).collect(), NB.knn_join(df, df, 5, exclude_self=True).collect()) >= 0.9
    monkeypatch.setattr(IV, "CODE_ROWS", 400)
    monkeypatch.setattr(IV, "PAIRS", 100_000)
    assert found(block_rows=45) == whole


def test_knn_visits_few_cells_of_numbers_beside_indicators(spark):
    """two numbers beside scaled indicators of a category; most of all pairs are ruled out, the result is exact."""
    rng = np.random.default_rng(21)
    kind = rng.integers(0, 24, 1200)
    X = np.concatenate([rng.normal(size=(1200, 2)), 5.0 * (kind[:, None] == np.arange(24))], axis=1)
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "id long, vec array<double>")
    _, _, sizes = NB.knn_plan(df, df, 3, exclude_self=True, block_rows=64)
    assert sizes.agg(F.sum(F.col("queries") * F.col("refs"))).first()[0] < 0.1 * len(X) ** 2
    ref = _brute(X, 3)
    for task_bytes in (8 * 26 * 100, 8 * 26 * 10):  # bundles of several cells; and bundles of several blocks
        by = {}
        for r in NB.knn_join(df, df, 3, exclude_self=True, block_rows=64, task_bytes=task_bytes).collect():
            by.setdefault(r.qid, []).append((r.rank, r.rid))
        assert {q: [i for _, i in sorted(v)] for q, v in by.items()} == {i: ref[i] for i in range(len(X))}


def test_knn_skips_vectors_that_are_not_finite(spark):
    """a NaN among the references hides no other neighbour, and is none."""
    rows = [(i, [float(i), float(i % 3)]) for i in range(60)] + [(60, [float("nan"), 0.0]), (61, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "id long, vec array<double>")
    X = np.array([r[1] for r in rows[:60]])
    got = {}
    for r in NB.knn_join(df, df, 4, exclude_self=True, block_rows=16).collect():
        got.setdefault(r.qid, []).append((r.rank, r.rid))
    ref = _brute(X, 4)
    assert {q: [i for _, i in sorted(v)] for q, v in got.items()} == {i: ref[i] for i in range(60)}
