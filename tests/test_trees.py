"""Tree learners: against plain NumPy, and both ways (in tasks, by passes) against each other."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewise.operators import boosting as BO
from casewise.operators import forests as FO
from casewise.operators.binned import MISSING, Bins


def table(spark, n=400, seed=0, missing=0.1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 2, n), rng.normal(size=n).round(1), rng.integers(0, 5, n), np.ones(n)])
    y = ((x[:, 0] + x[:, 1] * x[:, 2] > 0.3) ^ (rng.random(n) < 0.1)).astype(int)
    x[rng.random(x.shape) < missing] = np.nan
    rows = [(i, [float(v) for v in x[i]], int(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "case_id long, features array<double>, label int"), x, y


def plain_boost(x, y, rounds, rate, depth, min_rows, penalty=0.0):
    """Second-order boosting by direct search: every cut of every feature, missing values to either side."""
    def best(rows, g, h):
        top = None
        for f in range(x.shape[1]):
            v = x[rows, f]
            for left_missing in (False, True):
                for cut in np.unique(v[~np.isnan(v)]):
                    left = (v <= cut) | (np.isnan(v) & left_missing)
                    if min(left.sum(), (~left).sum()) < min_rows:
                        continue
                    a, b = rows[left], rows[~left]
                    if min(h[a].sum(), h[b].sum()) < 1e-3:
                        continue
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + penalty) for s in (a, b)) - g[rows].sum() ** 2 / (h[rows].sum() + penalty)
                    if gain > 1e-9 and (top is None or gain > top[0] + 1e-9):
                        top = (gain, a, b)
        return top

    score = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        def go(rows, level):
            s = best(rows, g, h) if level < depth else None
            if s is None:
                score[rows] -= rate * g[rows].sum() / (h[rows].sum() + penalty)
            else:
                go(s[1], level + 1), go(s[2], level + 1)
        go(np.arange(len(y)), 0)
    return 1 / (1 + np.exp(-score))


def scores(model, df):
    return np.array([r.score for r in model.transform(df).orderBy("case_id").select("score").collect()])


def test_boosting_equals_plain_numpy(spark):
    df, x, y = table(spark, 220)  # fewer values than bins
    o = BO.Options(rounds=15, rate=0.3, max_depth=3, max_leaves=None, min_rows=5, stopping=False)
    # cuts at the middle of two values separate the same rows as cuts at the lower one
    assert np.abs(scores(BO.fit(df, o), df) - plain_boost(x, y, 15, 0.3, 3, 5)).max() < 1e-5


def test_boosting_in_a_task_equals_passes(spark):
    df, *_ = table(spark, 600, 1)
    for o in (BO.Options(rounds=4, max_depth=4, rate=0.2), BO.Options(rounds=12, max_leaves=6, stopping=True, patience=2, held_out=0.3, rate=0.9),
              BO.Options(rounds=3, second_order=False, min_rows=1, max_depth=3)):
        one, two = BO.fit(df.repartition(5), o), BO.fit(df.repartition(3), o, held=False)
        assert one.start == two.start and len(one.trees) == len(two.trees)
        for a, b in zip(one.trees, two.trees, strict=True):
            assert a == b


def test_best_leaves_first(spark):
    df, *_ = table(spark, 800, 2)
    whole = BO.fit(df, BO.Options(rounds=1, max_leaves=None, max_depth=6, stopping=False, min_rows=5)).trees[0]
    few = BO.fit(df, BO.Options(rounds=1, max_leaves=5, max_depth=6, stopping=False, min_rows=5)).trees[0]
    reached, todo = [], [0]
    while todo:
        n = todo.pop()
        reached.append(n)
        if few.feature[n] >= 0:
            todo += [few.left[n], few.left[n] + 1]
    assert sum(few.feature[n] < 0 for n in reached) == 5
    assert sum(f >= 0 for f in whole.feature) > 4


def test_early_stopping_and_600_rounds(spark):
    df, x, y = table(spark, 300, 3)
    noise = df.withColumn("label", F.pmod(F.xxhash64("case_id"), F.lit(2)).cast("int"))
    assert len(BO.fit(noise, BO.Options(rounds=600, stopping=True, held_out=0.2)).trees) < 100
    full = BO.fit(df, BO.Options(rounds=600, rate=0.06, max_depth=4))
    assert len(full.trees) == 600 and ((scores(full, df) > 0.5) == y).mean() > 0.97


def test_boosted_model_is_saved_and_loaded(spark, tmp_path):
    df, *_ = table(spark)
    m = BO.fit(df, BO.Options(rounds=5))
    m.save(str(tmp_path / "m"))
    assert (scores(BO.BoostedModel.load(spark, str(tmp_path / "m")), df) == scores(m, df)).all()


def test_bins_keep_missing_values_apart(spark):
    df, x, _ = table(spark, 500, 4)
    codes = Bins.fit(df, "features").codes(x)
    assert (codes[np.isnan(x)] == MISSING).all() and (codes[~np.isnan(x)] < 255).all()
    many = spark.createDataFrame([(i, [float(i)], 0) for i in range(5000)], "case_id long, features array<double>, label int")
    c = Bins.fit(many, "features").codes(np.arange(5000.0)[:, None])
    assert len(np.unique(c)) == 255 and np.bincount(c[:, 0]).max() <= 21


def plain_tree(x, y, w, key, o, depth=0):
    """One fully grown tree by direct recursion; returns the share of class 1 at each row's leaf."""
    out = np.zeros(len(y))

    def go(rows, key, depth):
        n, p = w[rows].sum(), (w[rows] * y[rows]).sum()
        top = None
        if 0 < p < n and (o.max_depth is None or depth < o.max_depth):
            for j, f in enumerate(FO.order_of_features(np.array([key], np.uint64), x.shape[1])[0]):
                if j >= o.count(x.shape[1]) and top is not None:
                    break
                v = x[rows, f]
                if o.random_cuts:
                    lo, hi = v[w[rows] > 0].min(), v[w[rows] > 0].max()
                    cuts = [] if lo == hi else FO.cut_between(np.array([key], np.uint64), np.array([f]), np.array([lo]), np.array([hi]))
                else:
                    cuts = np.unique(v[w[rows] > 0])[:-1]
                for c in cuts:
                    a, b = rows[v <= c], rows[v > c]
                    gain = sum(((w[s] * y[s]).sum() ** 2 + (w[s] * (1 - y[s])).sum() ** 2) / w[s].sum() for s in (a, b))
                    if top is None or gain > top[0]:
                        top = (gain, a, b)
        if top is None:
            out[rows] = p / n
            return
        kids = FO.child_keys(np.array([key], np.uint64))
        go(top[1], kids[0], depth + 1), go(top[2], kids[1], depth + 1)
    go(np.arange(len(y)), key, depth)
    return out


@pytest.mark.parametrize("o", [FO.Options(trees=4), FO.Options(trees=4, random_cuts=True, bootstrap=False), FO.Options(trees=2, looks="all", max_depth=4)])
def test_grown_tree_equals_direct_recursion(o):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(0, 200, 300), rng.integers(0, 2, 300), rng.integers(0, 7, 300), np.zeros(300), rng.integers(0, 2, 300)])
    x = x.astype(np.float32 if o.random_cuts else np.uint8)
    y, uid = rng.integers(0, 2, 300), np.arange(300)
    for tree in range(o.trees):
        w = FO.weights(o, tree, uid)
        piece = FO.grow(x, y, w, FO.root_key(o, tree), o)
        use = w > 0
        got = piece.value[piece.nodes(x[use])]
        assert np.abs(got - plain_tree(x[use], y[use], w[use], FO.root_key(o, tree), o)).max() < 1e-6


def test_random_cuts_are_uniform_between_the_ends():
    keys = FO.mix(np.arange(20_000, dtype=np.uint64))
    cut = FO.cut_between(keys, np.zeros(20_000, int), np.full(20_000, 2.0), np.full(20_000, 6.0))
    assert cut.min() >= 2 and cut.max() < 6
    share = np.histogram(cut, np.linspace(2, 6, 21))[0] / 20_000
    assert np.abs(share - 0.05).max() < 0.01
    w = FO.weights(FO.Options(), 3, np.arange(100_000))
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03 and abs((w == 0).mean() - np.exp(-1)) < 0.01


@pytest.mark.parametrize("o", [FO.Options(trees=5), FO.Options(trees=5, random_cuts=True, bootstrap=False), FO.Options(trees=3, max_depth=3)])
def test_forest_in_tasks_equals_passes(spark, o):
    df, x, y = table(spark, 500, 6, missing=0)
    one = FO.fit(df, o)
    two = FO.fit(df.repartition(3), o, task_rows=60, group=2)
    assert not two.pieces.filter("length(link) > 0").isEmpty()
    a, b, c = scores(one, df), scores(two, df), np.array([
        r.score for r in one.transform(df, task_bytes=2000).orderBy("case_id").collect()])
    assert np.abs(a - b).max() < 1e-9 and np.abs(a - c).max() < 1e-9
    if o.max_depth is None:
        assert ((a > 0.5) == y).mean() > 0.95


def test_forest_is_saved_and_loaded(spark, tmp_path):
    df, *_ = table(spark, 200, 7, missing=0)
    m = FO.fit(df, FO.Options(trees=10))
    m.save(str(tmp_path / "f"))
    assert (scores(FO.ForestModel.load(spark, str(tmp_path / "f")), df) == scores(m, df)).all()


def test_one_class_and_constant_features(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0], 1) for i in range(30)], "case_id long, features array<double>, label int")
    assert (scores(FO.fit(df, FO.Options(trees=3)), df) == 1).all() and (scores(BO.fit(df, BO.Options(rounds=3)), df) > 0.99).all()
    mixed = df.withColumn("label", (F.col("case_id") % 3 == 0).cast("int"))
    assert np.abs(scores(FO.fit(mixed, FO.Options(trees=3, bootstrap=False)), mixed) - 1 / 3).max() < 1e-6


def test_search_reads_every_grid_point_off_one_growth(spark):
    """Each point's accuracy equals a forest (or booster) fitted on its own."""
    from casewise.operators import select as SL
    from casewise.operators.models import fit_model
    df, x, y = table(spark, 240, 8, missing=0)
    prep = SL.Prepared(df, df, None)
    grid = {"max_depth": [2, None], "looks": ["sqrt", "all"], "trees": [5, 12]}
    got = {r.params: r.cv_accuracy for r in SL.random_search(prep, "random_forest", grid, folds=2).collect()}
    assert len(got) == 8
    import json
    from casewise.operators.binned import Bins, matrix
    folded = df.withColumn("fold", F.pmod(F.xxhash64(F.lit(42), F.col("case_id")), F.lit(2)).cast("int"))
    bins = Bins.fit(df, "features")
    for point in ({"max_depth": 2, "looks": "sqrt", "trees": 12}, {"max_depth": None, "looks": "all", "trees": 5}):
        right = []
        for f in range(2):
            m = matrix(folded.where(F.col("fold") != f), "features", "label", "case_id", bins, 5)
            o = FO.Options(**point)
            model = FO.ForestModel(FO._fit_held(m, o), o, bins, 5)
            right.append(SL._accuracy(model.transform(folded.where(F.col("fold") == f))))
        assert abs(got[json.dumps(point, sort_keys=True)] - np.mean(right)) < 1e-9
    boosted = SL.random_search(prep, "xgboost", {"max_depth": [2, 4], "min_hessian": [1.0]}, folds=2).collect()
    assert len(boosted) == 2 and all(r.cv_accuracy > 0.6 for r in boosted)
    assert fit_model("xgboost", df, params={"rounds": 3}).score(df).filter("score between 0 and 1").count() == 240


def test_symmetric_trees_have_one_cut_a_level(spark):
    df, x, y = table(spark, 500, 9)
    o = BO.Options(rounds=5, rate=0.3, max_depth=4, symmetric=True, penalty=3.0, min_rows=1, min_hessian=0.0, stopping=False)
    one, two = BO.fit(df, o), BO.fit(df.repartition(3), o, held=False)
    assert one.trees == two.trees
    for t in one.trees:
        level = [0]
        while t.feature[level[0]] >= 0:
            assert len({(t.feature[n], t.cut[n], t.missing_left[n]) for n in level}) == 1
            level = [c for n in level for c in (t.left[n], t.left[n] + 1)]
    # the first cut is the best one of the level: for one node, the best split by search
    stump = BO.fit(df, BO.Options(rounds=1, rate=0.3, max_depth=1, symmetric=True, penalty=3.0, min_rows=1, min_hessian=0.0, stopping=False))
    plain = BO.fit(df, BO.Options(rounds=1, rate=0.3, max_depth=1, penalty=3.0, min_rows=1, min_hessian=0.0, stopping=False))
    assert (stump.trees[0].feature[0], stump.trees[0].cut[0]) == (plain.trees[0].feature[0], plain.trees[0].cut[0])
    assert ((scores(BO.fit(df, BO.Options(rounds=150, rate=0.3, max_depth=4, symmetric=True, penalty=3.0, min_rows=1, stopping=False)), df) > 0.5) == y).mean() > 0.95


def test_ordered_target_statistics_never_see_their_own_label(spark):
    import hashlib
    from casewise.operators.target_stats import ordered_target_stats
    rng = np.random.default_rng(1)
    rows = [(i, "abc"[min(2, int(rng.exponential()))] if i % 9 else None, "x", int(rng.integers(0, 2))) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, c string, k string, y int")
    out = {}
    for prefix in (1, 2):
        got, stats = ordered_target_stats(df.repartition(3), ["c", "k"], "y", "id", prefix=prefix)
        out[prefix] = {r.id: (r.c_ts, r.k_ts) for r in got.collect()}
    prior = sum(r[3] for r in rows) / 400
    order = sorted(rows, key=lambda r: (hashlib.md5(f"42|{r[0]}".encode()).hexdigest(), r[0]))
    for k, col in enumerate((1, 2)):
        seen = {}
        for r in order:
            s, n = seen.get(r[col], (0, 0))
            for p in out.values():
                assert abs(p[r[0]][k] - (s + prior) / (n + 1)) < 1e-12
            seen[r[col]] = (s + r[3], n + 1)
    new = stats.transform(spark.createDataFrame([(1, "a", "x"), (2, "new", None)], "id long, c string, k string"), "id").orderBy("id").collect()
    s, n = seen["x"]
    assert abs(new[0].k_ts - (s + prior) / (n + 1)) < 1e-12 and new[1].c_ts == new[1].k_ts == pytest.approx(prior)


def test_kernel_machine_equals_exact_solver_and_separates_a_ring(spark, tmp_path):
    from casewise.operators import kernel_svc as KS
    rng = np.random.default_rng(2)
    r, a = np.where(np.arange(200) % 2, 1.0, 3.0) + 0.3 * rng.normal(size=200), rng.uniform(0, 2 * np.pi, 200)
    x, y = np.column_stack([r * np.cos(a), r * np.sin(a)]), (np.arange(200) % 2).astype(int)
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], int(y[i])) for i in range(200)], "case_id long, features array<double>, label int")
    m = KS.fit(df, C=1.0, gamma=0.5, landmarks=200)
    got = np.array([v.f for v in df.withColumn("f", m.margin(F.col("features"))).orderBy("case_id").collect()])
    # the kernel machine itself: f = K a + b, a = 2 C y slack (squared hinge), solved by fixed active sets
    k, t = KS.kernel(x, x, 0.5), 2.0 * y - 1
    active = np.ones(200, bool)
    for _ in range(100):
        s = np.flatnonzero(active)
        big = np.block([[k[np.ix_(s, s)] + np.eye(len(s)) / 2.0, np.ones((len(s), 1))], [np.ones((1, len(s))), np.zeros((1, 1))]])
        sol = np.linalg.solve(big, np.append(t[s], 0))
        f = k[:, s] @ sol[:-1] + sol[-1]
        now = t * f < 1
        if (now == active).all():
            break
        active = now
    assert np.abs(got - f).max() < 1e-4
    assert ((got > 0) == y).all()
    few = KS.fit(df, C=1.0, gamma=0.5, landmarks=40)
    assert ((scores(few, df) > 0.5) == y).mean() > 0.97
    m.save(str(tmp_path / "s"))
    assert np.abs(scores(KS.KernelSvcModel.load(spark, str(tmp_path / "s")), df) - scores(m, df)).max() < 1e-12


def slow_adaboost(x, y, rounds):
    """Plain boosting: every cut of every feature tried on float weights."""
    w, out = np.ones(len(y)) / len(y), []
    for _ in range(rounds):
        best = None
        for f in range(x.shape[1]):
            v = np.unique(x[~np.isnan(x[:, f]), f])
            for cut in [*((v[:-1] + v[1:]) / 2), *([math.inf] if np.isnan(x[:, f]).any() else [])]:
                left = x[:, f] <= cut
                sides = [[w[s & (y == k)].sum() for k in (0, 1)] for s in (left, ~left)]
                purity = sum((a * a + b * b) / (a + b) for a, b in sides)
                if best is None or purity > best[0] + 1e-12:
                    best = (purity, f, cut, *(int(b > a) for a, b in sides))
        _, f, cut, a, b = best
        miss = np.where(x[:, f] <= cut, a, b) != y
        error = w[miss].sum() / w.sum()
        if error >= 0.5:
            break
        vote = math.log((1 - max(error, 1e-10)) / max(error, 1e-10))
        out.append((f, cut, a, b, vote))
        if error <= 1e-10:
            break
        w = w * np.exp(vote * miss)
        w /= w.sum()
    return out


def test_adaboost_equals_plain_boosting(spark, monkeypatch):
    from casewise.operators import adaboost, binned
    rng = np.random.default_rng(8)
    x = rng.normal(size=(150, 3)).round(3)
    x[::9, 1] = np.nan
    y = ((x[:, 0] + np.nan_to_num(x[:, 1], nan=1.5) ** 2 + 0.5 * rng.normal(size=150)) > 0.8).astype(int)
    df = spark.createDataFrame([(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, y, strict=True))], "case_id int, features array<double>, label int").repartition(5)
    want = slow_adaboost(x, y, 12)
    got = adaboost.fit(df, "features", "label", 12)
    assert len(got) == len(want) == 12
    for a, b in zip(got, want, strict=True):
        assert a[0] == b[0] and a[2:4] == b[2:4] and (a[1] == b[1] or a[1] == pytest.approx(b[1], abs=1e-9)) and a[4] == pytest.approx(b[4], abs=1e-4)
    total = sum(s[4] for s in want)
    votes = sum(s[4] * np.where(x[:, s[0]] <= s[1], s[2], s[3]) for s in want) / total
    scores = {r.case_id: r.score for r in adaboost.score(df, "features", got).collect()}
    assert all(scores[i] == pytest.approx(v, abs=1e-4) for i, v in enumerate(votes))
    monkeypatch.setattr(binned, "HELD", 0)
    assert adaboost.fit(df, "features", "label", 12) == got


def test_adaboost_edges(spark):
    from casewise.operators import adaboost
    df = spark.createDataFrame([(i, [float(i), 1.0], int(i > 3)) for i in range(8)], "case_id int, features array<double>, label int")
    assert len(adaboost.fit(df, "features", "label", 9)) == 1  # one cut makes no error
    same = df.withColumn("features", F.array(F.lit(1.0)))
    assert adaboost.fit(same, "features", "label", 9) == []  # nothing to cut, classes even
    one = adaboost.fit(same.withColumn("label", F.lit(1)), "features", "label", 9)
    assert {r.score for r in adaboost.score(same, "features", one).collect()} == {1.0}
    assert adaboost.fit(df.limit(0), "features", "label", 9) == []
    assert {r.score for r in adaboost.score(df, "features", []).collect()} == {0.5}


def test_two_code_features_are_not_sorted_and_columns_are_laid_out_once(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(3, 5, 200), rng.integers(0, 2, 200), np.full(200, 9), np.where(rng.random(200) < 0.3, MISSING, 0)]).astype(np.uint8)
    y, uid = rng.integers(0, 2, 200), rng.integers(-2**62, 2**62, 200)
    o = FO.Options(looks="all")
    w, key = FO.weights(o, 1, uid), FO.root_key(o, 1)

    def sort(*_):
        raise AssertionError("sorted")
    monkeypatch.setattr(FO, "_best_cuts", sort)
    p = FO.grow(x, y, w, key, o, columns=FO.Columns(x))
    leaf = p.nodes(x)
    assert len(set(leaf)) == len({tuple(r) for r in x[w > 0]})  # no two kinds of rows share a leaf, as none is pure
    for n in set(leaf):
        mine = (leaf == n) & (w > 0)
        assert p.value[n] == pytest.approx((w * y)[mine].sum() / w[mine].sum())


def test_a_round_reads_the_rows_once_a_level(spark, monkeypatch):
    """Spread rows: the root's histogram gives the sums too, and without held-out rows no loss is taken."""
    df, *_ = table(spark, 300, 11)
    frame, seen = type(df), []
    real = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, f, schema, *a, **k: (seen.append(schema), real(self, f, schema, *a, **k))[1])
    o = BO.Options(rounds=2, max_depth=3, max_leaves=None, stopping=False, min_rows=1)
    two = BO.fit(df, o, held=False)
    assert [s for s in seen if s.startswith("f int")] and len([s for s in seen if s.startswith(("f int", "g long", "loss"))]) <= 2 * 3
    assert two.trees == BO.fit(df, o).trees


def test_rows_go_on_from_their_nodes():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 9, (500, 4)).astype(np.uint8)
    x[rng.random(x.shape) < 0.2] = MISSING
    y = rng.integers(0, 2, 500)
    o = BO.Options(rounds=3, max_leaves=7, stopping=False, min_rows=2)
    passes = BO.Held(y, x, np.zeros(500, bool), BO.Layout(Bins([np.arange(8) + 0.5] * 4)), o)
    total = np.full(500, passes.start)
    for t in BO.boost(passes, o, False):  # some nodes are split ahead and not kept
        total += t.arrays()[4][BO.leaves(t.arrays(), x)]
    assert (passes.score == total).all()
    halfway = np.zeros(500, np.int64)
    feature, *rest = t.arrays()
    top = feature.copy()
    top[1:] = -1
    BO.leaves((top, *rest), x, halfway)
    assert set(halfway) <= {0, t.left[0], t.left[0] + 1}
    assert (BO.leaves(t.arrays(), x, halfway) == BO.leaves(t.arrays(), x)).all()


def test_float_features_of_two_values_are_counted_like_codes():
    """F8: random cuts of such features need no lowest and highest value a node; rows left over go on side by side."""
    from casewise.operators import forests
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(0, 2, (400, 5)) * 3.0 - 1.0, rng.normal(size=(400, 2))], axis=1).astype(np.float32)
    c = forests.Columns(x)
    assert c.two.tolist() == [True] * 5 + [False] * 2
    rows = np.array([7, 3, 399])
    assert (c.some(rows).flat.reshape(7, 3) == x[rows].T).all() and (c.some(rows).bit.reshape(7, 3)[:5] == (x[rows, :5].T > 0)).all()
    y = ((x[:, 0] > 0) ^ (x[:, 5] > 0.3)).astype(np.int64)
    o = forests.Options(bootstrap=False, random_cuts=True)
    p = forests.grow(x, y, np.ones(400, np.int64), forests.root_key(o, 0), o)
    assert (p.value[p.nodes(x)] == y).all()
    inner = p.feature >= 0
    two = inner & (p.feature < 5)
    assert two.any() and ((p.cut[two] >= -1) & (p.cut[two] < 2)).all()
