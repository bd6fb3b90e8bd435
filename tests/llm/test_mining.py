import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewise.llm import mining

SCHEMA = "vec_id long, embedding array<float>, label int, key string, part string, score string"


def moved():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def brute(rows):
    good = []
    for i, v, label in rows:
        if i is None or label is None or v is None or not all(x is not None and math.isfinite(x) for x in v):
            continue
        good.append((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    out, done = [], set()
    for a, (i, label, q) in enumerate(good):
        if i % 100 or good[a] in done:
            continue
        done.add(good[a])
        s = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), j, other == label)
                   for b, (j, other, v) in enumerate(good) if b != a and len(v) == len(q))
        for p, j, _ in [x for x in s if x[2]][:5]:
            fit = [x for x in s if not x[2] and 30 * -p <= 100 * -x[0] <= 90 * -p][:10]
            out += [(i, j, r, n, -p, -sn) for r, (sn, n, _) in enumerate(fit, 1)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "k", "p", "s") for r in rows], SCHEMA)
    got = mining.hard_negatives(df, F.col("id") % 100 == 0, moved(), **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


def clustered(n, dims, groups, seed, noise=0.15):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, dims))
    x = centre[rng.integers(0, groups, n)] + noise * rng.normal(size=(n, dims))
    return x / np.sqrt((x * x).sum(1, keepdims=True))


@pytest.mark.parametrize("options", [{}, {"block": 60, "chunk": 3}])
def test_equals_brute_force(spark, options):
    rnd = random.Random(3)
    x = clustered(900, 8, 6, 1)
    rows = [(i * 5, v.tolist(), rnd.randrange(10)) for i, v in enumerate(x)]
    rows += [(9000 + i, list(rows[40][1]), 3) for i in range(60)]  # a very common vector
    rows += [rows[20], rows[20], rows[3], (100, [9.0] * 8, 1), (None, rows[1][1], 0), (9500, None, 0), (9600, [1.0, None] * 4, 0),
             (9700, [float("nan")] * 8, 0), (9800, [float("inf")] * 8, 0), (9900, rows[1][1], None), (10_000, [0.0] * 8, 0),
             (10_100, [], 1), (10_101, [], 1), (10_102, [], 2), (10_200, [1.0, 2.0], 0), (10_201, [2.0, 1.5], 0), (10_202, [1.0, 1.0], 1)]
    got = run(spark, rows, **options)
    assert got == brute(rows) and len(got) > 100


def test_few_rows_and_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(100, [1.0, 0.0], 1)]) == []
    rows = [(100, [1.0, 0.5], 1), (101, [1.0, 0.0], 1), (102, [0.5, 0.0], 2), (103, [-1.0, 0.0], 1)]
    assert run(spark, rows) == brute(rows) != []


def test_lists_stop_early_on_data_with_structure():
    x = np.floor(256 * clustered(8000, 16, 20, 2)).astype(np.int64)
    near = np.flatnonzero((x @ x[0] > 0.8 * (x[0] @ x[0])))[:40]
    ids = np.arange(8000)
    low, high = np.full((len(near), 1), mining.LOW), np.full((len(near), 1), mining.HIGH)
    c = mining.Cluster(near, np.zeros(len(near), np.int64), near, x[near], low, high, low, True, 5)
    found = {i: (rows, s) for i, _, rows, s in c.walk(ids, np.zeros(8000, np.int64), ids, x)}
    for i, a in enumerate(near):
        s = x @ x[a]
        want = np.lexsort((ids, -s))
        want = want[want != a][:5]
        assert found[i][0].tolist() == want.tolist() and found[i][1].tolist() == s[want].tolist()
    assert c.walked < 0.25 * len(near) * 8000


def test_large_components(spark):
    rows = [(100, [3e6, 2e6], 1), (101, [3e6, 1e6], 1), (102, [1e6, 1e6], 2), (103, [5e5, 0.0], 3)]
    assert run(spark, rows) == brute(rows) != []
    with pytest.raises(Exception, match="does not fit a long"):
        run(spark, [(100, [1e30], 1)])
