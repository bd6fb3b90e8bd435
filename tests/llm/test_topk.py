import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewise.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=20):
    good = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v, _ in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, done = [], set()
    for a, (i, q) in enumerate(good):
        if i % 20 or (i, tuple(q)) in done:
            continue
        done.add((i, tuple(q)))
        s = sorted(((-sum(x * y for x, y in zip(q, v, strict=True)), j) for b, (j, v) in enumerate(good) if b != a and len(v) == len(q)))
        out += [(i, r, j, -n) for r, (n, j) in enumerate(s[:k], 1)]
    return sorted(out)


def test_equals_brute_force(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(0, 0.3) for _ in range(8)], 0) for i in range(300)]
    rows += [(300 + i, list(rows[40][1]), 0) for i in range(60)]  # a very common vector
    rows += [rows[20], rows[20], (60, [9.0] * 8, 1), (None, rows[1][1], 0), (400, None, 0), (420, [1.0, None] * 4, 0),
             (440, [float("nan")] * 8, 0), (460, [float("inf")] * 8, 0), (480, [1.0, 2.0], 0), (481, [3.0, -2.0], 0), (500, [], 0), (520, [0.0] * 8, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for block, chunk in ((8192, 512), (40, 7)):
        got = topk.top_k(df, F.col("vec_id") % 20 == 0, block=block, chunk=chunk)
        assert sorted(map(tuple, got.collect())) == brute(rows)


def test_stops_early_and_large_values():
    rnd = np.random.default_rng(1)
    x = (rnd.normal(size=(4000, 2)) * 1000).astype(np.int32)
    b = topk.Block(np.arange(4000), np.ones(4000, np.int64), x)
    for q in x[:20]:
        ids, scores, _ = next(b.search(np.array([-1]), q[None], 5))
        want = x.astype(np.int64) @ q.astype(np.int64)
        assert scores.tolist() == sorted(want, reverse=True)[:5] and (want[ids] == scores).all()
    big = np.full((50, 4), topk.LARGEST, np.int32)
    ids, scores, _ = next(topk.Block(np.arange(50), np.ones(50, np.int64), big).search(np.array([0]), big[:1], 3))
    assert ids.tolist() == [1, 2, 3] and scores.tolist() == [4 * topk.LARGEST**2] * 3


def test_edges(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(df, F.col("vec_id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0], 2)], SCHEMA).withColumn("id", F.lit("x")).withColumn("n", F.lit("y"))
    assert topk.top_k(one, F.col("vec_id") % 20 == 0).count() == 0


def test_large_components_take_part(spark):
    rnd = random.Random(7)
    rows = [(i, [rnd.gauss(0, 0.3) for _ in range(8)], 0) for i in range(200)]
    rows += [(200 + i, [rnd.gauss(0, 1) * 2.0**rnd.randint(20, 40)] + [rnd.gauss(0, 0.3) for _ in range(7)], 0) for i in range(30)]
    rows += [(240 + i, [0.0] * 7 + [2.0**24 * (1 + i / 70)], 0) for i in range(30)]
    # sums that pass 64 bits on the way but end inside a long
    rows += [(300, [0.0, 2.0**26, 2.0**26] + [0.0] * 5, 0), (301, [0.0, 2.0**26, -(2.0**26)] + [0.0] * 5, 0)]
    rows = [(i, [x if abs(x) < 8.0 or i >= 240 else 0.0 for x in v] if i % 20 == 0 else v, n) for i, v, n in rows]
    rows = [(i, v[:1] + [0.0] * 7 if abs(v[0]) > 2.0**22 else v, n) for i, v, n in rows]
    good = [(i, v, n) for i, v, n in rows if i != 300]
    df = spark.createDataFrame(good, "vec_id long, embedding array<double>, label int")
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, block=64, chunk=5)
    exact = [(i, [math.floor(64 * x) for x in v]) for i, v, _ in good]
    slow = []
    for i, q in exact:
        if i % 20 == 0:
            s = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in exact if j != i)
            slow += [(i, r, j, -n) for r, (n, j) in enumerate(s[:20], 1)]
    assert sum(r[2] >= 200 for r in slow) > 100
    assert sorted(map(tuple, got.collect())) == sorted(slow)


def test_exact_sums():
    a = 1 << 32
    x = np.array([[a, a, 1], [a, -a, 2], [a, -a, 3], [0, 0, 5]], np.int64)
    b = topk.Block(np.arange(3), np.ones(3, np.int64), x[1:])
    ids, scores, _ = next(b.search(np.array([-1]), x[:1], 2))
    assert ids.tolist() == [2, 1] and scores.tolist() == [5, 3]
    with pytest.raises(OverflowError):
        next(topk.Block(np.arange(4), np.ones(4, np.int64), x).search(np.array([-1]), x[:1], 2))
