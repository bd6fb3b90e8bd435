import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from casewise.llm import lm
from tests.llm.conftest import DOC_SCHEMA


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]


def fold(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5


def brute(rows):
    """Everything by plain counting; the EM cells are quantised by the same grid."""
    def counts(keep):
        uni, bi, docs = Counter(), Counter(), 0
        for i, t in rows:
            if keep(fold(i)):
                tk = tokens(t)
                uni.update(tk)
                bi.update(zip(["<s>", *tk[:-1]], tk, strict=True))
                docs += 1
        return uni, bi, docs

    def estimates(c, tk):
        uni, bi, docs = c
        n = sum(uni.values())
        for v, w in zip(["<s>", *tk[:-1]], tk, strict=True):
            seen = docs if v == "<s>" else uni[v]
            yield seen, bi[v, w] / seen if seen else 0.0, uni[w] / max(n, 1)
    kept, every = counts(lambda f: f not in (1, 2)), counts(lambda f: f != 1)
    cells = Counter()
    for i, t in rows:
        if fold(i) == 2:
            for s, two, one in estimates(kept, tokens(t)):
                cells[int(lm.context_bucket(np.array([s]))[0]), int(lm._grid(np.array([two]))[0]), int(lm._grid(np.array([one]))[0])] += 1
    table = np.array([[*k, n] for k, n in sorted(cells.items())], np.int64).reshape(-1, 4)
    lam = lm.learn_weights(table, 1 / (len(kept[0]) + 1))
    uni = every[0]
    n, v = sum(uni.values()), len(uni)
    out = []
    for i, t in rows:
        tk = tokens(t)
        base = sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tk)
        s = 0.0
        for seen, two, one in estimates(every, tk):
            a = lam[int(lm.context_bucket(np.array([seen]))[0])]
            s += math.log10(a[0] * two + a[1] * one + a[2] / (v + 1))
        out.append((i, fold(i) == 1, len(tk), sum(uni[w] > 0 for w in tk), n, base, s))
    return out


def same(got, want):
    got = sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[5]))
    want = sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[5]))
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-9) for x, y in zip(g[5:], w[5:], strict=True)), (g, w)


def test_equals_brute_force(spark):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rnd.choices(words, weights=range(60, 0, -1), k=rnd.randrange(0, 60)))) for i in range(150)]
    rows += [(None, "A b a B\tc"), (7, rows[7][1]), (500, None), (501, ""), (502, "É é x\xa0y"), (503, "w1 " * 3000)]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], DOC_SCHEMA).withColumn("fold", F.lit("x"))
    for block, keys in ((10**6, 10**6), (300, 100)):
        same([tuple(r) for r in lm.score(docs, block_tokens=block, range_keys=keys).collect()], brute(rows))


def test_edges(spark):
    empty = spark.createDataFrame([], DOC_SCHEMA)
    assert lm.score(empty).count() == 0
    outside = [i for i in range(40) if fold(i) == 1]
    docs = spark.createDataFrame([(i, "only unseen words", None, None, 0) for i in outside], DOC_SCHEMA)
    r = lm.score(docs).first()
    assert r.train_tokens == 0 and r.n_known == 0 and math.isclose(r.score, 0.0) and math.isclose(r.base_score, 0.0)


def test_weights_raise_held_out_likelihood():
    cells = np.array([[3, 4, 20, 50], [3, lm.FLOOR, 24, 50], [0, lm.FLOOR, 30, 10]])
    lam = lm.learn_weights(cells, 1e-4)
    assert np.allclose(lam.sum(1), 1) and lam[3, 0] > 0.2 and lam[3, 1] > 0.2 and lam[0, 0] == 0
