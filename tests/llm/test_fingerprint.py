import hashlib
import random

import numpy as np

from casewise.llm import fingerprint as M
from tests.llm.conftest import DOC_SCHEMA


def shingles(t):
    w = t.lower().split()
    return {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def test_likeness_estimates_jaccard():
    rnd = random.Random(3)
    m = M.OnePermutation()
    err = []
    for n in (3, 12, 60, 400, 3000):
        for keep in (0.0, 0.3, 0.7, 1.0):
            for _ in range(6):
                a = [f"w{rnd.randrange(10**6)}" for _ in range(n)]
                b = a[:int(n * keep)] + [f"w{rnd.randrange(10**6)}" for _ in range(n - int(n * keep))]
                s, t = shingles(" ".join(a)), shingles(" ".join(b))
                err.append(m.likeness(m.sketch(" ".join(a)), m.sketch(" ".join(b))) - len(s & t) / len(s | t))
    assert abs(np.mean(err)) < 0.02 and np.sqrt(np.mean(np.square(err))) < 0.06
    assert m.packed(m.sketch("A b")) == m.packed(m.sketch("a  B")) and len(m.packed(m.sketch(None))) == 256
    assert m.likeness(m.sketch(""), m.sketch("x")) < 0.2 and m.likeness(m.sketch(""), m.sketch(" ")) == 1


def test_next_document(spark):
    texts = ["one two three four five six seven", "", None, "é" * 10, "a b c", "a b c", "long " * 3000, "x"]
    rows = [(i * 3 % 8 * 10**15 + 1, t, None, None, 0) for i, t in enumerate(texts)] + [(None, "no id here", None, None, 0)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)
    got = {r.doc_id: r for r in M.compare_with_next(docs).collect()}
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    m = M.OnePermutation()
    for cur, nxt in zip(order, order[1:] + order[:1], strict=True):
        a, b = cur[1] or "", nxt[1] or ""
        k = len(a) // 3
        new = a[:len(a) - k] + b[:k]
        r = got[cur[0]]
        assert r.n_chars == len(a) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert r.fingerprint == m.packed(m.sketch(a)) and r.edited_fingerprint == m.packed(m.sketch(new))
        assert r.near_next == m.likeness(m.sketch(a), m.sketch(b))
    assert M.compare_with_next(docs.limit(0)).count() == 0
    one = M.compare_with_next(docs.filter("doc_id is null")).collect()
    assert len(one) == 1 and one[0].near_next == 1


def test_repeated_rows_and_plain_fingerprints(spark):
    docs = spark.createDataFrame([(5, "same text here", None, None, 0)] * 4 + [(4, "other", None, None, 0)], DOC_SCHEMA)
    assert M.compare_with_next(docs).count() == 5
    out = M.fingerprints(docs.withColumnRenamed("lang", "fingerprint"))
    assert out.columns == ["doc_id", "source", "n_chars", "fingerprint"] and out.select("fingerprint").distinct().count() == 2
