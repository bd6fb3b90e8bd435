import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from casewise.llm import toxicity as T
from casewise.llm.common import id_fold
from tests.llm.conftest import DOC_SCHEMA, SF


def test_held_out_accuracy(spark):
    base = SF.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")
    model = T.fit(docs.filter(id_fold("doc_id", 3) != 1), labels)
    held = docs.join(labels, "doc_id").filter(id_fold("doc_id", 3) == 1)
    got = T.score(held, model).select("toxic", (F.col("score") >= 0.7).alias("p"), "score")
    r = got.agg(F.avg((F.col("p") == (F.col("toxic") == 1)).cast("int")).alias("accuracy"), F.sum(F.when(F.col("p"), F.col("toxic"))).alias("hits"),
                F.count_if("p").alias("called"), F.min("score").alias("low"), F.max("score").alias("high")).first()
    assert r.accuracy > 0.95 and r.hits / r.called > 0.97 and 0 <= r.low and r.high <= 1


def test_features():
    lex = T.Lexicon({"idiot": 5.0, "^vequ": 4.0})
    names = T.FEATURES
    plain, rude = (dict(zip(names, lex.features(t), strict=True)) for t in ("the cat sat on a mat", "YOU 1d1ot, you idiot!!! vequille i d i o t"))
    assert not any(plain[k] for k in ("strong", "seed", "hidden", "second_person", "shouted", "exclaim", "spaced"))
    assert all(rude[k] > 0 for k in ("strong", "strong_hits", "top", "seed", "hidden", "second_person", "near", "capitals", "shouted", "exclaim", "spaced"))
    assert lex.features(None) == lex.features("") == lex.features("!?") == [0.0] * len(names)


def test_edges(spark):
    rows = [(i, ("you idiot scum " if i % 4 == 0 else "a quiet sentence ") * (1 + i % 7) + str(i), "en", None, 0) for i in range(120)]
    odd = [(200, None, None, None, 0), (201, "", None, None, 0), (None, "you idiot", None, None, 0), (4, rows[4][1], "en", None, 0), (202, "fine words " * 30000, "en", None, 0)]
    docs = spark.createDataFrame(rows + odd, DOC_SCHEMA).withColumn("score", F.lit("old")).withColumn("features", F.lit(1))
    labels = spark.createDataFrame([*[(i, int(i % 4 == 0), 1) for i in range(120)], (4, 0, 1), (5, None, 1), (None, 1, 1), (201, 0, 1)], "doc_id long, toxic int, quality int")
    model = T.fit(docs, labels, rounds=5)
    got = T.score(docs, model)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "features", "score"] and got.count() == 125
    by = {r.doc_id: r.score for r in got.collect()}
    assert by[200] == by[201] and by[200] < 0.5 < by[8] and by[None] > 0.5 and by[202] < 0.5
    assert T.score(docs.limit(0), model).count() == 0
    for y, prior in ((0, 0.0), (1, 1.0)):
        only = T.fit(docs, labels.filter(F.col("toxic") == y))
        assert {r.score for r in T.score(docs, only).collect()} == {prior}
    assert {r.score for r in T.score(docs, T.fit(docs, labels.limit(0))).collect()} == {0.0}


def place(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def slow_lexicon(rows):
    """Entry -> log-odds, counted one entry at a time over (text, label) rows."""
    texts = [({u for w in set(re.findall("[a-z0-9]+", t.lower())) for u in [w, *("^" + w[:k] for k in (3, 4, 5, 6) if len(w) >= k)]}, y)
             for t, y in rows]
    toxic, clean = sum(y for _, y in rows), sum(1 - y for _, y in rows)
    out = {}
    for u in set().union(*(us for us, _ in texts)):
        a, b = (sum(u in us for us, y in texts if y == k) for k in (1, 0))
        if a < max(2, 0.01 * toxic):
            continue
        pa, pb, qa, qb = a + 0.5, b + 0.5, toxic + 0.5 - a, clean + 0.5 - b
        odds = math.log(pa / qa) - math.log(pb / qb)
        if odds > 0.7 and odds / math.sqrt(1 / pa + 1 / pb + 1 / qa + 1 / qb) > 2.5:
            out[u] = odds
    return out


def slow_features(text, lexicon):
    """Some of the dense features by their definitions, word by word."""
    raw = re.findall("[A-Za-z0-9]+", text)
    words = [w.lower() for w in raw]

    def weight(w):
        return max([lexicon.get(u, 0.0) for u in [w, *("^" + w[:k] for k in (3, 4, 5, 6) if len(w) >= k)]])
    n, v = len(words), [weight(w) for w in words]
    seeds = [w in T.SEED_WORDS for w in words]
    hit = [x >= 3 or s for x, s in zip(v, seeds, strict=True)]
    you = [i for i, w in enumerate(words) if w in T.SECOND_PERSON]
    return {"strong": sum(x >= 3 for x in v) / n, "medium": sum(1.5 <= x < 3 for x in v) / n, "weak": sum(0 < x < 1.5 for x in v) / n,
            "strong_hits": math.log1p(len({w for w, x in zip(words, v, strict=True) if x >= 3})), "top": max(v), "mean": sum(v) / n,
            "seed": sum(seeds) / n, "second_person": len(you) / n, "near": sum(any(hit[max(0, i - 3):i + 4]) for i in you) / n,
            "capitals": sum(c.isupper() for c in text) / sum(map(len, raw)), "shouted": sum(w.isupper() and len(w) > 1 for w in raw) / n,
            "exclaim": text.count("!") / n, "punctuation": sum(c in ".,!?" for c in text) / len(text), "words": math.log1p(n),
            "word_length": sum(map(len, raw)) / n, "distinct": len(set(words)) / n}


def slow_isotonic(x, y, at):
    """The least-squares ascending fit by its max-min formula over runs of distinct x, between them on straight lines."""
    xs = sorted(set(x))
    total = [(sum(b for a, b in zip(x, y, strict=True) if a == v), x.count(v)) for v in xs]

    def mean(i, j):
        return sum(s for s, _ in total[i:j + 1]) / sum(n for _, n in total[i:j + 1])
    fit = [max(min(mean(a, b) for b in range(i, len(xs))) for a in range(i + 1)) for i in range(len(xs))]
    return np.interp(at, xs, fit)


def test_equals_plain_steps(spark):
    """Lexicon, features, boosted margins and calibration, each against its definition."""
    rnd = random.Random(11)
    calm, rude = "river stone quiet morning paper window garden letter you table summer".split(), "vortig skell idiot moron grumph you blatherer".split()
    rows = []
    for i in range(500):
        toxic = i % 3 == 0
        words = rnd.choices(calm, k=rnd.randint(4, 20)) + rnd.choices(rude, k=rnd.randint(1, 4) if toxic else int(rnd.random() < 0.15))
        rnd.shuffle(words)
        words = [w.upper() if rnd.random() < 0.1 else w for w in words]
        rows.append((i, " ".join(words) + rnd.choice([".", "!", "!!", " ?"]) + f" nr{i}", int(toxic != (rnd.random() < 0.08))))
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t, _ in rows], DOC_SCHEMA)
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows], "doc_id long, toxic int, quality int")
    model = T.fit(docs, labels, rounds=4, depth=2)

    part = {i: (place(t) >> 7) % 10 for i, t, _ in rows}
    lexicon = slow_lexicon([(t, y) for i, t, y in rows if part[i] < 4])
    assert model.lexicon.weights.keys() == lexicon.keys() and len(lexicon) > 5
    assert all(model.lexicon.weights[u] == pytest.approx(w, abs=1e-9) for u, w in lexicon.items())

    x = {i: T.Lexicon(lexicon).features(t) for i, t, _ in rows}
    for i, t, _ in rows:
        own = dict(zip(T.FEATURES, x[i], strict=True))
        assert all(own[k] == pytest.approx(v, abs=1e-9) for k, v in slow_features(t, lexicon).items())

    trees, shares = model.trees.trees, model.trees.treeWeights
    some = [r for r in rows if part[r[0]] > 7 or r[0] % 4 == 0]
    raw = {i: 1 / (1 + math.exp(-2 * sum(w * tree.predict(Vectors.dense(x[i])) for tree, w in zip(trees, shares, strict=True)))) for i, _, _ in some}
    base = [(round(raw[i], 12), y) for i, _, y in rows if part[i] > 7]
    assert len({y for _, y in base}) == 2 and len({v for v, _ in base}) > 3
    want = slow_isotonic([v for v, _ in base], [y for _, y in base], [raw[i] for i, *_ in some])
    got = {r.doc_id: r.score for r in T.score(docs, model).collect()}
    assert len(got) == 500
    for (i, *_), s in zip(some, want, strict=True):
        assert got[i] == pytest.approx(0.999 * s + 0.001 * raw[i], abs=1e-6)
