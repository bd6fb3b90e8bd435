import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from casewise.llm import langid
from casewise.llm.common import id_fold
from tests.llm.conftest import DOC_SCHEMA, SF


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet")
    model = langid.fit(docs.filter(id_fold("doc_id", 5) != 0))
    out = langid.predict(docs, model)
    assert out.columns == [*docs.columns, "lang_pred", "score"] and out.count() == docs.count()
    held = out.filter(id_fold("doc_id", 5) == 0).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held > 0.97
    assert out.filter("score < 0 or score > 1").isEmpty()


def test_kernel_is_the_blended_spectrum(spark):
    model = langid.KernelModel(sorted(map(ord, "abcdefghijklmnopqrstuvwxyz")), ["x"])

    def grams(t):
        letters = "".join(c if c.isalpha() else " " for c in t.lower())
        s = " " + " ".join(letters.split()) + " "
        return {s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)}
    rnd = random.Random(1)
    texts = ["".join(rnd.choices("abcde  fg,.1", k=40)) for _ in range(12)]
    sets = [np.unique(model.codes(t)) for t in texts]
    assert [len(s) for s in sets] == [len(grams(t)) for t in texts]
    assert all(len(np.intersect1d(a, b)) == len(grams(s) & grams(t)) for a, s in zip(sets, texts, strict=True) for b, t in zip(sets, texts, strict=True))
    assert len(model.codes("12 !")) == 0


def test_edges(spark):
    rows = [(i, ["the cat sat on the mat and then", "der hund und die katze sind nicht hier"][i % 2] + f" {i}", "en" if i % 2 == 0 else "de", None, 0) for i in range(40)]
    odd = [(100, None, None, None, 0), (101, "", "en", None, 0), (102, "12 34 !", "de", None, 0), (None, "und der die das", "de", None, 0),
           (7, rows[7][1], "de", None, 0), (103, "日本語のテキスト", None, None, 0), (104, "the mat " * 30000, "en", None, 0)]
    docs = spark.createDataFrame(rows + odd, DOC_SCHEMA).withColumn("lang_pred", F.lit("old")).withColumn("p", F.lit(1))
    model = langid.fit(docs.filter("doc_id is null or doc_id < 40"))
    got = langid.predict(docs, model)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "p", "lang_pred", "score"]
    by = {r.doc_id: (r.lang_pred, r.score) for r in got.collect()}
    assert by[100] == by[101] == by[102] == ("und", 0.0)
    assert by[104][0] == "en" and by[None][0] == "de" and by[7][0] == "de" and by[103][0] in ("en", "de")
    assert got.count() == 47 and langid.predict(docs.limit(0), model).count() == 0
    assert langid.fit(docs.limit(0)) is None and langid.fit(docs.filter("doc_id in (101, 102)")) is None
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}


def test_every_language_is_learned_at_any_size(spark):
    own = {"en": "the cat sat on the mat and then", "de": "der hund und die katze sind nicht hier", "fi": "kissa istuu matolla eikä koira ole täällä"}
    rows = [(i, f"{own['en']} {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{i}", "en", None, 0) for i in range(6000)]
    rows += [(7000 + i, own["de"], "de", None, 0) for i in range(300)] + [(8000 + i, f"{own['fi']} {i}", "fi", None, 0) for i in range(3)]
    rows += [(9000 + i, " ".join([f"{chr(0x4e00 + 3 * i)}{chr(0x4e01 + 3 * i)}"] * 9), f"x{i:03}", None, 0) for i in range(150)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    model = langid.fit(docs, sample=1000)
    assert model.languages == sorted([*own, *(f"x{i:03}" for i in range(150))])
    pred = {r.doc_id: r.lang_pred for r in langid.predict(docs.filter("doc_id >= 7000 or doc_id < 20"), model).collect()}
    assert all(pred[i] == "en" for i in range(20)) and pred[7000] == "de" and pred[8001] == "fi"
    kept = langid._by_hash(docs.selectExpr("text as t", "lang as l"), 1000, "t", "l").groupBy("l").agg(F.countDistinct("t")).collect()
    assert len(kept) == 153 and 800 < sum(n for _, n in kept) < 1200 and dict(map(tuple, kept))["fi"] == 3
    assert langid._quota([3, 100, 1], 24) == 20 and langid._quota([1, 2], 9) == float("inf")


def test_letterless_texts_take_no_landmarks(spark):
    real = [(i, f"wort nummer {chr(97 + i % 26) * 3} und mehr" if i % 2 else f"word number {chr(97 + i % 26) * 3} and more", "de" if i % 2 else "en", "s", 9)
            for i in range(40)]
    noise = [(100 + i, f"{i} 123 !!", ["de", "en"][i % 2], "s", 9) for i in range(600)]
    docs = spark.createDataFrame(real + noise, "doc_id long, text string, lang string, source string, n_chars long")
    model, plain = langid.fit(docs, landmarks=16), langid.fit(docs.filter("doc_id < 100"), landmarks=16)
    assert model.landmarks.shape[1] == 16 and (model.weights == plain.weights).all()
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    assert all(got[i] == lang for i, _, lang, _, _ in real) and all(got[i] == "und" for i, *_ in noise)


def test_one_sum_reaches_the_driver_whatever_the_partitions(spark, monkeypatch):
    rows = [(i, f"{['the cat sat on the mat', 'der hund und die katze'][i % 2]} {chr(97 + i % 26)}{chr(97 + i // 26)}", ["en", "de"][i % 2], None, 0) for i in range(200)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    plain = langid.fit(docs, landmarks=16)
    frame, sent = type(docs), []
    deal, collect = frame.repartition, frame.collect

    def counted(self):
        out = collect(self)
        sent.append(sum(len(v) for r in out for v in r if isinstance(v, (bytes, bytearray))))
        return out
    monkeypatch.setattr(frame, "repartition", lambda self, n, *by: deal(self, 5 * n, *by))
    monkeypatch.setattr(frame, "collect", counted)
    model = langid.fit(docs, landmarks=16)
    size, k = len(model.root_count), len(model.languages)
    assert (size, k) == (16, 2) and sum(sent) == 8 * size * (size + k)
    assert np.abs(model.weights - plain.weights).max() < 1e-4


def slow_scores(train, langs, texts, landmarks, ridge):
    """Scores of ``texts`` by sets of n-grams and full kernel matrices: regression of all training texts on the landmarks."""
    def grams(t):
        s = " " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " "
        return {s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)}

    def place(t):
        h = xxhash.xxh64_intdigest(t.encode(), 42)
        return h - (1 << 64) if h >> 63 else h
    names = sorted(set(langs))
    marks = [grams(t) for name in names for t in sorted((t for t, g in zip(train, langs, strict=True) if g == name), key=place)[:landmarks // len(names)]]
    known = set().union(*marks)

    def kernels(ts):
        return np.array([[len(grams(t) & m) / np.sqrt(max(1, len(grams(t) & known)) * len(m)) for m in marks] for t in ts])
    k, own = kernels(train), np.array([[len(a & b) / np.sqrt(len(a) * len(b)) for b in marks] for a in marks])
    y = np.array([[1.0 if g == name else -1.0 for name in names] for g in langs])
    w = np.linalg.solve(k.T @ k + len(train) * (ridge * own + 1e-6 * np.eye(len(marks))), k.T @ y)
    return names, kernels(texts) @ w


@pytest.mark.parametrize("landmarks", [12, 400])
def test_equals_ridge_on_full_kernels(spark, landmarks):
    rnd = random.Random(5)
    vocabulary = {"en": "the cat sat on a mat and then it went out of here again", "de": "der hund und die katze sind nicht hier sondern dort drüben",
                  "fr": "le chat est assis sur la natte et puis il s'en va là-bas"}
    rows = []
    for i in range(90):
        lang = sorted(vocabulary)[i % 3]
        own = rnd.choices(vocabulary[lang].split(), k=rnd.randint(3, 25))
        mixed = rnd.choices(" ".join(vocabulary.values()).split(), k=rnd.randint(0, 6))
        rows.append((i, " ".join(own + mixed) + f" {i}, x{chr(97 + i % 26)}{chr(97 + i // 26)}!", lang, None, 0))
    train, rest = rows[:60], rows[60:]
    model = langid.fit(spark.createDataFrame(train, DOC_SCHEMA), landmarks=landmarks, ridge=0.01)
    names, f = slow_scores([r[1] for r in train], [r[2] for r in train], [r[1] for r in rows], landmarks, 0.01)
    assert names == model.languages and model.landmarks.shape[1] == min(landmarks, 60)
    assert np.abs(model.scores([r[1] for r in rows])[0] - f).max() < 2e-3  # the operator holds weights in 32 bits
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(spark.createDataFrame(rows, DOC_SCHEMA), model).collect()}
    assert len(got) == len(train) + len(rest)
    for (i, *_), row in zip(rows, f, strict=True):
        assert abs(got[i][1] - min(1.0, max(0.0, (1 + row.max()) / 2))) < 2e-3
        if np.diff(np.sort(row))[-1] > 5e-3:
            assert got[i][0] == names[int(row.argmax())]
