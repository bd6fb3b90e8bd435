"""Toxicity scores by gradient-boosted trees over dense features, calibrated isotonically.

1. A lexicon is learned from one part of the labelled rows: whole words and word
   beginnings whose document frequency in toxic texts stands out (log-odds with a z
   value), next to a short fixed list of insults.
2. Every text becomes a dense vector: lexicon densities (by strength, and near a second
   person), second-person, capitals, punctuation, obfuscation and shape rates.
3. Spark ML boosts trees on another part of the labelled rows and fits isotonic
   regression on a third, so that neither sees words that the lexicon learned from it.

``sample`` bounds the labelled rows that are used per class (rows whose text hashes
lowest, equal texts once).  Every row of the table is scored, over its whole text.

Defined edge cases: null and empty texts have the zero vector; labels that are null are
not used, several labels of one document count as toxic if one is; with fewer than
``MIN_CLASS`` rows of a class in a part the parts are merged, and with a class missing
altogether every score is the share of toxic labels; repeated rows, null ids and further
columns (whatever their names) pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewise.llm.common import stored

#: Insults that count whether or not the labels show them (fixed values).
SEED_WORDS = ("bastard clown creep dimwit disgusting dumb fool garbage hate idiot idiotic imbecile jerk loser moron "
              "pathetic pig scum shut stupid sucks trash ugly vermin worthless").split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein tu te toi vous votre usted tú vos".split()
LEET = str.maketrans("013457@$!|", "oieastasii")
PREFIXES = (3, 4, 5, 6)
MIN_CLASS = 8
_WORD = re.compile(r"[^\W_]+(?:[*@$!|#][^\W_]+)*")
_SPACED = re.compile(r"(?<!\w)(?:\w[ .*_-]){3,}\w(?!\w)")
FEATURES = ["strong", "medium", "weak", "strong_hits", "top", "mean", "seed", "seed_hits", "hidden", "second_person", "near",
            "capitals", "shouted", "exclaim", "question", "punctuation", "symbols", "digits", "masked", "spaced",
            "repeats", "words", "word_length", "distinct"]


def units(word: str) -> list[str]:
    """A word as lexicon entries: itself and its beginnings (marked by a caret)."""
    return [word, *["^" + word[:k] for k in PREFIXES if len(word) >= k]]


@dataclass
class Lexicon:
    """Entry -> log-odds of toxic against other texts; words are looked up once per worker."""

    weights: dict[str, float]
    memory: dict | None = None

    def weight(self, word: str) -> float:
        if self.memory is None or len(self.memory) > 500_000:
            self.memory = {}
        w = self.memory.get(word)
        if w is None:
            w = self.memory[word] = max((self.weights.get(u, 0.0) for u in units(word)), default=0.0)
        return w

    def features(self, text: str | None) -> list[float]:
        raw = _WORD.findall(text or "")
        n = len(raw)
        if not n:
            return [0.0] * len(FEATURES)
        words = [w.lower() for w in raw]
        seeds, you = _SEEDS, _YOU
        counts = Counter(words)
        strong = medium = weak = total = seed = hidden = masked = 0
        top, kinds, seed_kinds, hits = 0.0, 0, 0, set()
        for w, c in counts.items():
            v = self.weight(w)
            if not w.isalpha():
                plain = w.translate(LEET).replace("*", "").replace("#", "")
                masked += c
                if plain in seeds or self.weight(plain) >= 3:
                    hidden += c
            if w in seeds:
                seed += c
                seed_kinds += 1
                hits.add(w)
            if v > 0:
                total += v * c
                top = max(top, v)
                if v >= 3:
                    strong += c
                    kinds += 1
                    hits.add(w)
                elif v >= 1.5:
                    medium += c
                else:
                    weak += c
        second = [i for i, w in enumerate(words) if w in you]
        near = sum(any(x in hits for x in words[max(0, i - 3):i + 4]) for i in second) if hits else 0
        chars = len(text)
        letters = sum(map(len, raw))
        upper = len(_UPPER.findall(text))
        shouted = sum(w.isupper() for w in raw if len(w) > 1)
        marks = len(_MARK.findall(text))
        return [strong / n, medium / n, weak / n, np.log1p(kinds), top, total / n, seed / n, np.log1p(seed_kinds), hidden / n,
                len(second) / n, near / n, upper / max(letters, 1), shouted / n, text.count("!") / n, text.count("?") / n,
                marks / chars, len(_SYMBOL.findall(text)) / chars, len(_DIGIT.findall(text)) / chars, masked / n,
                len(_SPACED.findall(text)) / n, len(_REPEAT.findall(text)) / n, np.log1p(n), letters / n, len(counts) / n]


_SEEDS, _YOU = frozenset(SEED_WORDS), frozenset(SECOND_PERSON)
_UPPER, _MARK = re.compile("[A-ZÀ-ÖØ-Þ]"), re.compile(r"[^\w\s]")
_SYMBOL, _DIGIT, _REPEAT = re.compile(r"[*@#$%&|^~]"), re.compile("[0-9]"), re.compile(r"(\w)\1{2,}")


def featurize(docs: DataFrame, lexicon: Lexicon, text_col: str, out: str = "x") -> DataFrame:
    """``docs`` (columns of any names) with the array of features."""
    own = [f"k_{i}" for i in range(len(docs.columns))]
    d = docs.toDF(*own)
    at = docs.columns.index(text_col)
    shipped = docs.sparkSession.sparkContext.broadcast(lexicon.weights)  # bounded by the lexicon's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = Lexicon(shipped.value)
        for b in batches:
            x = np.array([lex.features(t) for t in b.column(at).to_pylist()], np.float64).reshape(-1, len(FEATURES))
            rows = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES)), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, rows], [*own, "x"])

    types = ", ".join(f"{o} {d.schema[o].dataType.simpleString()}" for o in own)
    return d.mapInArrow(run, f"{types}, x array<double>").toDF(*docs.columns, out)


def learn_lexicon(rows: DataFrame, size: int = 2000, least_share: float = 0.01) -> Lexicon:
    """Entries of the texts ``t`` that mark label ``y`` = 1: frequent enough there, and far more than by chance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: tuple[Counter, Counter] = (Counter(), Counter())
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found[y].update({u for w in {w.lower() for w in _WORD.findall(t)} for u in units(w)})
            names = list(found[0].keys() | found[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([found[1][u] for u in names], pa.int64()),
                                              pa.array([found[0][u] for u in names], pa.int64())], ["u", "a", "b"])

    per = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    toxic, clean = per.get(1, 0), per.get(0, 0)
    counts = (rows.select("t", "y").mapInArrow(run, "u string, a long, b long")
              .groupBy("u").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
              .filter(F.col("a") >= max(2, least_share * toxic)))
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (toxic + 1 - a)) - F.log(b / (clean + 1 - b))
    spread = F.sqrt(1 / a + 1 / b + 1 / (toxic + 1 - a) + 1 / (clean + 1 - b))
    kept = counts.select("u", odds.alias("w"), (odds / spread).alias("z")).filter("w > 0.7 and z > 2.5")
    kept = kept.orderBy(F.desc("z"), "u").limit(size)  # the lexicon's size is a parameter of the model
    return Lexicon({r["u"]: r["w"] for r in kept.collect()})


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    isotonic: IsotonicRegressionModel | None
    prior: float = 0.0


def training_sample(docs: DataFrame, labels: DataFrame, sample: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(t, y, part): labelled texts, each once; at most about ``sample`` per class; part 0 to 2 by the text's hash."""
    marks = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id")).agg(
        (F.max(label_col) > 0).cast("int").alias("y"))
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    ids = d.select("id").distinct().join(marks, "id")
    sizes = {r["y"]: r["count"] for r in ids.groupBy("y").count().collect()}
    share = F.create_map(*[F.lit(v) for y in (0, 1) for v in (y, min(1.0, sample / max(1, sizes.get(y, 0))))])
    h = F.xxhash64(F.lit("toxicity"), "id")
    # about two times ``sample`` ids, as the shares say: small enough to send, so that no text moves
    chosen = stored(ids.filter(F.pmod(h, F.lit(1 << 30)) < share[F.col("y")] * (1 << 30)), "toxicity-ids")
    chosen = F.broadcast(chosen) if chosen.count() <= 4 * sample else chosen
    rows = d.join(chosen, "id").withColumn("h", F.xxhash64("t"))
    rows = rows.groupBy("h").agg(F.first("t").alias("t"), F.max("y").alias("y"))
    return stored(rows.withColumn("part", F.pmod(F.shiftright("h", 7), F.lit(10)).cast("int")), "toxicity-sample")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample: int = 8000, rounds: int = 20, depth: int = 4, step: float = 0.3) -> ToxicityModel:
    """Learn from the rows of ``docs`` that ``labels`` marks (0 or 1 in ``label_col``)."""
    rows = training_sample(docs, labels, sample, id_col, text_col, label_col)
    per = {}
    for r in rows.groupBy(F.when(F.col("part") < 4, 0).when(F.col("part") < 8, 1).otherwise(2).alias("p"), "y").count().collect():
        per[r["p"], r["y"]] = r["count"]
    toxic, clean = (sum(n for (_, y), n in per.items() if y == k) for k in (1, 0))
    if not toxic or not clean:
        return ToxicityModel(Lexicon({}), None, None, float(toxic > 0))
    parts = [F.col("part") < 4, F.col("part").between(4, 7), F.col("part") > 7]
    if min(per.get((p, y), 0) for p in range(3) for y in (0, 1)) < MIN_CLASS:
        parts = [F.lit(True)] * 3
    lexicon = learn_lexicon(rows.filter(parts[0]))
    x = featurize(rows, lexicon, "t")
    x = stored(x.select(array_to_vector("x").alias("features"), F.col("y").cast("double").alias("label"), "part"), "toxicity-features")
    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=step, maxBins=64, minInstancesPerNode=3, seed=7).fit(x.filter(parts[1]))
    raw = trees.transform(x.filter(parts[2])).select("label", vector_to_array("probability")[1].alias("raw"))
    isotonic = IsotonicRegression(featuresCol="raw").fit(raw)
    return ToxicityModel(lexicon, trees, isotonic, toxic / (toxic + clean))


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the calibrated probability of label 1.

    Inside one step of the isotonic function a thousandth of the trees' own probability orders the rows.
    """
    others = [c for c in docs.columns if c != out]
    if model.trees is None:
        return docs.select(*[F.col(f"`{c}`") for c in others], F.lit(model.prior).alias(out))
    own = [f"k_{i}" for i in range(len(others))]
    d = featurize(docs.select(*[F.col(f"`{c}`") for c in others]), model.lexicon, text_col).toDF(*own, "x")
    d = d.withColumn("features", array_to_vector("x")).drop("x")
    d = model.trees.transform(d).withColumn("raw", vector_to_array("probability")[1])
    d = model.isotonic.setPredictionCol("calibrated").transform(d)
    s = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("calibrated"))) * 0.999 + F.col("raw") * 0.001
    return d.select(*[F.col(o).alias(c) for c, o in zip(others, own, strict=True)], s.alias(out))
