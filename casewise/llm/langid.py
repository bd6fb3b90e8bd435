"""Language identification by string kernels.

A text becomes the set of its character n-grams of lengths 1 to 3 (a blended spectrum;
lower case, runs of non-letters are one boundary mark).  The kernel of two texts is the
number of n-grams they share, divided by the root of the product of their counts.

* Nystroem landmarks: ``landmarks`` training texts, equally many per language, span the
  feature space.  Only n-grams of landmarks can be shared with one, so they are the
  vocabulary; counts are taken over it.
* One-versus-rest kernel ridge regression on the landmarks: the normal equations are
  sums over training rows, added up per partition and then, a task per landmark's row, over partitions.
* Scoring: a batch of texts is a 0/1 matrix, one product with the landmark matrix gives
  all kernels, another one all scores.

The model is fitted on at most ``sample`` training rows (chosen by a hash of the text,
so it does not depend on partitioning); each row of the table is scored whole.

Defined edge cases: ``und`` with score 0 for null texts and texts without a letter, and
for all texts if nothing could be learned; repeated rows, null ids and further columns
(whatever their names) pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casewise.llm.common import stored, worker_state

UNKNOWN = "und"
OWN, SHARED = 96, 31  # symbols for the commonest letters, and for the other letters by blocks
BASE = 1 + OWN + SHARED
ROWS = 128


def _letter_table() -> np.ndarray:
    """1 for each code point that is a letter."""
    return np.frombuffer(bytes(unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), np.uint8)


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)


@dataclass
class KernelModel:
    """Vocabulary, landmarks and weights; ``scores`` needs nothing else."""

    letters: list[int]
    languages: list[str]
    vocabulary: np.ndarray = None  # n-gram codes, ascending
    landmarks: np.ndarray = None  # vocabulary x landmarks, 0/1 bytes
    root_count: np.ndarray = None
    weights: np.ndarray = None  # landmarks x languages
    made: dict = field(default_factory=dict, compare=False)

    def parts(self) -> dict:
        """The model as lists and arrays, which any worker can read."""
        return {k: v for k, v in self.__dict__.items() if k != "made"}

    def symbols(self, text: str) -> np.ndarray:
        """Symbol of each letter, 0 for a boundary; boundaries are never side by side, and one stands at each end."""
        if "table" not in self.made:
            is_letter = worker_state("letters", _letter_table)
            table = (1 + OWN + (np.arange(0x110000) >> 7) % SHARED).astype(np.int32) * is_letter
            table[self.letters] = 1 + np.arange(len(self.letters))
            self.made["table"] = table
        s = np.concatenate([[0], self.made["table"][points(text)], [0]])
        return s[(s > 0) | np.concatenate([[True], s[:-1] > 0])]

    def codes(self, text: str) -> np.ndarray:
        """Codes of all n-grams of lengths 1 to 3, repeats included; none if there is no letter."""
        s = self.symbols(text)
        if len(s) < 3:
            return np.empty(0, np.int64)
        two = (s[:-1] * BASE + s[1:]) + BASE
        three = (s[:-2] * BASE + s[1:-1]) * BASE + s[2:] + BASE + BASE * BASE
        return np.concatenate([s, two, three])

    def matrix(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(0/1 rows over the vocabulary, whether the text has a letter)."""
        if "place" not in self.made:
            place = np.full(BASE + BASE * BASE + BASE**3, len(self.vocabulary), np.int32)
            place[self.vocabulary] = np.arange(len(self.vocabulary))
            self.made["place"] = place
        x = np.zeros((len(texts), len(self.vocabulary) + 1), np.float32)
        has = np.zeros(len(texts), bool)
        for i, t in enumerate(texts):
            c = self.codes(t or "")
            has[i] = len(c)
            x[i, self.made["place"][c]] = 1
        return x[:, :-1], has

    def kernels(self, x: np.ndarray) -> np.ndarray:
        if "marks" not in self.made:
            self.made["marks"] = self.landmarks.astype(np.float32)
        return (x @ self.made["marks"]) / (np.sqrt(np.maximum(x.sum(1), 1))[:, None] * self.root_count)

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        x, has = self.matrix(texts)
        return self.kernels(x) @ self.weights, has


def _quota(sizes: list[int], n: int) -> float:
    """The q for which the sum of min(size, q) is ``n``: what small classes leave over goes to the larger ones."""
    left = n
    for k, size in enumerate(sizes := sorted(sizes)):
        if size * (len(sizes) - k) >= left:
            return left / (len(sizes) - k)
        left -= size
    return math.inf


def _by_hash(rows: DataFrame, n: int, text: str, label: str) -> DataFrame:
    """About ``n`` texts, of each label those whose hashes lowest, one at least; all rows, if there are no more than ``n``."""
    h = F.pmod(F.xxhash64(F.lit("sample"), F.col(text)), F.lit(1 << 30))
    found = rows.groupBy(label).agg(F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64(text)).alias("texts"), F.min(h).alias("least")).collect()
    if sum(r["n"] for r in found) <= n:
        return rows
    sizes = {r[label]: min(r["n"], r["texts"]) for r in found}
    q = _quota(list(sizes.values()), n)
    cuts = [(r[label], max(r["least"] + 1, int(min(1.0, q / sizes[r[label]]) * (1 << 30)))) for r in found]
    cuts = rows.sparkSession.createDataFrame(cuts, f"{label} string, cut long")
    return rows.join(F.broadcast(cuts), label).filter(h < F.col("cut")).select(*rows.columns)  # a row per language


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", landmarks: int = 256,
        sample: int = 8000, ridge: float = 1e-4, max_languages: int | None = None) -> KernelModel | None:
    """Learn from rows with a language and a letter; None if there are none.

    ``sample`` bounds the rows that are used, shared out over the languages, so that every
    language that occurs is learned at any size.  ``max_languages`` keeps only the commonest.
    """
    train = train.select(F.col(f"`{text_col}`").alias("t"), F.col(f"`{lang_col}`").alias("l")).filter("t is not null and l is not null")
    train = train.filter(F.col("t").rlike(r"\p{L}"))  # a text without a letter teaches nothing and takes no landmark's place
    rows = _by_hash(train.withColumn("l", F.col("l").cast("string")), sample, "t", "l").groupBy(F.xxhash64("t").alias("h"), "l").agg(F.first("t").alias("t"))
    rows = stored(rows, "langid-sample")
    seen = [r["l"] for r in rows.groupBy("l").count().orderBy(F.desc("count"), "l").collect()][:max_languages]
    if not seen:
        return None
    languages = sorted(seen)
    rows = rows.filter(F.col("l").isin(languages))
    per = max(1, landmarks // len(languages))
    by_lang = F.row_number().over(Window.partitionBy("l").orderBy("h", "t"))
    picked = rows.withColumn("r", by_lang).filter(F.col("r") <= per).orderBy("l", "h", "t").collect()
    is_letter = _letter_table()
    common = Counter()
    for r in picked:
        p = points(r["t"])
        common.update(p[is_letter[p] > 0].tolist())
    if not common:
        return None
    model = KernelModel([c for c, _ in sorted(common.items(), key=lambda x: (-x[1], x[0]))[:OWN]], languages)
    grams = [np.unique(model.codes(r["t"])) for r in picked]
    model.vocabulary = np.unique(np.concatenate(grams))
    marks = [g for g in grams if len(g)]
    m = np.zeros((len(model.vocabulary), len(marks)), np.float32)
    for j, g in enumerate(marks):
        m[np.searchsorted(model.vocabulary, g), j] = 1
    model.landmarks, model.root_count = m.astype(np.uint8), np.sqrt(m.sum(0))
    shipped = rows.sparkSession.sparkContext.broadcast(model.parts())  # bounded: landmarks x vocabulary
    size, k = len(marks), len(languages)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = KernelModel(**shipped.value)
        gram, right, n = np.zeros((size, size)), np.zeros((size, k)), 0
        for b in batches:
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            for at in range(0, len(texts), ROWS):
                x, has = model.matrix(texts[at:at + ROWS])
                z = model.kernels(x[has]).astype(np.float64)
                y = np.array([[1.0 if g == lang else -1.0 for g in languages] for lang in langs[at:at + ROWS]])[has]
                gram, right, n = gram + z.T @ z, right + z.T @ y, n + len(z)
        if n:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(size), pa.int32()), pa.array([part] * size, pa.int32()), pa.array([n] * size, pa.int64()),
                 pa.array([x.tobytes() for x in gram], pa.binary()), pa.array([x.tobytes() for x in right], pa.binary())],
                ["i", "part", "n", "gram", "right"])

    def total(parts: pd.DataFrame) -> pd.DataFrame:
        """One landmark's row of the sums, added up in the order of the partitions."""
        parts = parts.sort_values("part")
        added = {c: [sum(map(np.frombuffer, parts[c])).tobytes()] for c in ("gram", "right")}
        return pd.DataFrame({"i": parts["i"].iloc[:1].to_numpy(), "n": [parts["n"].sum()], **added})

    # one sum of fixed size reaches the driver, whatever the number of partitions
    parts = rows.select("t", "l").repartition(16, "t").mapInArrow(sums, "i int, part int, n long, gram binary, right binary")
    gram, right, n = np.zeros((size, size)), np.zeros((size, k)), 0
    for r in parts.groupBy("i").applyInPandas(total, "i int, n long, gram binary, right binary").collect():
        gram[r["i"]], right[r["i"]], n = np.frombuffer(r["gram"]), np.frombuffer(r["right"]), r["n"]
    own = (m.T @ m / np.outer(model.root_count, model.root_count)).astype(np.float64)
    model.weights = np.linalg.solve(gram + ridge * n * own + 1e-6 * n * np.eye(size), right).astype(np.float32)
    return model


def predict(docs: DataFrame, model: KernelModel | None, text_col: str = "text", pred: str = "lang_pred",
            score: str = "score") -> DataFrame:
    """``docs`` with the predicted language and a score in 0 to 1 (the best class's, 0.5 is undecided)."""
    spark = docs.sparkSession
    others = [c for c in docs.columns if c not in (pred, score)]
    own = [f"k_{i}" for i in range(len(others))]
    d = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(others, own, strict=True)])
    if model is None:
        out = d.select("*", F.lit(UNKNOWN).alias("p"), F.lit(0.0).alias("s"))
    else:
        at = others.index(text_col)
        shipped = spark.sparkContext.broadcast(model.parts())  # bounded: landmarks x vocabulary

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = KernelModel(**shipped.value)
            names = np.array([*m.languages, UNKNOWN], object)
            for b in batches:
                texts = b.column(at).to_pylist()
                best, value = [], []
                for x in range(0, len(texts), ROWS):
                    f, has = m.scores(texts[x:x + ROWS])
                    top = np.where(has, f.argmax(1), len(m.languages))
                    best.append(top)
                    value.append(np.where(has, np.clip((1 + f.max(1)) / 2, 0, 1), 0.0))
                p = pa.array(names[np.concatenate(best)] if best else [], pa.string())
                v = pa.array(np.concatenate(value).astype(np.float64) if value else [], pa.float64())
                yield pa.RecordBatch.from_arrays([*b.columns, p, v], [*own, "p", "s"])
        types = ", ".join(f"{o} {d.schema[o].dataType.simpleString()}" for o in own)
        out = d.mapInArrow(run, f"{types}, p string, s double")
    return out.select(*[F.col(o).alias(c) for c, o in zip(others, own, strict=True)], F.col("p").alias(pred), F.col("s").alias(score))
