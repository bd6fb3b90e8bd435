"""AdaBoost (SAMME, two classes) over weighted one-cut trees.

A row's weight is a function of the stumps so far, so nothing is kept per row: a round needs one
sum of weights per (feature, bin, class), and the best cut by Gini impurity, its error and its vote
all follow from these sums.  A matrix that fits a task is boosted there, all rounds in one job; a
larger one is read once a round, by one job whose sums are added up in Spark (at most features x 256 x 2
rows reach the driver).  Weights are rounded to 2^-24 of their mean, so sums are integers and both ways
give the same stumps, however rows are dealt.

A missing value (NaN) goes to the right of every cut.  Boosting ends early where no stump is better than
chance, or where one makes no error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewise.operators import binned

SCALE = float(1 << 24)
CODES = 256
LEAST_ERROR = 1e-10

#: feature, last bin on the left, class on the left, class on the right, vote
Stump = tuple[int, int, int, int, float]


def misses(x: np.ndarray, y: np.ndarray, stump: Stump) -> np.ndarray:
    f, last, left, right, _ = stump
    return np.where(x[:, f] <= last, left, right) != y


def sums(x: np.ndarray, y: np.ndarray, log_weight: np.ndarray, level: float) -> np.ndarray:
    """Whole weights per (feature, bin, class); ``level`` is the log of the mean weight."""
    w = np.rint(np.exp(log_weight - level) * SCALE).astype(np.int64)
    out = np.zeros((x.shape[1], CODES, 2), np.int64)
    for f in range(x.shape[1]):
        np.add.at(out[f], (x[:, f], y), w)
    return out


def next_stump(h: np.ndarray) -> tuple[Stump | None, float, bool]:
    """(best stump, log of the mean weight's growth, whether boosting goes on); None if nothing beats chance."""
    total = h[0].sum(0) if len(h) else np.zeros(2, np.int64)
    if not total.sum():
        return None, 0.0, False
    left = np.cumsum(h, 1).astype(np.float64)
    right = total - left
    a, b = left.sum(2), right.sum(2)
    purity = np.where((a > 0) & (b > 0), (left**2).sum(2) / np.maximum(a, 1) + (right**2).sum(2) / np.maximum(b, 1), -1.0)
    f, last = np.unravel_index(int(purity.argmax()), purity.shape)
    if purity[f, last] < 0:  # no cut parts the rows
        f, last = 0, CODES - 1
    sides = left[f, last], right[f, last]
    classes = [int(s[1] > s[0]) for s in sides]
    error = sum(s.min() for s in sides) / total.sum()
    if error >= 0.5:
        return None, 0.0, False
    vote = math.log((1 - max(error, LEAST_ERROR)) / max(error, LEAST_ERROR))
    return (int(f), int(last), *classes, vote), math.log((1 - error) + error * math.exp(vote)), error > LEAST_ERROR


def _held(m: binned.Matrix, rounds: int) -> list[Stump]:
    """All rounds in one task."""
    width = m.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(binned.cells(b.column(1), "uint8", width), b.column(0).to_numpy()) for b in batches if len(b)]
        stumps, level = [], 0.0
        if parts:
            x, y = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            log_weight = np.zeros(len(y))
            while len(stumps) < rounds:
                stump, grown, go_on = next_stump(sums(x, y, log_weight, level))
                if stump is not None:
                    stumps.append(stump)
                    log_weight += stump[4] * misses(x, y, stump)
                    level += grown
                if not go_on:
                    break
        names = ["f", "last", "l", "r", "vote"]
        kinds = [pa.int64()] * 4 + [pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array([s[i] for s in stumps], k) for i, k in enumerate(kinds)], names)
    found = m.rows.select("y", "x").coalesce(1).mapInArrow(run, "f long, last long, l long, r long, vote double")
    return [tuple(r) for r in found.collect()]  # a row per round


def _passes(m: binned.Matrix, rounds: int) -> list[Stump]:
    """One job a round over the stored matrix."""
    width, stumps, level = m.width, [], 0.0
    while len(stumps) < rounds:
        known, at = list(stumps), level

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((width, CODES, 2), np.int64)
            for b in batches:
                x, y = binned.cells(b.column(1), "uint8", width), b.column(0).to_numpy()
                log_weight = np.zeros(len(y))
                for s in known:
                    log_weight += s[4] * misses(x, y, s)
                out += sums(x, y, log_weight, at)
            cell = np.flatnonzero(out)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(out.ravel()[cell])], ["cell", "w"])
        got = m.rows.select("y", "x").mapInArrow(run, "cell long, w long").groupBy("cell").agg(F.sum("w").alias("w")).collect()
        h = np.zeros(width * CODES * 2, np.int64)
        for r in got:
            h[r["cell"]] = r["w"]
        stump, grown, go_on = next_stump(h.reshape(width, CODES, 2))
        if stump is not None:
            stumps.append(stump)
            level += grown
        if not go_on:
            break
    return stumps


def fit(df: DataFrame, features: str, label: str, rounds: int, seed: int = 42, id_col: str = "case_id") -> list[tuple]:
    """(feature, cut, class up to the cut, class beyond it, vote) of each round."""
    bins = binned.Bins.fit(df, features, seed=seed)
    m = binned.matrix(df, features, label, id_col, bins, len(bins.cuts))
    stumps = _held(m, rounds) if m.held else _passes(m, rounds)
    cut_of = [[*map(float, c), math.inf] for c in bins.cuts]
    return [(f, cut_of[f][min(last, len(cut_of[f]) - 1)], left, right if last < CODES - 1 else left, vote) for f, last, left, right, vote in stumps]


def score(df: DataFrame, features: str, stumps: list[tuple]) -> DataFrame:
    """``df`` with the share of the votes for class 1 (0.5 without stumps), in one projection."""
    if not stumps:
        return df.withColumn("score", F.lit(0.5))
    total = sum(s[4] for s in stumps)
    votes = F.lit(0.0)
    for f, cut, left, right, vote in stumps:
        votes = votes + F.when(F.col("__v")[f] <= F.lit(cut), F.lit(vote * left)).otherwise(F.lit(vote * right))
    return df.withColumn("__v", binned.as_array(df, features)).withColumn("score", votes / F.lit(total)).drop("__v")
