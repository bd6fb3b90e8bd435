"""Support vector machine with an RBF kernel (M7): Nystroem features, squared hinge, Platt's scaling.

Landmarks are the rows with the lowest hashes, at most ``landmarks`` of them (all rows of a small table:
the machine is then the exact kernel machine).  With the landmarks' kernel matrix K = V diag(e) V',
a row's features are k(row, landmarks) V diag(e)^-1/2, whose products reproduce the kernel on the span of
the landmarks.  The squared hinge is minimised by Newton's method: every step is one Spark job that adds up
the gradient and Hessian over the rows inside the margin (landmarks squared numbers, whatever the
number of rows).  Probabilities are a logistic curve over the margins of rows that a first fit did not see.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewise.operators.binned import as_array, dense, stored, width_of

#: Eigenvalues below this share of the largest are noise.
LEAST = 1e-12


def kernel(x: np.ndarray, landmarks: np.ndarray, gamma: float) -> np.ndarray:
    far = (x * x).sum(1)[:, None] + (landmarks * landmarks).sum(1) - 2 * x @ landmarks.T
    return np.exp(-gamma * np.maximum(far, 0))


@dataclass
class Map:
    """The feature map: landmarks, kernel width and the matrix that follows the kernel."""
    landmarks: np.ndarray
    gamma: float
    after: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([kernel(x, self.landmarks, self.gamma) @ self.after, np.ones(len(x))])

    @classmethod
    def of(cls, landmarks: np.ndarray, gamma: float) -> Map:
        e, v = np.linalg.eigh(kernel(landmarks, landmarks, gamma))
        keep = e > LEAST * max(e.max(initial=0), 1e-300)
        return cls(landmarks, gamma, v[:, keep] / np.sqrt(e[keep]))


def _summed(rows: DataFrame, size: int, part) -> np.ndarray:
    """``part(x, y)`` (an array of ``size`` numbers) added up over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            total += part(b)
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["g", "sums"])

    def add(parts: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_py()) for v in parts.column("sums"))
        return pa.table({"g": pa.array([0], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})
    # partial sums meet in a few tasks, then in one: a sum a task, never a row
    schema = "g int, sums binary"
    halves = rows.mapInArrow(run, schema).withColumn("g", F.spark_partition_id() % 16)
    once = halves.groupBy("g").applyInArrow(add, schema).withColumn("g", F.lit(0))
    got = once.groupBy("g").applyInArrow(add, schema).first()
    return np.zeros(size) if got is None else np.frombuffer(got.sums)


def _newton(rows: DataFrame, width: int, phi: Map, penalty: float, steps: int = 50) -> np.ndarray:
    """Weights (the last one is the bias, not penalised) of least |w|^2 / 2 + penalty x squared hinge."""
    m = phi.after.shape[1] + 1
    ridge = np.append(np.ones(m - 1), 1e-9)

    def gradient_and_hessian(w: np.ndarray):
        def part(b: pa.RecordBatch) -> np.ndarray:
            f, y = phi(dense(b.column(0), width)), 2.0 * b.column(1).to_numpy() - 1
            slack = 1 - y * (f @ w)
            inside = slack > 0
            f, s, y = f[inside], slack[inside], y[inside]
            return np.concatenate([(-2 * penalty * (y * s)) @ f, (2 * penalty * (f.T @ f)).ravel(), [penalty * (s * s).sum()]])
        got = _summed(rows, m + m * m + 1, part)
        return got[:m] + ridge * w, got[m:-1].reshape(m, m) + np.diag(ridge), got[-1] + 0.5 * (ridge * w * w).sum()

    def loss(w: np.ndarray) -> float:
        def part(b: pa.RecordBatch) -> np.ndarray:
            slack = np.maximum(0, 1 - (2.0 * b.column(1).to_numpy() - 1) * (phi(dense(b.column(0), width)) @ w))
            return np.array([penalty * (slack * slack).sum()])
        return float(_summed(rows, 1, part)[0]) + 0.5 * float((ridge * w * w).sum())

    w = np.zeros(m)
    for _ in range(steps):
        g, h, now = gradient_and_hessian(w)
        if np.abs(g).max() <= 1e-7 * max(1.0, penalty):
            break
        step, size = np.linalg.solve(h, -g), 1.0
        while size > 1e-6 and loss(w + size * step) > now + 1e-4 * size * (g @ step):
            size /= 2
        w = w + size * step
    return w


@dataclass
class KernelSvcModel:
    """Map, weights and the logistic curve; ``score`` adds the probability of class 1."""
    phi: Map
    w: np.ndarray
    slope: float
    level: float
    width: int
    features: str = "features"

    def margin(self, vector: Column) -> Column:
        phi, w, width = self.phi, self.w, self.width

        @F.arrow_udf("double")
        def run(x: pa.Array) -> pa.Array:
            return pa.array(phi(dense(x, width)) @ w)
        return run(vector)

    def transform(self, df: DataFrame) -> DataFrame:
        m = self.margin(as_array(df, self.features))
        return df.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(self.slope) * m + F.lit(self.level)))))

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        meta = {"gamma": self.phi.gamma, "w": self.w.tolist(), "slope": self.slope, "level": self.level, "width": self.width,
                "features": self.features}
        rows = [(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(self.phi.landmarks, self.phi.after, strict=True))]
        spark.createDataFrame(rows, "i int, landmark array<double>, after array<double>").write.mode("overwrite").parquet(f"{path}/landmarks")
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> KernelSvcModel:
        meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
        rows = spark.read.parquet(f"{path}/landmarks").orderBy("i").collect()  # a model: one row a landmark
        phi = Map(np.array([r.landmark for r in rows]), meta["gamma"], np.array([r.after for r in rows]))
        return cls(phi, np.array(meta["w"]), meta["slope"], meta["level"], meta["width"], meta["features"])


def _platt(rows: DataFrame, width: int, phi: Map, w: np.ndarray) -> tuple[float, float]:
    """Slope and level of the logistic curve over the margins, with Platt's smoothed targets, by Newton's method."""
    n = rows.agg(F.sum("y").alias("p"), F.count("*").alias("n")).first()
    pos, neg = int(n.p or 0), n.n - int(n.p or 0)
    high, low = (pos + 1) / (pos + 2), 1 / (neg + 2)
    a = np.array([1.0, np.log((pos + 1) / (neg + 1))])
    for _ in range(30):
        def part(b: pa.RecordBatch) -> np.ndarray:
            f = phi(dense(b.column(0), width)) @ w
            x, t = np.column_stack([f, np.ones(len(f))]), np.where(b.column(1).to_numpy() == 1, high, low)
            p = 1 / (1 + np.exp(-(x @ a)))
            return np.concatenate([(p - t) @ x, ((x.T * (p * (1 - p))) @ x).ravel()])
        got = _summed(rows, 6, part)
        step = np.linalg.solve(got[2:].reshape(2, 2) + 1e-9 * np.eye(2), got[:2])
        a = a - step * min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-9:
            break
    return float(a[0]), float(a[1])


def fit(df: DataFrame, C: float = 1.0, gamma: float | None = None, landmarks: int = 512, features: str = "features", label: str = "label",
        id_col: str = "case_id", seed: int = 42, held_out: float = 0.2) -> KernelSvcModel:
    """``gamma`` defaults to 1 / (features x variance of all values)."""
    width = width_of(df, features)
    key = F.xxhash64(F.lit(seed), F.col(id_col).cast("string")) if id_col in df.columns else F.xxhash64(F.lit(seed), as_array(df, features))
    rows = stored(df.select(as_array(df, features).alias("x"), F.col(label).cast("int").alias("y"), key.alias("h")), "svc")
    if gamma is None:
        flat = rows.select(F.explode("x").alias("v")).agg(F.var_pop("v").alias("v")).first()["v"]
        gamma = 1.0 / (width * flat) if flat else 1.0
    chosen = rows.orderBy("h").limit(landmarks).select("x").toArrow().column("x").combine_chunks()  # at most ``landmarks`` rows
    phi = Map.of(dense(chosen, width), gamma)
    narrow = rows.select("x", "y", "h")
    seen = narrow.filter(F.pmod(F.xxhash64("h"), F.lit(1000)) >= int(1000 * held_out)).drop("h")
    unseen = narrow.filter(F.pmod(F.xxhash64("h"), F.lit(1000)) < int(1000 * held_out)).drop("h")
    slope, level = _platt(unseen, width, phi, _newton(seen, width, phi, C))
    return KernelSvcModel(phi, _newton(narrow.drop("h"), width, phi, C), slope, level, width, features)
