"""The matrix that tree learners read: one binary row of codes (or floats) per record.

Numbers become codes of at most ``MAX_BINS`` quantile bins, cut on a bounded sample of rows (all of
them up to ``SAMPLE``); a missing value has a code of its own.  A table of at most ``HELD`` cells is
handed to tasks whole; a larger one stays a stored table, and every pass over it is a Spark job.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewise.session import checkpoint_dir

MAX_BINS = 255
MISSING = 255
#: Rows that the cuts are taken from.
SAMPLE = 200_000
#: Cells (rows times features) up to which a task may hold a matrix: 64 MB of codes or 256 MB of floats.
HELD = 1 << 26


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/trees/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_array(df: DataFrame, features: str):
    """The feature column as array<double>, whether it is an ML vector or an array."""
    return F.col(features) if df.schema[features].dataType.typeName() == "array" else vector_to_array(features)


def dense(col: pa.Array, width: int) -> np.ndarray:
    """A list column of equal lengths as a matrix of doubles; null elements are NaN."""
    flat = col.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), width)


def cells(col: pa.Array, dtype, width: int) -> np.ndarray:
    """A binary column of equal lengths as a matrix, without a copy per row."""
    size = width * np.dtype(dtype).itemsize
    if not len(col) or not size:
        return np.zeros((len(col), width), dtype)
    start = np.frombuffer(col.buffers()[1], np.int32)[col.offset]
    return np.frombuffer(col.buffers()[2], dtype, count=len(col) * width, offset=int(start)).reshape(-1, width)


def binary(x: np.ndarray) -> pa.Array:
    """A matrix as a binary column, one value per row."""
    size = x.shape[1] * x.dtype.itemsize
    offsets = np.arange(len(x) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(x).tobytes())])


@dataclass
class Bins:
    """Cuts of every feature; a value belongs to the first bin whose cut is not below it."""
    cuts: list

    def codes(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for f, cut in enumerate(self.cuts):
            out[:, f] = np.searchsorted(cut, x[:, f], "left")
        out[np.isnan(x)] = MISSING
        return out

    @classmethod
    def fit(cls, df: DataFrame, features: str, max_bins: int = MAX_BINS, seed: int = 42) -> Bins:
        vec = df.select(as_array(df, features).alias("x"))
        if df.count() > SAMPLE:
            vec = vec.orderBy(F.xxhash64(F.lit(seed), "x")).limit(SAMPLE)
        got = vec.toArrow().column("x").combine_chunks()  # at most SAMPLE rows
        x = dense(got, len(got[0]) if len(got) else 0)
        cuts = []
        for f in range(x.shape[1]):
            v = np.unique(x[~np.isnan(x[:, f]), f])
            if len(v) > max_bins:
                v = np.unique(np.quantile(x[~np.isnan(x[:, f]), f], np.linspace(0, 1, max_bins + 1)[1:-1], method="averaged_inverted_cdf"))
                cuts.append(v)
            else:
                cuts.append((v[:-1] + v[1:]) / 2)
        return cls(cuts)


@dataclass
class Matrix:
    """Stored rows (uid long, y int, x binary) with their width and count."""
    rows: DataFrame
    width: int
    n: int
    dtype: str

    @property
    def held(self) -> bool:
        return self.n * max(1, self.width) <= HELD

    def collect(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(uid, y, x) of a table that is small enough to be held."""
        if not self.held:
            raise ValueError("the matrix is too large to be held")
        t = self.rows.select("uid", "y", "x").toArrow().combine_chunks()
        if not t.num_rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, self.width), self.dtype)
        uid, y, x = t.column("uid").to_numpy(), t.column("y").to_numpy().astype(np.int64), cells(t.column("x").combine_chunks(), self.dtype, self.width)
        order = np.argsort(uid, kind="stable")
        return uid[order], y[order], x[order]


def matrix(df: DataFrame, features: str, label: str, id_col: str, bins: Bins | None, width: int, tags: list[str] | None = None) -> Matrix:
    """Codes (with ``bins``) or 32-bit floats of every row; ``tags`` are further columns to keep."""
    tags = tags or []
    uid = F.xxhash64(F.col(id_col).cast("string")) if id_col in df.columns else F.xxhash64(as_array(df, features))
    src = df.select(uid.alias("uid"), F.col(label).cast("int").alias("y"), as_array(df, features).alias("x"), *tags)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = dense(b.column(2), width)
            x = bins.codes(x) if bins else x.astype(np.float32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), binary(x), *b.columns[3:]], ["uid", "y", "x", *tags])
    more = "".join(f", {t} {df.schema[t].dataType.simpleString()}" for t in tags)
    rows = stored(src.mapInArrow(run, f"uid long, y int, x binary{more}"), "matrix")
    return Matrix(rows, width, rows.count(), "uint8" if bins else "float32")


def width_of(df: DataFrame, features: str) -> int:
    first = df.select(F.size(as_array(df, features)).alias("n")).first()
    return 0 if first is None else int(first["n"])
