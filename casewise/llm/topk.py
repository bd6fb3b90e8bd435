"""Exact top-k inner-product search by Fagin's threshold algorithm.

Vectors are rounded to integers (floor of ``scale`` times each component), so that scores
are exact.  The table is cut into blocks by a hash; in a block every dimension has a list
of the block's vectors sorted by that component.  For a query the lists are read side by
side, from the end that its component favours; every vector that comes up gets its full
score.  What has not come up yet can score at most the query's product with the values
at the current depth.  When that bound cannot beat the k-th best score found (ties need
a smaller id, so an equal bound goes on), the block is done.  Depths double, and queries
of a chunk share the products for bounds and scores.

The k best of each block and query meet in one aggregation per query.

Queries are a stated set; block and query chunk are one row each, so that a pair of them
is a bounded piece of work and nothing grows with the table inside a task.

Scores are exact at any size of the components: where a pair's products may pass a long,
its score is summed in Python integers.  A component or a score that does not fit a long
is an error.

Defined edge cases: a vector that is null or holds a null or non-finite component takes no
part, and neither does a row without id; vectors of different lengths do not meet; equal rows count as often as they occur, as candidates,
but one of a query's own row is left out, and equal queries answer once; ties go to the
smaller id; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casewise.llm.common import stored

BLOCK = 8192
CHUNK = 512
#: Integer components up to this size keep scores of up to 127 dimensions inside a long; larger ones are checked pair by pair.
LARGEST = 1 << 28


def integers(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v, n): distinct integer vectors with the number of equal rows."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    large = F.raise_error(F.lit(f"a component times {scale} does not fit a long"))
    v = F.transform(x, lambda c: F.when(F.abs(c * scale) < float(1 << 63), F.floor(c * scale)).otherwise(large))
    fit = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    d = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.when(x.isNotNull() & F.coalesce(fit, F.lit(False)), v).alias("v"))
    d = d.filter("id is not null and v is not null")
    return d.groupBy("id", "v").agg(F.count("*").alias("n"))


def _packed(rows: DataFrame, key: list[str], size: int) -> DataFrame:
    """One row per ``key``: the ids, counts and vectors of its rows, as binary columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, counts, vectors = None, [], [], []

        def out():
            cols = [np.array(ids, np.int64), np.array(counts, np.int64), np.array(vectors, np.int64)]
            return pa.RecordBatch.from_arrays(
                [pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()), *[pa.array([c.tobytes()], pa.binary()) for c in cols]],
                ["dim", "part", "ids", "counts", "vectors"])
        for b in batches:
            for dim, part, i, n, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if now is not None and (now != (dim, part) or len(ids) >= size):
                    yield out()
                    ids, counts, vectors = [], [], []
                now = (dim, part)
                ids.append(i)
                counts.append(n)
                vectors.append(v)
        if ids:
            yield out()
    return (rows.select("dim", "part", "id", "n", "v").repartition(*key).sortWithinPartitions("dim", "part", "id")
            .mapInArrow(run, "dim int, part int, ids binary, counts binary, vectors binary"))


class Block:
    """A block's vectors with one sorted list per dimension."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, vectors: np.ndarray):
        self.ids, self.counts, self.raw = ids, counts, vectors
        self.largest = int(np.abs(vectors.astype(np.int64)).max(initial=0))
        self.order = np.argsort(vectors, axis=0, kind="stable")
        n = len(ids)
        self.depths = [min(n, 1 << s) for s in range(5, 64) if 1 << (s - 1) < n] or [n]

    def search(self, q_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, scores, counts) of the best rows for each query: k rows, counts included, if there are."""
        ids, order, depths = self.ids, self.order, self.depths
        n, dims = self.raw.shape
        reach = [dims * self.largest * int(a) for a in np.abs(queries.astype(np.int64)).max(1, initial=0)]
        if max(reach, default=0) >= 1 << 63:
            for i in range(len(queries)):
                yield self.exact(q_ids[i], queries[i], k) if reach[i] >= 1 << 63 else next(self.search(q_ids[i:i + 1], queries[i:i + 1], k))
            return
        # doubles while sums stay below 2 ** 53, else 64-bit integers
        kind = np.float64 if max(reach, default=0) < 1 << 53 else np.int64
        none = np.iinfo(np.int64).min
        x, q = self.raw.astype(kind), queries.astype(kind)
        pos, neg = np.maximum(q, 0), np.minimum(q, 0)
        up = np.take_along_axis(x, order, 0)
        bounds = np.stack([pos @ up[n - d] + neg @ up[d - 1] for d in depths], 1)
        for i in range(len(q)):
            weight = self.counts.copy()
            own = np.flatnonzero(ids == q_ids[i])
            weight[own] -= (self.raw[own] == queries[i]).all(1)  # one of the query's own row is no candidate
            seen, score = np.zeros(n, bool), np.full(n, none, kind)
            high, low = np.flatnonzero(q[i] > 0), np.flatnonzero(q[i] < 0)
            before = 0
            for step, depth in enumerate(depths):
                if depth == n or 2 * np.count_nonzero(seen) > n:
                    new = np.flatnonzero(~seen)  # most have come up: score the rest as well
                else:
                    fresh = np.zeros(n, bool)
                    fresh[order[n - depth:n - before][:, high]] = True
                    fresh[order[before:depth][:, low]] = True
                    new = np.flatnonzero(fresh & ~seen)
                seen[new] = True
                score[new] = x[new] @ q[i]
                before = depth
                have = np.flatnonzero(seen & (weight > 0))
                best = np.partition(score[have], -k)[-k] if len(have) >= k else none
                if seen.all() or bounds[i, step] < best:
                    break
            yield self.first(have[score[have] >= best], score, weight, k)

    def exact(self, q_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``search`` of one query whose sums may pass a long: every row is scored."""
        x, q = self.raw.astype(np.int64), query.astype(np.int64)
        weight = self.counts.copy()
        weight[np.flatnonzero(self.ids == q_id)] -= (x[self.ids == q_id] == q).all(1)
        score = x @ q  # exact unless a sum passes 64 bits
        for r in np.flatnonzero((np.abs(x.astype(np.float64)) @ np.abs(q.astype(np.float64)) >= 1 << 62) & (weight > 0)):
            s = sum(a * b for a, b in zip(x[r].tolist(), q.tolist(), strict=True))
            if not -(1 << 63) <= s < 1 << 63:
                raise OverflowError(f"the score of {q_id} and {self.ids[r]} does not fit a long")
            score[r] = s
        return self.first(np.flatnonzero(weight > 0), score, weight, k)

    def first(self, have: np.ndarray, score: np.ndarray, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        have = have[np.lexsort((self.ids[have], -score[have]))]
        have = have[: int(np.searchsorted(np.cumsum(weight[have]), k)) + 1]
        return self.ids[have], score[have].astype(np.int64), weight[have]


def top_k(vectors: DataFrame, queries, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, scale: int = 64,
          block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of the table for each row that ``queries`` (a column) selects."""
    rows = stored(integers(vectors.withColumn("is_query", queries), id_col, vector_col, scale), "topk-vectors")
    rows = rows.withColumn("dim", F.size("v"))
    wanted = stored(integers(vectors.filter(queries), id_col, vector_col, scale), "topk-queries").withColumn("dim", F.size("v"))
    n, m = rows.count(), wanted.count()
    parts, chunks = max(1, math.ceil(n / block)), max(1, math.ceil(m / chunk))
    key = F.xxhash64("id", "v")
    blocks = _packed(rows.withColumn("part", F.pmod(key, F.lit(parts)).cast("int")), ["dim", "part"], 2 * block)
    asked = _packed(wanted.withColumn("part", F.pmod(key, F.lit(chunks)).cast("int")), ["dim", "part"], 2 * chunk)
    asked = asked.toDF("dim", "chunk", "q_ids", "q_counts", "q_vectors")
    # each chunk of queries goes to each block: a stated query set against all rows, block by block
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block_rows = None, None
        for b in batches:
            for dim, ids, counts, xs, q_ids, qs in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held != ids + xs:  # pairs arrive block by block
                    held = ids + xs
                    own = np.frombuffer(ids, np.int64)
                    block_rows = Block(own, np.frombuffer(counts, np.int64), np.frombuffer(xs, np.int64).reshape(len(own), dim))
                q_ids = np.frombuffer(q_ids, np.int64)
                qs = np.frombuffer(qs, np.int64).reshape(len(q_ids), dim)
                out = list(block_rows.search(q_ids, qs, k))
                where = np.repeat(np.arange(len(out)), [len(o[0]) for o in out])
                names = np.array([xxhash.xxh64_intdigest(v.tobytes()) for v in qs], np.uint64).view(np.int64)
                cols = [q_ids[where], names[where], *(np.concatenate([o[c] for o in out]) for c in range(3))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["query_id", "q", "vec_id", "score", "n"])
    spread = max(2, parts)
    joined = blocks.repartition(spread, "dim", "part").join(asked.repartition(spread, "dim", "part"), ["dim", "part"])
    found = joined.select("dim", "ids", "counts", "vectors", "q_ids", "q_vectors").mapInArrow(
        run, "query_id long, q long, vec_id long, score long, n long")
    order = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    # equal rows are listed as often as they occur, up to k times
    found = found.select("query_id", "q", "vec_id", "score", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)))).alias("copy"))
    found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
