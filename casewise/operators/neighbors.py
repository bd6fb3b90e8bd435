"""Exact k-nearest neighbours (C4) and what is built on them (M4, H2).

The references are cut into cells by a tree of cuts (at the mean of the widest dimension), learned on a bounded
sample; of every cell the box and the ball that hold its references are known.  Cells that lie side by side are
bundled up to ``TASK_BYTES`` of vectors.  A query is first compared with the bundle of its own cell.  Its k-th distance
there is an upper bound, and a cell whose box or ball lies beyond that bound cannot hold a neighbour; the query goes on, with its
bound, to the bundles of the other cells, once to each.  So the rows that travel depend on the number of bundles
near a query, not of cells.  Large bundles, and the queries of a bundle, are split into blocks, so a task holds two
bounded blocks.  Inside a task the same is done again with small cells of the block: numpy skips those that no query of a
chunk needs, computes distances and keeps the k best per query; pairs are never rows.  The winners are merged
with a window partitioned by the query id.

The result is exact; how much is skipped depends on the data: clustered data, and numbers beside indicators,
visit few cells, and without structure (high-dimensional noise) every cell is visited, as in any
exact method.  ``inverted.py`` holds the approximate search.

Ids may be of any orderable type (numbers, text); ties go to the smaller id.  A vector that holds a null or non-finite component
is no query's neighbour and has none.  Both sides are read several times: callers cut the lineage of what is dear to compute.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casewise.session import cut_lineage

BLOCK_ROWS = 8192       # rows of one side per block
CELL_ROWS = 256         # references expected in a cell, as far as MAX_CELLS allows, and in a cell inside a task
MAX_CELLS = 2048        # cells are shipped to every task: at most this many boxes
TASK_BYTES = 16 << 20   # vectors of one side that a task holds; of the sample that cells are cut on; of boxes
QUERY_CHUNK = 256       # queries that are compared at a time
CHUNK_SPAN = 4          # cells that the queries of a chunk come from
CHUNK_CELLS = 1 << 19   # distances that are computed at a time
DIFF_CELLS = 1 << 21    # components of candidate pairs that are subtracted at a time


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as a matrix of doubles; null components are NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = pc.unique(pc.list_value_length(column)).to_pylist()
    if len(size) > 1 or None in size:
        raise ValueError("vectors must be there and of one length")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), size[0] if size else 0)


def _exact(q: np.ndarray, r: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Distances of the pairs (q[i], r[j]) by the direct sum of squared differences."""
    step = max(1, DIFF_CELLS // max(1, q.shape[1]))
    out = np.empty(len(i))
    for at in range(0, len(i), step):
        diff = q[i[at:at + step]] - r[j[at:at + step]]
        out[at:at + step] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    return out


def _best(who: np.ndarray, ref: np.ndarray, dist: np.ndarray, rid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query by (distance, id), and their places from 0."""
    order = np.lexsort((rid[ref], dist, who))
    who, ref, dist = who[order], ref[order], dist[order]
    place = np.arange(len(who)) - np.searchsorted(who, who)
    keep = place < k
    return who[keep], ref[keep], dist[keep], place[keep]


def _runs(wanted: np.ndarray, start: np.ndarray, stop: np.ndarray, step: int):
    """(from, to): stretches of at most ``step`` rows over the wanted cells; cells side by side share one."""
    begin = end = None
    for a, b in [*zip(start[wanted], stop[wanted], strict=True), (-1, -1)]:
        if end is not None and a != end:
            for at in range(begin, end, step):
                yield at, min(at + step, end)
            begin = a
        begin, end = (a if begin is None else begin), b


def _spatial(points: np.ndarray) -> np.ndarray:
    """An order of the points in which neighbours lie side by side: halves at the median of the widest dimension."""
    done, todo = [], [np.arange(len(points))]
    while todo:
        part = todo.pop()
        spread = np.ptp(points[part], axis=0) if len(part) > 2 else np.zeros(1)
        if not spread.size or not np.nanmax(spread, initial=0.0) > 0:
            done.append(part)
            continue
        part = part[np.argsort(points[part, np.nanargmax(spread)], kind="stable")]
        todo += [part[len(part) // 2:], part[:len(part) // 2]]
    return np.concatenate(done) if done else np.arange(0)


def _bundles(refs: np.ndarray, rows: int) -> np.ndarray:
    """Bundle of each cell: runs of cells of at most ``rows`` references (a larger cell is a bundle of its own)."""
    out, held, at = np.zeros(len(refs), np.int32), 0, 0
    for i, n in enumerate(refs):
        if held and held + n > rows:
            at, held = at + 1, 0
        out[i], held = at, held + n
    return out


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2.0 * (x @ centres.T), 0.0))


@dataclass
class Cuts:
    """A tree of cuts, arrays over nodes: a node without a feature is a cell; cells are numbered along space."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    cell: np.ndarray

    @classmethod
    def learn(cls, x: np.ndarray, most: int) -> tuple[Cuts, list[np.ndarray]]:
        """At most ``most`` cells for the rows of ``x``, the fullest cell is cut next; and the rows of each cell."""
        feature, cut, left, rows = [-1], [0.0], [-1], [np.arange(len(x))]
        heap, cells = [(-len(x), 0)], 1
        with np.errstate(all="ignore"):
            while heap and cells < most:
                node = heapq.heappop(heap)[1]
                part = x[rows[node]]
                spread = part.var(0) if len(part) > 1 else np.zeros(0)
                f = int(spread.argmax()) if spread.size else 0
                if not spread.size or not spread[f] > 0:
                    continue
                at = part[:, f].mean()
                go = part[:, f] <= at
                if go.all() or not go.any():
                    continue
                feature[node], cut[node], left[node] = f, at, len(rows)
                for side in (rows[node][go], rows[node][~go]):
                    heapq.heappush(heap, (-len(side), len(rows)))
                    for column, v in ((feature, -1), (cut, 0.0), (left, -1), (rows, side)):
                        column.append(v)
                cells += 1
        cell, order, todo = np.full(len(rows), -1), [], [0]
        while todo:
            node = todo.pop()
            if feature[node] < 0:
                cell[node] = len(order)
                order.append(rows[node])
            else:
                todo += [left[node] + 1, left[node]]
        return cls(np.array(feature), np.array(cut), np.array(left), cell), order

    def home(self, x: np.ndarray) -> np.ndarray:
        """The cell of every row."""
        node, open_ = np.zeros(len(x), np.intp), np.arange(len(x))
        while len(open_):
            at = node[open_]
            inner = self.feature[at] >= 0
            open_, at = open_[inner], at[inner]
            node[open_] = self.left[at] + (x[open_, self.feature[at]] > self.cut[at])
        return self.cell[node]


@dataclass
class Space:
    """Boxes (lowest and highest components) and balls that hold the points of each cell."""
    low: np.ndarray
    high: np.ndarray
    centre: np.ndarray
    radius: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray, start: np.ndarray, centre: np.ndarray | None = None) -> Space:
        """Of points that lie cell by cell, from ``start`` on."""
        n = np.diff(np.append(start, len(x)))
        if centre is None:
            centre = np.add.reduceat(x, start, axis=0) / n[:, None]
        off = x - np.repeat(centre, n, axis=0)
        far = np.sqrt(np.einsum("ij,ij->i", off, off))
        return cls(np.minimum.reduceat(x, start, axis=0), np.maximum.reduceat(x, start, axis=0), centre, np.maximum.reduceat(far, start))

    def near(self, x: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """(rows, cells): whether a cell may hold a point within ``bound`` of a row."""
        def beyond(low, high):
            gap = np.maximum(np.maximum(low, high), 0.0)
            return np.sqrt(np.einsum("...k,...k->...", gap, gap)) * (1 - 1e-9)
        out = np.zeros((len(x), len(self.low)), bool)
        if not x.size or not len(self.low):
            out[:] = True
            return out
        # first the cells that are near enough to the box of all rows, then row by row
        some = np.flatnonzero(beyond(self.low - x.max(0), x.min(0) - self.high) <= bound.max())
        centre = self.centre[some]
        # the second term covers the rounding of distances to the centres
        rounding = math.sqrt((x.shape[1] + 4) * np.finfo(np.float64).eps)
        slack = rounding * (np.sqrt((x * x).sum(1))[:, None] + np.sqrt((centre * centre).sum(1)))
        ball = _distances(x, centre) - self.radius[some] * (1 + 1e-9) - slack <= bound[:, None]
        step = max(1, DIFF_CELLS // max(1, len(some) * x.shape[1]))
        for at in range(0, len(x), step):
            part = x[at:at + step, None]
            out[at:at + step, some] = ball[at:at + step] & (beyond(self.low[some] - part, part - self.high[some]) <= bound[at:at + step, None])
        return out


def _chunks(leaf: np.ndarray) -> Iterator[tuple[int, int]]:
    """(from, to): queries in the order of their cells, some cells and at most ``QUERY_CHUNK`` queries at a time."""
    at = 0
    while at < len(leaf):
        to = min(at + QUERY_CHUNK, int(np.searchsorted(leaf, leaf[at] + CHUNK_SPAN)))
        yield at, to
        at = to


def _search(qv: np.ndarray, qid: np.ndarray, bound: np.ndarray, rv: np.ndarray, rid: np.ndarray, k: int,
            exclude_self: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query, reference, distance, place from 0) of the k best references within each query's bound.

    Candidates come from BLAS squared distances (|a|^2 + |b|^2 - 2 a.b) widened by a bound on their rounding error,
    then exact distances (direct sum of squared differences) for the candidates only, ranked by (distance, reference id).
    The margin makes the candidate set a superset of the true k nearest, so the result equals the brute-force
    definition.  A query's limit starts at its bound and falls to its k-th best so far.
    """
    own = int(np.bincount(rid).max()) if exclude_self else 0  # rows that may be the query itself
    cuts, parts = Cuts.learn(rv, math.ceil(len(rv) / CELL_ROWS))
    stop = np.cumsum([len(p) for p in parts])
    start = np.append(0, stop[:-1])
    given = np.concatenate(parts)
    rv, rid = rv[given], rid[given]
    space = Space.of(rv, start)
    leaf = cuts.home(qv)
    turn = np.argsort(leaf, kind="stable")
    leaf, qv, qid, bound = leaf[turn], qv[turn], qid[turn], bound[turn]
    d = qv.shape[1]
    qn, rn = (qv * qv).sum(1), (rv * rv).sum(1)
    wide = np.concatenate([rv, rn[:, None]], axis=1)
    eps = 8.0 * (d + 4) * np.finfo(np.float64).eps  # generous bound factor
    found = []
    for a, b in _chunks(leaf):
        qs, ids, square = qv[a:b], qid[a:b], qn[a:b]
        limit = bound[a:b] ** 2
        left = np.concatenate([-2.0 * qs, np.ones((len(qs), 1))], axis=1)
        best = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        step = max(1, CHUNK_CELLS // len(qs))

        def stretches(a=a, b=b, qs=qs, limit=limit, step=step):
            mine = np.zeros(len(start), bool)
            mine[leaf[a]:leaf[b - 1] + 1] = True
            yield from _runs(mine, start, stop, step)
            # by now the limits are those of the queries' own cells
            yield from _runs(space.near(qs, np.sqrt(limit)).any(0) & ~mine, start, stop, step)
        for at, to in stretches():
            d2 = left @ wide[at:to].T  # less the query's own square
            tol = eps * (square + rn[at:to].max()) + 1e-300
            hit = d2 <= (limit + tol - square)[:, None]
            first = k + own
            if first < to - at and np.count_nonzero(hit) > 4 * first * len(qs):
                np.fmin(limit, np.partition(d2, first - 1, axis=1)[:, first - 1] + square + tol, out=limit)
                # relative slack covers the rounding of the exact recomputation itself
                hit = d2 <= (limit * (1.0 + 1e-12) + tol - square)[:, None]
            i, j = np.divmod(np.flatnonzero(hit), to - at)
            j = j + at
            if exclude_self:
                other = ids[i] != rid[j]
                i, j = i[other], j[other]
            if not len(i):
                continue
            dist = _exact(qs, rv, i, j)
            fine = np.isfinite(dist)
            *best, place = _best(np.concatenate([best[0], i[fine]]), np.concatenate([best[1], j[fine]]),
                                 np.concatenate([best[2], dist[fine]]), rid, k)
            full = place == k - 1
            limit[best[0][full]] = np.fmin(limit[best[0][full]], best[2][full] ** 2 * (1.0 + 1e-12))
        found.append((a + best[0], best[1], best[2]))
    who, ref, dist = (np.concatenate(v) for v in zip(*found, strict=True))
    return turn[who], given[ref], dist, np.arange(len(who)) - np.searchsorted(who, who)


def _codes(q: pa.Table, r: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids as numbers in the ids' own order, so that ties and equality need no text."""
    both = pa.chunked_array([*q.column("id").chunks, *r.column("id").chunks], r.schema.field("id").type)
    code = pc.rank(both, "ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)
    return code[:q.num_rows], code[q.num_rows:]


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _flat(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


@dataclass
class Plan:
    """Cuts and boxes of the references, the bundle of every cell, and how bundles are split."""
    cuts: Cuts
    space: Space
    rows: np.ndarray
    bundle: np.ndarray
    task_rows: int

    @property
    def held(self) -> np.ndarray:
        """References of each bundle."""
        return np.bincount(self.bundle, self.rows, minlength=1).astype(np.int64)

    @property
    def split(self) -> np.ndarray:
        """Blocks of references of each bundle."""
        return np.maximum(1, -(-self.held // self.task_rows))

    def blocks(self, asked: dict[int, int], cores: int) -> list[tuple[int, int, int]]:
        """(bundle, blocks of queries, blocks of references); a few bundles give work to every core by more and smaller blocks."""
        spread = math.ceil(4 * cores / max(1, sum(int(self.split[b]) for b in asked)))
        return [(int(b), max(math.ceil(n / self.task_rows), min(spread, math.ceil(n / (2 * QUERY_CHUNK)))), int(self.split[b]))
                for b, n in asked.items()]


def _sent(rows: DataFrame, plan: Plan, id_type: str) -> DataFrame:
    """(id, vec, bundle): every row of finite components with the bundle of its cell."""
    cuts, bundle = plan.cuts, plan.bundle

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(1))
            fine = np.isfinite(x).all(1)
            if not fine.all():
                b, x = b.filter(pa.array(fine)), x[fine]
            if len(x):
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bundle[cuts.home(x)].astype(np.int32))], ["id", "vec", "bundle"])
    return rows.mapInArrow(fn, f"id {id_type}, vec array<double>, bundle int")


def _spaces(refs: DataFrame, cuts: Cuts, centre: np.ndarray) -> tuple[Space, np.ndarray]:
    """The boxes and balls of all references, and how many each cell holds."""
    cells, d = centre.shape
    fields = ["cell", "n", "low", "high", "far"]

    def pack(cell, n, low, high, far) -> pa.Table:
        sides = [pa.array([v.tobytes() for v in side], pa.binary()) for side in (low, high)]
        return pa.table([pa.array(cell, pa.int32()), pa.array(n, pa.int64()), *sides, pa.array(far, pa.float64())], fields)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, far = np.zeros(cells, np.int64), np.full(cells, -np.inf)
        low, high = np.full((cells, d), np.inf), np.full((cells, d), -np.inf)
        for b in batches:
            x = _matrix(b.column(0))
            x = x[np.isfinite(x).all(1)]
            if not len(x):
                continue
            home = cuts.home(x)
            order = np.argsort(home, kind="stable")
            at, start, many = np.unique(home[order], return_index=True, return_counts=True)
            got = Space.of(x[order], start, centre[at])
            n[at] += many
            low[at], high[at] = np.minimum(low[at], got.low), np.maximum(high[at], got.high)
            far[at] = np.maximum(far[at], got.radius)
        at = np.flatnonzero(n)
        yield from pack(at, n[at], low[at], high[at], far[at]).to_batches()

    def add(t: pa.Table) -> pa.Table:
        cell, n, far = (t.column(c).to_numpy() for c in ("cell", "n", "far"))
        low, high = (np.frombuffer(b"".join(t.column(c).to_pylist()), np.float64).reshape(len(cell), d) for c in ("low", "high"))
        order = np.argsort(cell, kind="stable")
        at, start = np.unique(cell[order], return_index=True)
        return pack(at, np.add.reduceat(n[order], start), np.minimum.reduceat(low[order], start, axis=0),
                    np.maximum.reduceat(high[order], start, axis=0), np.maximum.reduceat(far[order], start))
    schema = "cell int, n long, low binary, high binary, far double"
    parts = refs.select("vec").mapInArrow(part, schema)
    shares = refs.sparkSession.sparkContext.defaultParallelism
    got = parts.groupBy(F.pmod("cell", F.lit(shares)).alias("share")).applyInArrow(lambda t: add(t.select(fields)), schema).toArrow()
    rows = np.zeros(cells, np.int64)
    space = Space(np.full((cells, d), np.inf), np.full((cells, d), -np.inf), centre, np.full(cells, -np.inf))
    if got.num_rows:  # a row per cell
        at = got.column("cell").to_numpy()
        rows[at], space.radius[at] = got.column("n").to_numpy(), got.column("far").to_numpy()
        for side, c in ((space.low, "low"), (space.high, "high")):
            side[at] = np.frombuffer(b"".join(got.column(c).to_pylist()), np.float64).reshape(-1, d)
    return space, rows


def _plan(refs: DataFrame, block_rows: int, task_bytes: int) -> Plan:
    n = refs.count()
    first = refs.where("vec is not null").select(F.size("vec").alias("d")).first()
    d = first["d"] if first else 0
    # enough cells for blocks of the wanted size and for every core, never more than may be shipped
    wanted = max(math.ceil(2 * n / block_rows), math.ceil(n / CELL_ROWS), math.ceil(math.sqrt(refs.sparkSession.sparkContext.defaultParallelism)))
    wanted = max(1, min(wanted, MAX_CELLS, TASK_BYTES // (16 * max(1, d))))
    # the sample only shapes the cells, every reference is put into one
    most = max(1, TASK_BYTES // (8 * max(1, d)))
    drawn = F.pmod(F.xxhash64(F.lit("cells"), "id", "vec"), F.lit(1 << 30)) < int(min(1.0, 0.9 * most / max(1, n)) * (1 << 30))
    sample = refs.select("vec") if n <= most else refs.where(drawn).select("vec").limit(most)
    x = _matrix(sample.toArrow().column("vec"))
    x = x[np.isfinite(x).all(1)]
    cuts, parts = Cuts.learn(x, wanted)
    centre = np.stack([x[p].mean(0) if len(p) else np.zeros(x.shape[1]) for p in parts])
    if centre.shape[1] != d:  # nothing was drawn
        centre = np.zeros((len(parts), d))
    space, rows = _spaces(refs, cuts, centre)
    task_rows = max(1, task_bytes // (8 * max(1, d)))
    return Plan(cuts, space, rows, _bundles(rows, task_rows), task_rows)


def _meet(spark, q: DataFrame, r: DataFrame, plan: Plan, asked: DataFrame, every: bool):
    """Both sides by blocks, cogrouped: a query meets ``every`` block of its bundle's references, or one."""
    found = {x["bundle"]: x["n"] for x in asked.groupBy("bundle").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per bundle
    sizes = F.broadcast(spark.createDataFrame(plan.blocks(found, spark.sparkContext.defaultParallelism), "bundle int, nq int, nr int"))

    def own(n):
        return F.pmod(F.xxhash64("id"), F.col(n)).cast("int")

    def all_of(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    block = all_of("nr") if every else F.pmod(F.xxhash64("id", F.lit("block")), F.col("nr")).cast("int")
    qx = q.join(sizes, "bundle").select(*q.columns, own("nq").alias("qb"), block.alias("rb"))
    rx = r.join(sizes, "bundle").select("id", "vec", "bundle", own("nr").alias("rb"), all_of("nq").alias("qb"))
    keys = ["bundle", "qb", "rb"]
    return qx.groupBy(*keys).cogroup(rx.groupBy(*keys))


def _first(q: DataFrame, r: DataFrame, plan: Plan, k: int, exclude_self: bool, id_type: str, cells: bool = False) -> DataFrame:
    """(qid, vec, bound, bundles, rids, dists): per query its best in its own bundle and where it goes on, with its bound.

    A query that goes nowhere leaves its vector behind.  If the own bundle has several blocks, the query meets one of them for
    a bound alone and goes on to all.  With ``cells``, the numbers of all cells that may hold a neighbour."""
    cuts, space, bundle, split, some = plan.cuts, plan.space, plan.bundle, plan.split, plan.rows > 0

    def fn(q: pa.Table, r: pa.Table) -> pa.Table:
        n = q.num_rows
        qv, bound = _matrix(q.column("vec")), np.full(n, np.inf)
        who, ref, dist = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        mine = int(q.column("bundle")[0].as_py()) if n else 0
        if n and r.num_rows:
            qid, rid = _codes(q, r)
            who, ref, dist, place = _search(qv, qid, bound, _matrix(r.column("vec")), rid, k, exclude_self)
            full = place == k - 1
            bound[who[full]] = dist[full]
            order = np.argsort(who, kind="stable")
            who, ref, dist = who[order], ref[order], dist[order]
        if split[mine] > 1:
            who, ref, dist = who[:0], ref[:0], dist[:0]
        to, seen = [np.empty(0, np.int32)] * n, [np.empty(0, np.int32)] * n
        home = cuts.home(qv)
        turn = np.argsort(home, kind="stable")
        for a, b in _chunks(home[turn]):
            at = turn[a:b]
            near = space.near(qv[at], bound[at]) & some
            for i, row in zip(at, near, strict=True):
                needs = np.flatnonzero(row).astype(np.int32)
                goes = np.unique(bundle[needs])
                to[i] = goes[(goes != mine) | (split[mine] > 1)]
                if cells:
                    seen[i] = needs
        many = np.array([len(v) for v in to], np.int64)
        offsets = np.append(0, np.cumsum(np.bincount(who, minlength=n)))
        out = {"qid": _flat(q.column("id")), "vec": _flat(q.column("vec")).take(pa.array(np.arange(n), mask=many == 0)), "bound": pa.array(bound),
               "bundles": _lists(np.append(0, np.cumsum(many)), pa.array(np.concatenate([*to, []]).astype(np.int32))),
               "rids": _lists(offsets, _flat(r.column("id")).take(pa.array(ref))), "dists": _lists(offsets, pa.array(dist))}
        if cells:
            out["cells"] = _lists(np.append(0, np.cumsum([len(v) for v in seen])), pa.array(np.concatenate([*seen, []]).astype(np.int32)))
        return pa.table(out)
    schema = f"qid {id_type}, vec array<double>, bound double, bundles array<int>, rids array<{id_type}>, dists array<double>"
    q = _sent(q, plan, id_type)
    met = _meet(q.sparkSession, q, _sent(r, plan, id_type), plan, q, False)
    return cut_lineage(met.applyInArrow(fn, schema + (", cells array<int>" if cells else "")))


def _sides(queries: DataFrame, refs: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, DataFrame, str]:
    id_type = refs.schema[id_col].dataType.simpleString()
    q, r = (df.select(F.col(id_col).cast(id_type).alias("id"), F.col(vec_col).cast("array<double>").alias("vec")) for df in (queries, refs))
    return q, r, id_type


def knn_plan(queries: DataFrame, refs: DataFrame, k: int, id_col: str = "id", vec_col: str = "vec",
             exclude_self: bool = False, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(visits, cells, sizes): who goes where, the references by bundle, and per cell the rows of both sides."""
    q, r, id_type = _sides(queries, refs, id_col, vec_col)
    plan = _plan(r, block_rows, TASK_BYTES)
    visits = _first(q, r, plan, k, exclude_self, id_type, cells=True)
    held = queries.sparkSession.createDataFrame([(c, int(n)) for c, n in enumerate(plan.rows) if n], "cell int, refs long")
    sizes = visits.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("queries")).join(held, "cell")
    return visits, _sent(r, plan, id_type), cut_lineage(sizes.select("cell", "queries", "refs"))


def knn_join(queries: DataFrame, refs: DataFrame, k: int, id_col: str = "id", vec_col: str = "vec",
             exclude_self: bool = False, block_rows: int = BLOCK_ROWS, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Exact k nearest references of every query row (Euclidean, float64).

    Returns (qid, rid, dist, rank) with rank 1..k; ties broken by reference id.
    """
    q, r, id_type = _sides(queries, refs, id_col, vec_col)
    plan = _plan(r, block_rows, task_bytes)
    first = _first(q, r, plan, k, exclude_self, id_type)
    cand = first.select("qid", F.explode(F.arrays_zip("rids", "dists")).alias("w")).select("qid", F.col("w.rids").alias("rid"), F.col("w.dists").alias("dist"))
    on = first.where(F.size("bundles") > 0).select(F.col("qid").alias("id"), "vec", "bound", F.explode("bundles").alias("bundle"))

    def more(q: pa.Table, r: pa.Table) -> pa.Table:
        who, ref, dist = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        if q.num_rows and r.num_rows:
            bound, (qid, rid) = q.column("bound").to_numpy(), _codes(q, r)
            who, ref, dist, _ = _search(_matrix(q.column("vec")), qid, bound, _matrix(r.column("vec")), rid, k, exclude_self)
            near = dist <= bound[who]
            who, ref, dist = who[near], ref[near], dist[near]
        return pa.table({"qid": _flat(q.column("id")).take(pa.array(who)), "rid": _flat(r.column("id")).take(pa.array(ref)), "dist": pa.array(dist)})
    if not on.isEmpty():
        met = _meet(queries.sparkSession, on, _sent(r, plan, id_type), plan, on, True)
        cand = cand.unionByName(met.applyInArrow(more, f"qid {id_type}, rid {id_type}, dist double"))
    w = Window.partitionBy("qid").orderBy("dist", "rid")
    return cand.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def knn_vote(neighbors: DataFrame, ref_labels: DataFrame, id_col: str = "id",
             label_col: str = "label") -> DataFrame:
    """M4: inverse-distance vote; when a neighbour sits at distance 0 only the
    exact hits vote (each with weight 1).  Returns (qid, pred, prob) with the
    smallest label winning ties."""
    lab = ref_labels.select(F.col(id_col).alias("rid"), F.col(label_col).alias("__lab"))
    nb = neighbors.join(lab, "rid")
    has_zero = F.max((F.col("dist") == 0).cast("int")).over(Window.partitionBy("qid"))
    w = F.when(F.col("__z") == 1, (F.col("dist") == 0).cast("double")).otherwise(F.lit(1.0) / F.col("dist"))
    per = nb.withColumn("__z", has_zero).withColumn("__w", w) \
        .groupBy("qid", "__lab").agg(F.sum("__w").alias("__s"))
    tot = per.groupBy("qid").agg(F.sum("__s").alias("__t"),
                                 F.max_by(F.col("__lab"), F.struct(F.col("__s"), -F.col("__lab"))).alias("pred"),
                                 F.max("__s").alias("__m"))
    return tot.select("qid", "pred", (F.col("__m") / F.col("__t")).alias("prob"))


def knn_class_probability(neighbors: DataFrame, ref_labels: DataFrame, positive=1, id_col: str = "id",
                          label_col: str = "label") -> DataFrame:
    """M4 score for a binary label: weighted share of the positive class."""
    lab = ref_labels.select(F.col(id_col).alias("rid"), F.col(label_col).alias("__lab"))
    nb = neighbors.join(lab, "rid")
    has_zero = F.max((F.col("dist") == 0).cast("int")).over(Window.partitionBy("qid"))
    w = F.when(F.col("__z") == 1, (F.col("dist") == 0).cast("double")).otherwise(F.lit(1.0) / F.col("dist"))
    nb = nb.withColumn("__z", has_zero).withColumn("__w", w)
    return nb.groupBy("qid").agg(
        (F.sum(F.when(F.col("__lab") == positive, F.col("__w")).otherwise(0.0)) / F.sum("__w")).alias("score"))


def enn_keep(neighbors: DataFrame, labels: DataFrame, id_col: str = "id",
             label_col: str = "label") -> DataFrame:
    """H2: ids whose every neighbour shares their label (neighbours exclude self)."""
    lab = labels.select(F.col(id_col).alias("__id"), F.col(label_col).alias("__own"))
    nl = labels.select(F.col(id_col).alias("rid"), F.col(label_col).alias("__nl"))
    j = neighbors.join(nl, "rid").join(lab, F.col("qid") == F.col("__id"))
    return j.groupBy("qid").agg(F.bool_and(F.col("__nl") == F.col("__own")).alias("keep"))
