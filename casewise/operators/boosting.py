"""Second-order gradient boosting on binned features (M5, and the boosters of M6 and M9).

Every round fits one tree to the gradient and the Hessian of the log loss.  A node's candidate
splits come from histograms of (gradient, Hessian, rows) per feature and bin; only the smaller
child of a split is counted, its sibling is the difference.  The tree grows best leaf first up to
``max_leaves`` (nodes are evaluated in batches; the order of the splits decides what stays).
Missing values go to the side that gains more.

Gradients are rounded to 2^-24 and summed as integers, so a histogram is the same however the
rows are dealt: a matrix that fits a task is boosted inside one task (many fits run side by
side), a larger one by one Spark job per batch of nodes; both give the same model.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casewise.operators.binned import MISSING, Bins, Matrix, cells, dense, matrix, stored, width_of

UNIT = float(1 << 24)
CODES = 256
#: Nodes whose splits are searched at a time.
BATCH = 32
#: Rounds between two writes of the rows' scores when the matrix is not held.
KEEP = 10
#: Rows that are worth a task of their own in a pass.
BLOCK_ROWS = 20_000


@dataclass
class Options:
    """Sizes and penalties; the defaults are those of a histogram booster without limits of depth."""
    rounds: int = 100
    rate: float = 0.1
    max_depth: int | None = None
    max_leaves: int | None = 31
    min_rows: int = 20
    min_hessian: float = 1e-3
    penalty: float = 0.0
    #: "auto": hold out ``held_out`` of the rows and stop once they no longer gain, above 10,000 rows.
    stopping: str | bool = "auto"
    held_out: float = 0.1
    patience: int = 10
    tolerance: float = 1e-7
    #: Gain by the Hessian (second order) or by the number of rows (first order, Newton leaves).
    second_order: bool = True
    #: One cut for all nodes of a level (``max_depth`` levels, as long as any cut gains).
    symmetric: bool = False
    #: Start from the log odds of the training rows, or from zero.
    from_prior: bool = True
    seed: int = 42

    def stops(self, n: int) -> bool:
        return n > 10_000 if self.stopping == "auto" else bool(self.stopping)


@dataclass
class Tree:
    """Arrays over nodes; node 0 is the root, a leaf has feature -1."""
    feature: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    missing_left: list = field(default_factory=list)
    left: list = field(default_factory=list)
    value: list = field(default_factory=list)

    def add(self, value: float) -> int:
        for column, v in ((self.feature, -1), (self.cut, 0), (self.missing_left, False), (self.left, -1), (self.value, value)):
            column.append(v)
        return len(self.feature) - 1

    def arrays(self) -> tuple[np.ndarray, ...]:
        return (np.array(self.feature, np.int32), np.array(self.cut, np.int32), np.array(self.missing_left, bool),
                np.array(self.left, np.int32), np.array(self.value, np.float64))


def leaves(arrays: tuple[np.ndarray, ...], x: np.ndarray, node: np.ndarray | None = None) -> np.ndarray:
    """The leaf of every row; with ``node`` each row goes on from its node there, in place."""
    feature, cut, missing_left, left, _ = arrays
    node = np.zeros(len(x), np.int64) if node is None else node
    if not len(feature) or not len(x):
        return node
    leaf = feature < 0
    # a leaf leads to itself, so that rows there need not be told apart at every step
    look, last = np.maximum(feature, 0).astype(np.intp), np.where(leaf, MISSING, cut).astype(np.uint8)
    down, to_left = np.where(leaf, np.arange(len(left)), left).astype(np.intp), missing_left & ~leaf
    flat, base, open_, at = x.ravel(), np.arange(len(x)) * x.shape[1], None, node
    while True:
        inner = ~leaf.take(at)
        many = np.count_nonzero(inner)
        if 2 * many < len(at):
            keep = np.flatnonzero(inner)
            node[slice(None) if open_ is None else open_] = at
            if not many:
                return node
            open_, at, base = keep if open_ is None else open_[keep], at[keep], base[keep]
        code = flat.take(base + look.take(at))
        go_left = code <= last.take(at)
        if to_left.any():
            go_left |= (code == MISSING) & to_left.take(at)
        at = down.take(at) + ~go_left


def gradients(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the log loss, in units of 2^-24."""
    p = 1.0 / (1.0 + np.exp(-score))
    return np.rint((p - y) * UNIT), np.rint(p * (1.0 - p) * UNIT)


def losses(score: np.ndarray, y: np.ndarray) -> int:
    return int(np.rint((np.logaddexp(0, score) - y * score) * UNIT).sum())


class Layout:
    """Where the codes of every feature lie in a histogram: side by side, the missing value last."""

    def __init__(self, bins: Bins):
        codes = [len(c) + 1 for c in bins.cuts]
        ends = np.cumsum([c + 1 for c in codes]).astype(np.int64)
        self.width, self.size = len(codes), int(ends[-1]) if codes else 0
        self.start = np.concatenate([[0], ends[:-1]]).astype(np.int64) if codes else np.zeros(0, np.int64)
        self.feature = np.repeat(np.arange(self.width), np.diff(np.append(self.start, self.size)))
        self.code = np.arange(self.size) - self.start[self.feature]
        self.missing = ends - 1
        self.place = np.zeros((self.width, CODES), np.int64)
        for f, c in enumerate(codes):
            self.place[f, :c], self.place[f, c:] = self.start[f] + np.arange(c), self.missing[f]


def tally(key: np.ndarray, slot: np.ndarray, slots: int, weights: list[np.ndarray | None], spread, layout: Layout, common: np.ndarray) -> np.ndarray:
    """(slots, cells, weights) sums over entries with ``key`` = slot x (cells + 1) + cell; the common cells are inferred from the rows' sums.

    ``spread`` gives each entry the weight of its row."""
    size = layout.size
    out = np.empty((slots, size, len(weights)), np.int64)
    for k, w in enumerate(weights):
        got = np.bincount(key, None if w is None else spread(w), slots * (size + 1)).reshape(slots, size + 1)[:, :size]
        total = np.bincount(slot, w, slots)
        if size:
            got[:, common] = total[:, None] - (np.add.reduceat(got, layout.start, axis=1) - got[:, common])
        out[..., k] = got
    return out


class Counter:
    """Histograms over rows held in memory; a cell with the commonest code of its feature is not visited but inferred."""

    def __init__(self, x: np.ndarray, layout: Layout):
        self.n, self.layout = len(x), layout
        count = np.zeros(layout.size, np.int64)
        for f in range(layout.width):
            count += np.bincount(layout.place[f][x[:, f]], minlength=layout.size)
        self.common = commonest(count, layout)
        rows, cell = uncommon(x, layout, self.common)
        many = np.bincount(rows, minlength=self.n)
        # as many places a row as the fullest row has entries; a free place counts in a cell past the last
        self.cells = np.full((self.n, int(many.max(initial=0))), layout.size, np.int32)
        self.cells[rows, np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many)] = cell

    def histograms(self, slot: np.ndarray, slots: int, weights: list[np.ndarray | None]) -> np.ndarray:
        """(slots, cells, weights) sums over the rows with ``slot`` >= 0."""
        member = np.flatnonzero(slot >= 0)
        slot, places = slot[member], self.cells.shape[1]
        key = (self.cells[member] + (slot * (self.layout.size + 1))[:, None]).ravel()
        return tally(key, slot, slots, [None if w is None else w[member] for w in weights], lambda w: np.repeat(w, places), self.layout, self.common)


def commonest(count: np.ndarray, layout: Layout) -> np.ndarray:
    """The fullest cell of every feature."""
    return np.array([s + count[s:m + 1].argmax() for s, m in zip(layout.start, layout.missing, strict=True)], np.int64)


def uncommon(x: np.ndarray, layout: Layout, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of every code that is not its feature's common one, row by row."""
    code = np.where(common == layout.missing, MISSING, common - layout.start).astype(np.uint8)
    at = np.flatnonzero(x != code)
    rows = at // max(1, layout.width)
    return rows, layout.place.ravel()[(at - rows * layout.width) * CODES + x.ravel()[at]]


def _sides(h: np.ndarray, totals: np.ndarray, layout: Layout, o: Options) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gain, fits, sums on the left, missing sums) of every cut of every node, missing values to the right and to the left."""
    up = np.cumsum(h, 1)
    before = np.where(layout.start[:, None] > 0, up[:, layout.start - 1], 0)
    missing = h[:, layout.missing]
    left = (up - before[:, layout.feature])[:, None]
    if missing[..., 2].any():
        left = np.concatenate([left, left + missing[:, None, layout.feature]], 1)
    right = totals[:, None, None] - left

    def score(s: np.ndarray) -> np.ndarray:
        second = s[..., 1] / UNIT + o.penalty if o.second_order else s[..., 2].astype(np.float64)
        first = s[..., 0] / UNIT
        return np.divide(first * first, second, out=np.zeros_like(first), where=second > 0)
    fits = np.minimum(left[..., 2], right[..., 2]) >= max(1, o.min_rows)
    fits &= np.minimum(left[..., 1], right[..., 1]) >= o.min_hessian * UNIT
    fits[:, :, layout.missing] = False
    gain = score(left) + score(right) - score(totals)[:, None, None]
    both = (len(h), 2, layout.size)  # without missing values both sides are the same
    return np.broadcast_to(gain, both), np.broadcast_to(fits, both), np.broadcast_to(left, (*both, 3)), missing


def best_splits(h: np.ndarray, totals: np.ndarray, layout: Layout, o: Options) -> list[tuple | None]:
    """Per node (gain, feature, cut, missing_left, left's sums): the split that gains most, first of equals; None if none does."""
    if not layout.size:
        return [None] * len(h)
    gain, fits, left, missing = _sides(h, totals, layout, o)
    gain = np.where(fits, gain, -np.inf).reshape(len(h), -1)
    out = []
    for i, at in enumerate(gain.argmax(1)):
        if not gain[i, at] > 1e-12:
            out.append(None)
            continue
        side, cell = divmod(int(at), layout.size)
        f, sums = int(layout.feature[cell]), left[i, side, cell]
        to_left = bool(side) if missing[i, f, 2] else bool(2 * sums[2] >= totals[i, 2])
        out.append((float(gain[i, at]), f, int(layout.code[cell]), to_left, sums))
    return out


def grow_symmetric(passes, o: Options) -> Tree:
    """One tree whose nodes of a level all have the cut that gains most over the level."""
    tree, layout = Tree(), passes.layout
    totals = {0: passes.begin()}
    level, hist = [0], {}

    def value(sums: np.ndarray) -> float:
        second = sums[1] / UNIT + o.penalty
        return float(-o.rate * sums[0] / UNIT / second) if second > 0 else 0.0
    tree.add(value(totals[0]))
    for depth in range(o.max_depth or 6):
        if not layout.size:
            break
        if depth == 0:
            hist[0] = passes.histograms(tree, [0])[0]
        else:
            pairs = list(zip(level[::2], level[1::2], strict=True))
            small = [a if totals[a][2] <= totals[b][2] else b for a, b in pairs]
            for (a, b), s, h in zip(pairs, small, passes.histograms(tree, small), strict=True):
                up = hist.pop(parent[a])
                hist[s], hist[a + b - s] = h, up - h
        total = np.zeros(2 * layout.size)
        sides = np.zeros((2, layout.size, 3), np.int64)
        for at in range(0, len(level), BATCH):
            some = level[at:at + BATCH]
            gain, _, left, _ = _sides(np.stack([hist[n] for n in some]), np.stack([totals[n] for n in some]), layout, o)
            total += gain.sum(0).ravel()
            sides += left.sum(0)
        # a cut must leave rows on both sides of the level as a whole
        rest = sum(totals[n][2] for n in level) - sides[..., 2]
        usable = np.minimum(sides[..., 2], rest) >= max(1, o.min_rows)
        usable[:, layout.missing] = False
        total = np.where(usable.ravel(), total, -np.inf)
        best = int(total.argmax())
        if not total[best] > 1e-12:
            break
        side, cell = divmod(best, layout.size)
        f, cut, parent = int(layout.feature[cell]), int(layout.code[cell]), {}
        below = []
        for n in level:
            h = hist[n]
            sums = h[layout.start[f]:cell + 1].sum(0) + (h[layout.missing[f]] if side else 0)
            k = tree.add(value(sums))
            tree.add(value(totals[n] - sums))
            totals[k], totals[k + 1] = sums, totals[n] - sums
            parent[k] = parent[k + 1] = n
            tree.feature[n], tree.cut[n], tree.missing_left[n], tree.left[n] = f, cut, bool(side), k
            below += [k, k + 1]
        level = below
    return tree


def grow(passes, o: Options) -> Tree:
    """One tree; ``passes.begin()`` gives the sums over all rows, ``passes.histograms(tree, nodes)`` those of some nodes by cell."""
    tree, hist, split, depth, layout = Tree(), {}, {}, {0: 0}, passes.layout
    totals = {0: passes.begin()}

    def value(sums: np.ndarray) -> float:
        second = sums[1] / UNIT + o.penalty
        return float(-o.rate * sums[0] / UNIT / second) if second > 0 else 0.0

    def look(nodes: list[int]) -> None:
        for at in range(0, len(nodes), BATCH):
            some = nodes[at:at + BATCH]
            found = best_splits(np.stack([hist[n] for n in some]), np.stack([totals[n] for n in some]), layout, o)
            for n, s in zip(some, found, strict=True):
                split[n] = s

    tree.add(value(totals[0]))
    hist[0] = passes.histograms(tree, [0])[0]
    look([0])
    children: dict[int, int] = {}
    while True:
        # best leaf first, as far as it is known; splits that are used but not yet carried out come next
        heap, used, todo = [], [], []
        if split[0]:
            heap.append((-split[0][0], 0))
        while heap and (o.max_leaves is None or len(used) + 1 < o.max_leaves):
            n = heapq.heappop(heap)[1]
            used.append(n)
            if n not in children:
                todo.append(n)
                continue
            for c in (children[n], children[n] + 1):
                if split[c]:
                    heapq.heappush(heap, (-split[c][0], c))
        if not todo:
            break
        small = []
        for n in todo:
            _, f, cut, to_left, sums = split[n]
            total = totals[n]
            children[n] = tree.add(value(sums))
            totals[children[n]], totals[children[n] + 1] = sums, total - sums
            tree.add(value(total - sums))
            tree.feature[n], tree.cut[n], tree.missing_left[n], tree.left[n] = f, cut, to_left, children[n]
            depth[children[n]] = depth[children[n] + 1] = depth[n] + 1
            if o.max_depth is None or depth[children[n]] < o.max_depth:
                small.append((n, children[n] + int(2 * sums[2] > total[2])))
            else:
                split[children[n]] = split[children[n] + 1] = None
                del hist[n]
        if small:
            got = passes.histograms(tree, [s for _, s in small])
            for (n, s), h in zip(small, got, strict=True):
                hist[s], hist[2 * children[n] + 1 - s] = h, hist[n] - h
                del hist[n]
            look([c for n, _ in small for c in (children[n], children[n] + 1)])
    kept = set(used)
    for n in children:  # evaluated ahead, but not among the best
        if n not in kept:
            tree.feature[n] = -1
    return tree


class Held:
    """Passes over a matrix in memory."""

    def __init__(self, y: np.ndarray, x: np.ndarray, valid: np.ndarray, layout: Layout, o: Options):
        self.x, self.y, self.valid, self.start = x, y, valid, prior(int(y[~valid].sum()), int((~valid).sum()), o)
        self.score, self.layout = np.full(len(y), self.start), layout
        self.fitted = np.flatnonzero(~valid)
        self.counter = Counter(x[~valid] if valid.any() else x, layout)

    def begin(self) -> np.ndarray:
        self.node = np.zeros(len(self.y), np.int64)
        self.weights = [*gradients(self.score[self.fitted], self.y[self.fitted]), None]
        return np.array([self.weights[0].sum(), self.weights[1].sum(), self.counter.n]).astype(np.int64)

    def histograms(self, tree: Tree, nodes: list[int]) -> np.ndarray:
        place = np.full(len(tree.feature), -1)
        place[nodes] = np.arange(len(nodes))
        leaves(tree.arrays(), self.x, self.node)  # on from where the last pass left the rows
        return self.counter.histograms(place[self.node[self.fitted]], len(nodes), self.weights)

    def finish(self, tree: Tree) -> int:
        """Adds the tree; returns the loss of the held-out rows."""
        arrays = tree.arrays()
        feature, left, value = arrays[0], arrays[3], arrays[4].copy()
        leaves(arrays, self.x, self.node)
        # rows below a node that was split ahead, but not kept, belong to that node
        for n in np.flatnonzero(left >= 0):
            if feature[n] < 0:
                value[left[n]:left[n] + 2] = value[n]
                feature[left[n]:left[n] + 2] = -1
        self.score += value[self.node]
        return losses(self.score[self.valid], self.y[self.valid])


class Spread:
    """The same passes as Spark jobs over a stored matrix (uid, y, x, valid), kept as blocks of rows."""

    BLOCK = "y binary, x binary, score binary, valid binary"

    def __init__(self, rows: DataFrame, layout: Layout, o: Options):
        sums = rows.groupBy("valid").agg(F.sum("y").alias("y"), F.count("*").alias("n")).collect()  # two rows
        fitted = next(((int(r.y or 0), r.n) for r in sums if not r.valid), (0, 0))
        self.start, self.layout, self.recent = prior(*fitted, o), layout, []
        self.held_out = any(r.valid for r in sums)
        self.common = layout.start  # until the first histogram tells
        self.root = None
        width, start = layout.width, self.start

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                y, x, valid = b.column(0).to_numpy().astype(np.int8), cells(b.column(1), np.uint8, width), b.column(2).to_numpy(zero_copy_only=False)
                yield Spread._block(y, x, np.full(len(y), start), valid)
        parts = min(3 * rows.sparkSession.sparkContext.defaultParallelism, 1 + sum(r.n for r in sums) // BLOCK_ROWS)
        self.blocks = stored(rows.select("y", "x", "valid").repartition(parts).mapInArrow(run, self.BLOCK), "scores")

    @staticmethod
    def _block(*arrays: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in arrays], ["y", "x", "score", "valid"])

    def _scored(self):
        """A function that gives (y, x, score, valid) of each block of a batch, with the trees since the last write."""
        width, recent = self.layout.width, [t.arrays() for t in self.recent]

        def run(b: pa.RecordBatch):
            for i in range(len(b)):
                raw = [c[i].as_buffer() for c in b.columns]
                y, score, valid = (np.frombuffer(v, d) for v, d in zip((raw[0], raw[2], raw[3]), (np.int8, np.float64, bool), strict=True))
                x, score = np.frombuffer(raw[1], np.uint8).reshape(len(y), width), score.copy()
                for a in recent:
                    score += a[4][leaves(a, x)]
                yield y, x, score, valid
        return run

    def begin(self) -> np.ndarray:
        """The sums over all rows; those of the root's cells come with them."""
        if self.layout.size:
            self.root = self._histograms(Tree([-1], [0], [False], [-1], [0.0]), [0])
            count = self.root[0, :, 2]
            self.common = commonest(count, self.layout)
            return self.root[0, :self.layout.missing[0] + 1].sum(0)
        scored = self._scored()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for y, _, score, valid in scored(b):
                    g, h = gradients(score[~valid], y[~valid])
                    yield pa.RecordBatch.from_arrays([pa.array([int(v)], pa.int64()) for v in (g.sum(), h.sum(), len(g))], ["g", "h", "n"])
        sums = self.blocks.mapInArrow(run, "g long, h long, n long").agg(F.sum("g"), F.sum("h"), F.sum("n")).first()
        return np.array([v or 0 for v in sums], np.int64)

    def histograms(self, tree: Tree, nodes: list[int]) -> np.ndarray:
        return self.root if len(tree.feature) == 1 and self.layout.size else self._histograms(tree, nodes)

    def _histograms(self, tree: Tree, nodes: list[int]) -> np.ndarray:
        layout, scored, arrays, common = self.layout, self._scored(), tree.arrays(), self.common
        ends = np.append(layout.start, layout.size)
        place = np.full(len(tree.feature), -1)
        place[nodes] = np.arange(len(nodes))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((len(nodes), layout.size, 3), np.int64)
            for b in batches:
                for y, x, score, valid in scored(b):
                    slot = place[leaves(arrays, x)]
                    member = np.flatnonzero((slot >= 0) & ~valid)
                    slot = slot[member]
                    rows, cell = uncommon(x[member], layout, common)
                    sums += tally(slot[rows] * (layout.size + 1) + cell, slot, len(nodes), [*gradients(score[member], y[member]), None],
                                  lambda w, rows=rows: w[rows], layout, common)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(layout.width, dtype=np.int32)), pa.array(
                [sums[:, a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)], pa.binary())], ["f", "sums"])

        def add(parts: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(v.as_py(), np.int64) for v in parts.column("sums"))
            return pa.table({"f": parts.column("f")[:1], "sums": pa.array([total.tobytes()], pa.binary())})
        parts = self.blocks.mapInArrow(count, "f int, sums binary")
        # partial sums meet by feature; nodes x cells come back, whatever the number of rows
        out = np.zeros((len(nodes), layout.size, 3), np.int64)
        for r in parts.groupBy("f").applyInArrow(add, "f int, sums binary").collect():
            out[:, ends[r.f]:ends[r.f + 1]] = np.frombuffer(r.sums, np.int64).reshape(len(nodes), -1, 3)
        return out

    def finish(self, tree: Tree) -> int:
        self.recent.append(tree)
        scored = self._scored()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for y, x, score, valid in scored(b):
                    yield Spread._block(y, x, score, valid)

        def loss(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for y, _, score, valid in scored(b):
                    yield pa.RecordBatch.from_arrays([pa.array([losses(score[valid], y[valid])], pa.int64())], ["loss"])
        got = self.blocks.mapInArrow(loss, "loss long").agg(F.sum("loss").alias("l")).first()["l"] if self.held_out else 0
        if len(self.recent) == KEEP:
            self.blocks, self.recent = stored(self.blocks.mapInArrow(run, self.BLOCK), "scores"), []
        return int(got or 0)


def prior(positive: int, n: int, o: Options) -> float:
    if not o.from_prior or not 0 < positive < n:
        return 0.0 if not o.from_prior or not n else (30.0 if positive else -30.0)
    return float(np.log(positive / (n - positive)))


def boost(passes, o: Options, stops: bool) -> list[Tree]:
    trees, seen = [], []
    for _ in range(o.rounds):
        tree = grow_symmetric(passes, o) if o.symmetric else grow(passes, o)
        trees.append(tree)
        seen.append(passes.finish(tree))
        # no better than before the last rounds, each of them
        if stops and len(seen) > o.patience and min(seen[-o.patience:]) >= seen[-o.patience - 1] - o.tolerance * UNIT:
            break
    return trees


@dataclass
class BoostedModel:
    """Trees with their bins; ``score`` adds the probability of class 1."""
    bins: Bins
    trees: list
    start: float
    features: str = "features"

    def probability(self, vector: Column) -> Column:
        cuts, arrays, start, width = self.bins, [t.arrays() for t in self.trees], self.start, len(self.bins.cuts)

        @F.arrow_udf("double")
        def run(x: pa.Array) -> pa.Array:
            code = cuts.codes(dense(x, width))
            score = np.full(len(code), start)
            for a in arrays:
                score += a[4][leaves(a, code)]
            return pa.array(1.0 / (1.0 + np.exp(-score)))
        return run(vector)

    def transform(self, df: DataFrame) -> DataFrame:
        from casewise.operators.binned import as_array
        return df.withColumn("score", self.probability(as_array(df, self.features)))

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        trees = [(i, *[a.tolist() for a in t.arrays()]) for i, t in enumerate(self.trees)]
        spark.createDataFrame(trees, "tree int, feature array<int>, cut array<int>, missing_left array<boolean>, "
                                     "left array<int>, value array<double>").write.mode("overwrite").parquet(f"{path}/trees")
        meta = json.dumps({"cuts": [c.tolist() for c in self.bins.cuts], "start": self.start, "features": self.features})
        spark.createDataFrame([(meta,)], "meta string").write.mode("overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
        rows = spark.read.parquet(f"{path}/trees").orderBy("tree").collect()  # a model: rounds x leaves
        trees = [Tree(list(r.feature), list(r.cut), list(r.missing_left), list(r.left), list(r.value)) for r in rows]
        return cls(Bins([np.array(c) for c in meta["cuts"]]), trees, meta["start"], meta["features"])


def held_out(o: Options, uid: str = "uid") -> Column:
    """Marks the rows that early stopping looks at."""
    return F.pmod(F.xxhash64(F.lit(o.seed), F.lit("held out"), uid), F.lit(1000)) < int(1000 * o.held_out)


def prepared(df: DataFrame, features: str, label: str, id_col: str) -> tuple[Bins, Matrix]:
    bins = Bins.fit(df, features)
    return bins, matrix(df, features, label, id_col, bins, width_of(df, features))


def fit(df: DataFrame, options: Options, features: str = "features", label: str = "label", id_col: str = "case_id",
        held: bool | None = None) -> BoostedModel:
    """One model; ``held`` forces one of the two ways."""
    bins, m = prepared(df, features, label, id_col)
    stops = options.stops(m.n)
    if m.held if held is None else held:
        return fit_many(bins, m, [options])[0]
    valid = held_out(options) if stops else F.lit(False)
    passes = Spread(m.rows.withColumn("valid", valid), Layout(bins), options)
    return BoostedModel(bins, boost(passes, options, stops), passes.start)


def fit_many(bins: Bins, m: Matrix, options: list[Options], leave: list[int] | None = None) -> list[BoostedModel]:
    """A model for each of ``options``, side by side, a task each; ``leave`` names the ``fold`` of rows that a fit does not see."""
    spark, layout = m.rows.sparkSession, Layout(bins)
    _, y, x = m.collect()
    marks = {f"v{s}": held_out(next(o for o in options if o.seed == s)) for s in {o.seed for o in options}}
    flags = m.rows.select("uid", *[c.alias(n) for n, c in marks.items()], *(["fold"] if leave else [])).toArrow().to_pandas()
    flags = flags.sort_values("uid", kind="stable")
    data = spark.sparkContext.broadcast((y, x, {c: flags[c].to_numpy() for c in flags.columns if c != "uid"}))
    jobs = [(i, json.dumps(asdict(o)), leave[i] if leave else None) for i, o in enumerate(options)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text, out in zip(*(c.to_pylist() for c in b.columns), strict=True):
                o = Options(**json.loads(text))
                y, x, marked = data.value
                use = np.ones(len(y), bool) if out is None else marked["fold"] != out
                stops = o.stops(int(use.sum()))
                valid = marked[f"v{o.seed}"][use] if stops else np.zeros(int(use.sum()), bool)
                passes = Held(y[use], x[use], valid, layout, o)
                trees = json.dumps([[a.tolist() for a in t.arrays()] for t in boost(passes, o, stops)])
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([passes.start]), pa.array([trees])], ["i", "start", "trees"])
    frame = spark.createDataFrame(jobs, "i int, options string, leave int").repartition(max(1, len(jobs)))
    got = {r.i: r for r in frame.mapInArrow(run, "i int, start double, trees string").collect()}  # models: rounds x leaves each
    data.unpersist()
    return [BoostedModel(bins, [Tree(*t) for t in json.loads(got[i].trees)], got[i].start) for i in range(len(options))]
