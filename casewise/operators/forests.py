"""Random forests (M2) and extremely random trees (M3), grown to any depth.

A tree depends on its number, the seed and the rows alone: bootstrap weights, the features that a
node looks at and random cuts are hashes (of tree and row, or of the node's path), never draws in
some order.  So it does not matter where a node is grown:

* a matrix that a task may hold goes to the tasks once, and each grows whole trees;
* a larger one is grown level by level, all open nodes of a group of trees in one pass: a node
  looks at its features, the cells are added up by Spark, the best cut of every node comes back.
  A node whose rows fit a task leaves the passes: its rows go to one task, which grows the rest.
  So a deep tree costs only as many passes as it has levels of nodes too large for a task.

Random forest: the best of all cuts of the binned values by Gini impurity, over sqrt of the features
(and further ones while none of them can split).  Extra trees: one cut per feature, uniform between
the node's smallest and largest value, no bootstrap.  A bootstrap weight is Poisson(1).
"""

from __future__ import annotations

import copy
import json
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casewise.operators.binned import HELD, Bins, Matrix, as_array, binary, cells, dense, matrix, stored, width_of

#: Trees grown together by passes, and bytes of trees that a scoring task holds.
GROUP = 8
#: Values that a node level sorts at a time.
CELLS = 1 << 22
#: Values that are computed with at a time.
PART = 1 << 17
MODEL_BYTES = 32 << 20
#: Cumulative probabilities of a Poisson(1) count.
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])


@dataclass
class Options:
    trees: int = 800
    #: "sqrt", "log2" or "all" features a node.
    looks: str = "sqrt"
    max_depth: int | None = None
    bootstrap: bool = True
    random_cuts: bool = False
    seed: int = 42

    def count(self, width: int) -> int:
        many = {"sqrt": math.sqrt(width), "log2": math.log2(max(2, width)), "all": width}[self.looks]
        return max(1, int(many))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit hash of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = np.asarray(x, np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unit(x: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from hashes."""
    return (x >> np.uint64(11)) * 2.0**-53


def root_key(o: Options, tree: int) -> np.uint64:
    return mix(mix(np.array([o.seed], np.uint64)) ^ np.uint64(tree))[0]


def weights(o: Options, tree: int, uid: np.ndarray) -> np.ndarray:
    if not o.bootstrap:
        return np.ones(len(uid), np.int64)
    return np.searchsorted(POISSON, unit(mix(uid.view(np.uint64) ^ mix(np.array([root_key(o, tree)]))[0])), "right")


def order_of_features(keys: np.ndarray, width: int) -> np.ndarray:
    """The order in which each node looks at the features."""
    # the low bits of a hash make way for the feature's number: numbers sort faster than their places
    bits = np.uint64(max(1, (width - 1).bit_length()))
    feature = np.arange(width, dtype=np.uint64)
    h = mix(keys[:, None] ^ mix(feature + np.uint64(1))) >> bits << bits | feature
    h.sort(axis=1)
    return (h & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def cut_between(keys: np.ndarray, feature: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Uniform cuts, as 32-bit floats below ``high``."""
    u = unit(mix(mix(keys) ^ feature.astype(np.uint64)))
    cut = (low.astype(np.float64) + u * (high.astype(np.float64) - low)).astype(np.float32)
    return np.where(cut >= high, low, cut).astype(np.float32)


def child_keys(keys: np.ndarray) -> np.ndarray:
    """Keys of the left and right children, interleaved."""
    return mix(np.stack([keys, keys ^ np.uint64(1 << 63)], 1) + np.uint64(5)).ravel()


def purity(n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Sum of squared class counts over the count: the more, the purer."""
    n, p = n.astype(np.float64), p.astype(np.float64)
    return np.divide(p * p + (n - p) * (n - p), n, out=np.zeros_like(n), where=n > 0)


@dataclass
class Piece:
    """A tree, or the part of one below some node: arrays over nodes, node 0 on top, a leaf has feature -1.

    ``link`` is the key of the piece that a leaf goes on with, 0 if it is a true leaf.
    """
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    link: np.ndarray

    KINDS = {"feature": np.int16, "cut": np.float32, "left": np.int32, "value": np.float32, "link": np.int64}

    def pack(self) -> dict[str, bytes]:
        return {k: getattr(self, k).astype(d).tobytes() if k != "link" or self.link.any() else b"" for k, d in self.KINDS.items()}

    @classmethod
    def unpack(cls, *parts: bytes) -> Piece:
        a = [np.frombuffer(b, d) for b, d in zip(parts, cls.KINDS.values(), strict=True)]
        return cls(*a[:4], a[4] if len(a[4]) else np.zeros(len(a[0]), np.int64))

    def nodes(self, x: np.ndarray, depth: int | None = None) -> np.ndarray:
        """The node that each row ends in, ``depth`` steps down at most."""
        node, open_, steps = np.zeros(len(x), np.int64), np.arange(len(x)), 0
        at, flat, width = node[:], x.ravel(), x.shape[1]
        while len(open_) and (depth is None or steps < depth):
            inner = self.feature[at] >= 0
            if not inner.all():
                node[open_[~inner]] = at[~inner]
                open_, at = open_[inner], at[inner]
            at = self.left[at] + ~(flat[open_ * width + self.feature[at]] <= self.cut[at])
            steps += 1
        node[open_] = at
        return node


class Columns:
    """A matrix feature by feature; codes count from each feature's lowest, ``two`` marks features with but one other.

    ``bit`` is 0 where such a feature has the lower of its two values, ``ends``."""

    def __init__(self, x: np.ndarray):
        self.size, self.width = x.shape
        by = np.ascontiguousarray(x.T)
        self.low, self.two, self.ends = np.zeros(self.width, by.dtype), np.zeros(self.width, bool), np.zeros((2, self.width), by.dtype)
        if len(x):
            self.ends = np.stack([by.min(1), by.max(1)])
            self.two = np.array([((c == lo) | (c == hi)).all() for c, lo, hi in zip(by, *self.ends, strict=True)], bool)
        if by.dtype.kind in "iu" and len(x):
            self.low = self.ends[0]
            by = by - self.low[:, None]
            self.flat = self.bit = by.ravel()
        else:
            bit = np.zeros(by.shape, np.uint8)
            bit[self.two] = by[self.two] != self.ends[0, self.two, None]
            self.flat, self.bit = by.ravel(), bit.ravel()

    def some(self, rows: np.ndarray) -> Columns:
        """The columns of these rows alone, in this order."""
        out = copy.copy(self)
        out.size = len(rows)
        out.flat = self.flat.reshape(self.width, self.size).take(rows, 1).ravel()
        out.bit = out.flat if self.bit is self.flat else self.bit.reshape(self.width, self.size).take(rows, 1).ravel()
        return out


def _looked_at(c: Columns, rows: np.ndarray, slot: np.ndarray, order: np.ndarray, wp: np.ndarray,
               n: np.ndarray, pos: np.ndarray, keys: np.ndarray, o: Options) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, features) purity after the best cut of each feature in ``order``, and that cut; -inf if there is none.

    ``rows`` are in the order of ``slot``; ``wp`` holds a row's weight times 2^32, plus the weight again if the row is of class 1.
    """
    t, k = order.shape
    best, cut = np.full((t, k), -np.inf), np.zeros((t, k), np.float32)
    if not len(rows):
        return best, cut
    starts = np.flatnonzero(np.diff(slot, prepend=-1))
    # some nodes at a time, so that what is computed per row and feature stays in the processor's cache
    part = np.flatnonzero(np.diff(starts // max(1, PART // k), prepend=-1))
    for a, b in zip(part, [*part[1:], len(starts)], strict=True):
        since, until = starts[a], starts[b] if b < len(starts) else len(rows)
        start, mine = starts[a:b] - since, rows[since:until]
        here = slot[starts[a:b]]
        count = np.diff(np.append(start, until - since))
        looks = order[here]
        w, value = wp[mine], c.bit.take(np.repeat(looks * c.size, count, axis=0) + mine[:, None])
        # a feature of two values has one cut; the others are cut at random, or sort their codes
        good, go = c.two[looks], value == 0
        at = cut_between(keys[here][:, None], looks, *c.ends[:, looks]) if o.random_cuts else c.low[looks]
        below = np.add.reduceat(w[:, None] * go, start, axis=0)
        if o.random_cuts and not good.all():
            node, j = np.nonzero(~good)
            size = count[node]
            first = np.cumsum(size) - size
            place = np.arange(size.sum()) + np.repeat(start[node] - first, size)
            value = c.flat.take(np.repeat(looks[node, j] * c.size, size) + mine[place])
            low, high = np.fmin.reduceat(value, first), np.fmax.reduceat(value, first)
            at[node, j] = cut_between(keys[here][node], looks[node, j], low, high)
            below[node, j] = np.add.reduceat(w[place] * (value <= np.repeat(at[node, j], size)), first)
            good[node, j] = high > low
        nl, pl = below >> 32, below & 0xFFFFFFFF
        n1, p1 = n[here][:, None], pos[here][:, None]
        gain = purity(nl, pl) + purity(n1 - nl, p1 - pl)
        best[here], cut[here] = np.where(good & (nl > 0) & (nl < n1), gain, -np.inf), at
        if not o.random_cuts and not good.all():
            many = ~good
            node, j = np.nonzero(many)
            cell = np.cumsum(many.ravel()).reshape(many.shape) - 1
            use = np.flatnonzero(np.repeat(many, count, axis=0))
            of = np.repeat(cell, count, axis=0).ravel()[use]
            w = w[use // k]
            got = _best_cuts(of, value.ravel()[use].astype(np.int64), w >> 32, w & 0xFFFFFFFF, n[here][node], pos[here][node])
            best[here[node], j], cut[here[node], j] = got[0], got[1] + c.low[looks[node, j]]
    return best, cut


def _best_cuts(slot: np.ndarray, code: np.ndarray, w: np.ndarray, p: np.ndarray, n: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per slot the purity after its best cut of these codes, and the cut; -inf if there is none."""
    key = slot * 256 + code
    if 128 * len(n) <= len(key) and w.sum() < 1 << 26:  # many rows a slot: add up, both sums in one number below 2^52
        sums = np.bincount(key, (w << 26 | p).astype(np.float64), 256 * len(n)).astype(np.int64)
        group = np.flatnonzero(sums)
        cw, cp = np.cumsum(sums[group] >> 26), np.cumsum(sums[group] & ((1 << 26) - 1))
    else:
        key = np.sort(key << 24 | w << 12 | p)
        group = key >> 24
        ends = np.flatnonzero(np.diff(group, append=-1))
        cw, cp, group = np.cumsum(key >> 12 & 4095)[ends], np.cumsum(key & 4095)[ends], group[ends]
    at = group >> 8
    first = np.flatnonzero(np.diff(at, prepend=-1))
    size = np.diff(np.append(first, len(at)))
    nl, pl = cw - np.repeat(np.append(0, cw)[first], size), cp - np.repeat(np.append(0, cp)[first], size)
    gain = np.where(nl < n[at], purity(nl, pl) + purity(n[at] - nl, pos[at] - pl), -np.inf)
    best, cut = np.full(len(n), -np.inf), np.zeros(len(n), np.float32)
    if len(first):
        top = np.maximum.reduceat(gain, first)
        hit = np.flatnonzero(gain == np.repeat(top, size))
        hit = hit[np.flatnonzero(np.diff(at[hit], prepend=-1))]  # the lowest of equal cuts
        best[at[first]], cut[at[hit]] = top, group[hit] & 255
    return best, cut


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, key: np.uint64, o: Options, depth: int = 0, columns: Columns | None = None) -> Piece:
    """The whole tree below a node that has these rows, level by level; ``columns`` are those of ``x``, if they are there already."""
    width = x.shape[1]
    looks = o.count(width)
    out = {k: [] for k in ("feature", "cut", "left", "value")}
    rows = np.flatnonzero(w > 0)
    slot, keys, made = np.zeros(len(rows), np.int64), np.array([key], np.uint64), 0
    c = columns or Columns(x)
    wp = w.astype(np.int64) * ((1 << 32) + y)
    n, pos = np.array([w[rows].sum()]), np.array([(w[rows] * y[rows]).sum()])
    while len(keys):
        t = len(keys)
        feature, cut, left = np.full(t, -1, np.int16), np.zeros(t, np.float32), np.full(t, -1, np.int32)
        best = np.full(t, -np.inf)
        can = (pos > 0) & (pos < n)
        if o.max_depth is not None and depth >= o.max_depth:
            can[:] = False
        stay = can[slot]
        rows, slot = rows[stay], slot[stay]
        if 2 * len(rows) <= c.size:  # those that are left go on side by side, node by node
            c, wp, rows = c.some(rows), wp[rows], np.arange(len(rows))
        order = np.zeros((t, width if can.any() else 0), np.int64)
        if can.any():
            order[can] = order_of_features(keys[can], width)
        since = 0
        while since < width:
            # the first ``looks`` features together, then more and more where none of them splits: the first that does is taken
            room = max(1, CELLS // max(1, len(rows)))
            until = min(width, looks if since < looks else 2 * since, since + room)
            ask = can if since < looks else can & (best == -np.inf)
            if not ask.any():
                break
            if since < looks:
                got, limit = _looked_at(c, rows, slot, order[:, since:until], wp, n, pos, keys, o)
                first, at = got.argmax(1), np.arange(t)
            else:
                at = np.flatnonzero(ask)
                use = np.flatnonzero(ask[slot])
                place = np.cumsum(ask) - 1
                got, limit = _looked_at(c, rows[use], place[slot[use]], order[at, since:until], wp, n[at], pos[at], keys[at], o)
                first = (got > -np.inf).argmax(1)
            top, cuts = (v[np.arange(len(at)), first] for v in (got, limit))
            win = ask[at] & (top > best[at])
            at, first, top, cuts = at[win], first[win], top[win], cuts[win]
            best[at], cut[at], feature[at] = top, cuts, order[at, since + first]
            since = until
        split = np.flatnonzero(feature >= 0)
        left[split] = made + t + 2 * np.arange(len(split))
        for name, v in (("feature", feature), ("cut", cut), ("left", left), ("value", np.divide(pos, n, out=np.zeros(t), where=n > 0))):
            out[name].append(v)
        made += t
        rank = np.full(t, -1)
        rank[split] = np.arange(len(split))
        inner = rank[slot] >= 0
        rows, slot = rows[inner], slot[inner]
        go = c.flat[(feature.astype(np.int64) * c.size)[slot] + rows] <= (cut - c.low[feature])[slot]
        slot = 2 * rank[slot] + ~go
        again = np.argsort(slot.astype(np.uint16) if 2 * len(split) < 65536 else slot, kind="stable")
        rows, slot = rows[again], slot[again]
        sums = np.add.reduceat(wp[rows], np.flatnonzero(np.diff(slot, prepend=-1))) if len(rows) else np.zeros(0, np.int64)
        n, pos = sums >> 32, sums & 0xFFFFFFFF
        keys, depth = child_keys(keys[split]), depth + 1
    a = {k: np.concatenate(v) for k, v in out.items()}
    return Piece(**a, link=np.zeros(made, np.int64))


TREES = "tree int, key long, feature binary, cut binary, left binary, value binary, link binary"


def _table(rows: list[tuple[int, int, Piece]]) -> pa.RecordBatch:
    packs = [p.pack() for _, _, p in rows]
    cols = [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64())]
    return pa.RecordBatch.from_arrays([*cols, *[pa.array([p[k] for p in packs], pa.binary()) for k in Piece.KINDS]], ["tree", "key", *Piece.KINDS])


def signed(key) -> int:
    return int(np.uint64(key).astype(np.int64))


def _fit_held(m: Matrix, o: Options) -> DataFrame:
    spark = m.rows.sparkSession
    data = spark.sparkContext.broadcast(m.collect())  # at most HELD cells

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid, y, x = data.value
        columns = Columns(x)
        for b in batches:
            for tree in b.column(0).to_pylist():
                key = root_key(o, tree)
                yield _table([(tree, signed(key), grow(x, y, weights(o, tree, uid), key, o, columns=columns))])
    tasks = max(1, min(o.trees, 4 * spark.sparkContext.defaultParallelism))
    return stored(spark.range(0, o.trees, 1, tasks).mapInArrow(run, TREES), "forest")


class Top:
    """The upper part of one tree, grown by passes on the driver's side of the job."""

    def __init__(self, o: Options, tree: int):
        self.tree, self.key = tree, root_key(o, tree)
        self.feature, self.cut, self.left, self.n, self.pos = [-1], [0.0], [-1], [0], [0]
        self.keys, self.depth, self.link = [self.key], [0], [0]

    def piece(self) -> Piece:
        value = [p / n if n else 0.0 for n, p in zip(self.n, self.pos, strict=True)]
        return Piece(np.array(self.feature, np.int16), np.array(self.cut, np.float32), np.array(self.left, np.int32),
                     np.array(value, np.float32), np.array(self.link, np.int64))

    def split(self, node: int, feature: int, cut: float, nl: int, pl: int) -> list[int]:
        self.feature[node], self.cut[node], self.left[node] = feature, cut, len(self.feature)
        keys = child_keys(np.array([self.keys[node]], np.uint64))
        for k, n, p in ((0, nl, pl), (1, self.n[node] - nl, self.pos[node] - pl)):
            for column, v in ((self.feature, -1), (self.cut, 0.0), (self.left, -1), (self.n, n), (self.pos, p), (self.keys, keys[k]),
                              (self.depth, self.depth[node] + 1), (self.link, 0)):
                column.append(v)
        return [self.left[node], self.left[node] + 1]


def _fit_spread(m: Matrix, o: Options, task_rows: int, group: int) -> DataFrame:
    """Level-wise passes over the stored matrix; nodes of at most ``task_rows`` weighted rows are finished in tasks."""
    pieces = None
    for start in range(0, o.trees, group):
        tops = [Top(o, t) for t in range(start, min(o.trees, start + group))]
        _grow_tops(m, o, tops, task_rows)
        below = _finish(m, o, tops)
        top = m.rows.sparkSession.createDataFrame(
            [(t.tree, signed(t.key), *[bytearray(v) for v in t.piece().pack().values()]) for t in tops], TREES)
        part = stored(top.unionByName(below), "forest")
        pieces = part if pieces is None else pieces.unionByName(part)
    return pieces


def _emit(m: Matrix, o: Options, tops: list[Top], nodes: list[list[int]], fields: list[str], schema: str, cells_of) -> DataFrame:
    """Runs ``cells_of(tree, uid, y, x, w, place)`` over batches; place is a row's index among the tree's ``nodes``, or -1."""
    width, dtype = m.width, m.dtype
    parts = [(t.tree, t.piece(), np.array(n, np.int64)) for t, n in zip(tops, nodes, strict=True) if n]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            uid, y, x = b.column(0).to_numpy(), b.column(1).to_numpy().astype(np.int64), cells(b.column(2), dtype, width)
            for tree, piece, wanted in parts:
                w = weights(o, tree, uid)
                place = np.full(len(piece.feature), -1)
                place[wanted] = np.arange(len(wanted))
                place = np.where(w > 0, place[piece.nodes(x)], -1)
                use = np.flatnonzero(place >= 0)
                if len(use):
                    yield pa.RecordBatch.from_arrays(cells_of(tree, uid[use], y[use], x[use], w[use], place[use]), fields)
    return m.rows.select("uid", "y", "x").mapInArrow(run, schema)


def _grow_tops(m: Matrix, o: Options, tops: list[Top], task_rows: int) -> None:
    looks, width = o.count(m.width), m.width
    total = _emit(m, o, tops, [[0]] * len(tops), ["tree", "n", "p"], "tree int, n long, p long", lambda tree, uid, y, x, w, place: [
        pa.array([tree], pa.int32()), pa.array([w.sum()]), pa.array([(w * y).sum()])])
    for r in total.groupBy("tree").agg(F.sum("n").alias("n"), F.sum("p").alias("p")).collect():  # one row a tree
        top = tops[r.tree - tops[0].tree]
        top.n[0], top.pos[0] = r.n, r.p

    def large(t: Top, node: int) -> bool:
        return t.n[node] > task_rows and 0 < t.pos[node] < t.n[node] and (o.max_depth is None or t.depth[node] < o.max_depth)
    level = [[0] if large(t, 0) else [] for t in tops]
    while any(level):
        found: list[dict] = [{} for _ in tops]
        seen, ask = 0, level
        while any(ask) and seen < width:
            until = looks if seen == 0 else min(width, seen + looks)
            for r in _best_of(m, o, tops, ask, seen, until):
                found[r["tree"] - tops[0].tree][ask[r["tree"] - tops[0].tree][r["place"]]] = r
            # nodes that none of these features can split look at further ones
            ask, seen = [[n for n in nodes if n not in f] for nodes, f in zip(ask, found, strict=True)], until
        nxt = []
        for t, nodes, f in zip(tops, level, found, strict=True):
            kids = [k for n in nodes if n in f for k in t.split(n, f[n]["feature"], f[n]["cut"], f[n]["nl"], f[n]["pl"])]
            nxt.append([k for k in kids if large(t, k)])
        level = nxt


def _best_of(m: Matrix, o: Options, tops: list[Top], ask: list[list[int]], since: int, until: int) -> list[dict]:
    """The best cut of each asked node over the features number ``since`` to ``until`` of its order; none if none splits.

    Beyond the first ``looks`` features, a node takes the first that splits, as ``grow`` does.
    """
    keys = {t.tree: np.array([t.keys[n] for n in nodes], np.uint64) for t, nodes in zip(tops, ask, strict=True)}
    order = {t: order_of_features(k, m.width)[:, since:until] for t, k in keys.items()}
    sums = {t.tree: (np.array([t.n[n] for n in nodes]), np.array([t.pos[n] for n in nodes])) for t, nodes in zip(tops, ask, strict=True)}
    k = until - since
    out: dict[tuple, tuple] = {}

    def offer(tree: int, place: int, j: int, gain: float, cut: float, nl: int, pl: int) -> None:
        rank = (-gain, j) if since == 0 else (j, -gain)
        if (tree, place) not in out or rank < out[tree, place][0]:
            out[tree, place] = (rank, {"tree": tree, "place": place, "feature": int(order[tree][place, j]), "cut": cut, "nl": nl, "pl": pl})

    def values(tree, x, place):
        return x[np.arange(len(x))[:, None], order[tree][place]]

    if not o.random_cuts:
        def count(tree, uid, y, x, w, place):
            cell = ((place[:, None] * k + np.arange(k)) * 256 + values(tree, x, place)).ravel()
            cell, back = np.unique(cell, return_inverse=True)
            n, p = (np.bincount(back, np.repeat(v, k), len(cell)).astype(np.int64) for v in (w, w * y))
            return [pa.array(np.full(len(cell), tree, np.int32)), *[pa.array(v.astype(np.int32)) for v in (cell // 256 // k, cell // 256 % k, cell % 256)],
                    pa.array(n), pa.array(p)]
        cell = _emit(m, o, tops, ask, ["tree", "place", "j", "code", "n", "p"], "tree int, place int, j int, code int, n long, p long", count)
        cell = cell.groupBy("tree", "place", "j", "code").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
        node = Window.partitionBy("tree", "place", "j")
        up = node.orderBy("code").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cell = cell.select("tree", "place", "j", "code", F.sum("n").over(up).alias("nl"), F.sum("p").over(up).alias("pl"),
                           F.sum("n").over(node).alias("n"), F.sum("p").over(node).alias("p")).filter("nl < n")

        def pure(n: str, p: str):
            n, p = F.expr(n).cast("double"), F.expr(p).cast("double")
            return (p * p + (n - p) * (n - p)) / n
        cell = cell.withColumn("gain", pure("nl", "pl") + pure("n - nl", "p - pl"))
        best = F.max_by(F.struct("gain", "code", "nl", "pl"), F.struct(F.col("gain"), -F.col("code"))).alias("b")
        for r in cell.groupBy("tree", "place", "j").agg(best).collect():  # one row a node and feature looked at
            offer(r.tree, r.place, r.j, r.b.gain, float(r.b.code), r.b.nl, r.b.pl)
        return [v[1] for v in out.values()]

    def ends(tree, uid, y, x, w, place):
        v = values(tree, x, place)
        at = np.argsort(place, kind="stable")
        start = np.flatnonzero(np.diff(place[at], prepend=-1))
        low, high = np.fmin.reduceat(v[at], start, axis=0), np.fmax.reduceat(v[at], start, axis=0)
        here = place[at][start]
        return [pa.array(np.full(here.size * k, tree, np.int32)), pa.array(np.repeat(here, k).astype(np.int32)),
                pa.array(np.tile(np.arange(k, dtype=np.int32), here.size)), pa.array(low.ravel()), pa.array(high.ravel())]
    span = _emit(m, o, tops, ask, ["tree", "place", "j", "low", "high"], "tree int, place int, j int, low float, high float", ends)
    cuts = {t: np.full(v.shape, np.nan, np.float32) for t, v in order.items()}
    for r in span.groupBy("tree", "place", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        if r.high > r.low:
            low, high = np.array([r.low], np.float32), np.array([r.high], np.float32)
            at = keys[r.tree][r.place:r.place + 1], order[r.tree][r.place, r.j:r.j + 1]
            cuts[r.tree][r.place, r.j] = cut_between(*at, low, high)[0]

    def below(tree, uid, y, x, w, place):
        go = values(tree, x, place) <= cuts[tree][place]
        at, slots = (place[:, None] * k + np.arange(k)), len(cuts[tree]) * k
        n, p = (np.bincount(at.ravel(), (v[:, None] * go).ravel(), slots).astype(np.int64) for v in (w, w * y))
        cell = np.flatnonzero(n)
        return [pa.array(np.full(len(cell), tree, np.int32)), pa.array((cell // k).astype(np.int32)), pa.array((cell % k).astype(np.int32)),
                pa.array(n[cell]), pa.array(p[cell])]
    got = _emit(m, o, tops, ask, ["tree", "place", "j", "n", "p"], "tree int, place int, j int, n long, p long", below)
    for r in got.groupBy("tree", "place", "j").agg(F.sum("n").alias("n"), F.sum("p").alias("p")).collect():
        n, p = (v[r.place:r.place + 1] for v in sums[r.tree])
        nl, pl = np.array([r.n]), np.array([r.p])
        if 0 < r.n < n[0]:
            offer(r.tree, r.place, r.j, float((purity(nl, pl) + purity(n - nl, p - pl))[0]), float(cuts[r.tree][r.place, r.j]), r.n, r.p)
    return [v[1] for v in out.values()]


def _finish(m: Matrix, o: Options, tops: list[Top]) -> DataFrame:
    """Grows what is left below the tops, a node's rows in one task."""
    width, dtype = m.width, m.dtype
    nodes = []
    for t in tops:
        open_ = [n for n in range(len(t.feature)) if t.feature[n] < 0 and 0 < t.pos[n] < t.n[n] and (o.max_depth is None or t.depth[n] < o.max_depth)]
        for n in open_:
            t.link[n] = signed(t.keys[n])
        nodes.append(open_)
    keys = {t.tree: np.array([t.link[n] for n in open_], np.int64) for t, open_ in zip(tops, nodes, strict=True)}
    depths = {t.tree: np.array([t.depth[n] for n in open_], np.int32) for t, open_ in zip(tops, nodes, strict=True)}
    fields = ["tree", "key", "depth", "y", "w", "x"]
    if not any(nodes):
        return m.rows.sparkSession.createDataFrame([], TREES)
    rows = _emit(m, o, tops, nodes, fields, "tree int, key long, depth int, y int, w int, x binary", lambda tree, uid, y, x, w, place: [
        pa.array(np.full(len(y), tree, np.int32)), pa.array(keys[tree][place]), pa.array(depths[tree][place]), pa.array(y.astype(np.int32)),
        pa.array(w.astype(np.int32)), binary(x)])

    def run(part: pa.Table) -> pa.Table:
        part = part.combine_chunks()
        tree, key = part.column("tree")[0].as_py(), part.column("key")[0].as_py()
        x = cells(part.column("x").combine_chunks(), dtype, width)
        y, w = (part.column(c).to_numpy().astype(np.int64) for c in ("y", "w"))
        piece = grow(x, y, w, np.array([key], np.int64).view(np.uint64)[0], o, part.column("depth")[0].as_py())
        return pa.Table.from_batches([_table([(tree, key, piece)])])
    return rows.groupBy("tree", "key").applyInArrow(run, TREES)


@dataclass
class ForestModel:
    """A stored table of tree pieces; ``score`` adds the mean share of class 1 over the trees."""
    pieces: DataFrame
    options: Options
    bins: Bins | None
    width: int
    features: str = "features"
    size: int = field(default=0)

    def __post_init__(self):
        if not self.size:
            self.size = int(self.pieces.agg(F.sum(sum((F.length(k) for k in Piece.KINDS), F.lit(0)))).first()[0] or 0)

    def _coded(self, x: np.ndarray) -> np.ndarray:
        return self.bins.codes(x) if self.bins else x.astype(np.float32)

    def transform(self, df: DataFrame, task_bytes: int = MODEL_BYTES) -> DataFrame:
        linked = not self.pieces.filter("length(link) > 0").isEmpty()
        return self._streamed(df, task_bytes) if linked or self.size > task_bytes else self._whole(df)

    def _whole(self, df: DataFrame) -> DataFrame:
        """All trees go to every task: their size was checked."""
        rows = self.pieces.orderBy("tree").collect()
        trees = df.sparkSession.sparkContext.broadcast([tuple(bytes(r[k]) for k in Piece.KINDS) for r in rows])
        bins, width = self.bins, self.width

        @F.arrow_udf("double")
        def run(col: pa.Array) -> pa.Array:
            x = dense(col, width)
            x = bins.codes(x) if bins else x.astype(np.float32)
            total = np.zeros(len(x))
            for t in trees.value:
                piece = Piece.unpack(*t)
                total += piece.value[piece.nodes(x)]
            return pa.array(total / max(1, len(trees.value)))
        return df.withColumn("score", run(as_array(df, self.features)))

    def _streamed(self, df: DataFrame, task_bytes: int) -> DataFrame:
        """Rows meet groups of trees of ``task_bytes`` in sorted streams; linked pieces follow in a second one."""
        spark = df.sparkSession
        given = stored(df.withColumn("__row", F.monotonically_increasing_id()), "forest-input")
        bins, width, dtype = self.bins, self.width, "uint8" if self.bins else "float32"

        def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                x = dense(b.column(1), width)
                yield pa.RecordBatch.from_arrays([b.column(0), binary(bins.codes(x) if bins else x.astype(np.float32))], ["row", "x"])
        rows = stored(given.select("__row", as_array(given, self.features).alias("x")).mapInArrow(code, "row long, x binary"), "forest-rows")
        first = [signed(root_key(self.options, t)) for t in range(self.options.trees)]
        roots = spark.createDataFrame(list(enumerate(first)), "tree int, key long")
        tops = self.pieces.join(F.broadcast(roots), ["tree", "key"])  # one row a tree
        groups = max(1, math.ceil(int(tops.agg(F.sum(sum((F.length(k) for k in Piece.KINDS), F.lit(0)))).first()[0] or 0) / task_bytes))
        shares = max(1, math.ceil(spark.sparkContext.defaultParallelism / groups))
        none = [F.lit(None).cast("binary").alias(k) for k in Piece.KINDS]
        part = ["g", "s"]
        trees = tops.select(F.pmod(F.hash("tree"), F.lit(groups)).alias("g"), F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("s"),
                            F.lit(-1).cast("long").alias("row"), F.lit(None).cast("binary").alias("x"), "tree", *Piece.KINDS)
        asked = rows.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.pmod(F.hash("row"), F.lit(shares)).alias("s"), "row", "x",
                            F.lit(None).cast("int").alias("tree"), *none)
        found = _stream(trees.unionByName(asked), part, groups * shares, width, dtype)
        found = stored(found, "forest-votes")
        later = found.filter("link is not null")
        votes = found.filter("link is null").select("row", "value")
        if not later.isEmpty():
            below = self.pieces.join(F.broadcast(roots), ["tree", "key"], "left_anti")
            trees = below.select(F.col("tree").alias("g"), F.col("key").alias("s"), F.lit(-1).cast("long").alias("row"), F.lit(None).cast("binary").alias("x"),
                                 "tree", *Piece.KINDS)
            asked = later.select(F.col("tree").alias("g"), F.col("link").alias("s"), "row", "x", F.lit(None).cast("int").alias("tree"), *none)
            votes = votes.unionByName(_stream(trees.unionByName(asked), part, None, width, dtype).select("row", "value"))
        mean = votes.groupBy("row").agg((F.sum("value") / F.lit(float(self.options.trees))).alias("score"))
        return given.join(mean, F.col("__row") == F.col("row"), "left").drop("__row", "row")

    def save(self, path: str) -> None:
        spark = self.pieces.sparkSession
        self.pieces.write.mode("overwrite").parquet(f"{path}/trees")
        meta = {"options": asdict(self.options), "cuts": None if self.bins is None else [c.tolist() for c in self.bins.cuts],
                "width": self.width, "features": self.features, "size": self.size}
        spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ForestModel:
        meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
        bins = None if meta["cuts"] is None else Bins([np.array(c) for c in meta["cuts"]])
        return cls(spark.read.parquet(f"{path}/trees"), Options(**meta["options"]), bins, meta["width"], meta["features"], meta["size"])


def _stream(both: DataFrame, part: list[str], parts: int | None, width: int, dtype: str) -> DataFrame:
    """(row, value, link, tree, x): votes of the pieces that lead each part's stream, for the rows that follow them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, trees = None, []
        for b in batches:
            g, s, row = (b.column(c).to_numpy() for c in range(3))
            cuts = np.flatnonzero((np.diff(g) != 0) | (np.diff(s) != 0) | ((row[1:] < 0) != (row[:-1] < 0))) + 1
            for start, end in zip([0, *cuts], [*cuts, len(row)], strict=True):
                if end == start:
                    continue
                if (g[start], s[start]) != now:
                    now, trees = (g[start], s[start]), []
                piece = b.slice(start, end - start)
                if row[start] < 0:
                    for tree, *arrays in zip(*(piece.column(c).to_pylist() for c in range(4, 10)), strict=True):
                        trees.append((tree, Piece.unpack(*arrays)))
                    continue
                x, rows = cells(piece.column(3), dtype, width), row[start:end]
                total = np.zeros(len(rows))
                for tree, p in trees:
                    at = p.nodes(x)
                    link = p.link[at]
                    total += np.where(link == 0, p.value[at], 0)
                    on = np.flatnonzero(link)
                    if len(on):
                        yield pa.RecordBatch.from_arrays([pa.array(rows[on]), pa.nulls(len(on), pa.float64()), pa.array(link[on]),
                                                          pa.array(np.full(len(on), tree, np.int32)), piece.column(3).take(pa.array(on))],
                                                         ["row", "value", "link", "tree", "x"])
                n = len(rows)
                yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(total), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())],
                                                 ["row", "value", "link", "tree", "x"])
    spread = both.repartition(*([parts] if parts else []), *part)
    return spread.sortWithinPartitions(*part, "row").mapInArrow(run, "row long, value double, link long, tree int, x binary")


def fit(df: DataFrame, options: Options, features: str = "features", label: str = "label", id_col: str = "case_id",
        task_rows: int | None = None, group: int = GROUP) -> ForestModel:
    """A forest; ``task_rows`` (by default what ``HELD`` cells allow) is the largest node that one task grows."""
    bins = None if options.random_cuts else Bins.fit(df, features)
    width = width_of(df, features)
    m = matrix(df, features, label, id_col, bins, width)
    if task_rows is None and m.held:
        pieces = _fit_held(m, options)
    else:
        pieces = _fit_spread(m, options, task_rows or HELD // max(1, width), group)
    return ForestModel(pieces, options, bins, width, features)


def search(m: Matrix, looks: list[str], depths: list[int | None], counts: list[int], folds: int, seed: int = 42) -> DataFrame:
    """(looks, max_depth, trees, fold, accuracy) of every point of a grid, on the rows of each ``fold`` of a held matrix.

    Trees are grown once per (looks, fold), without limit of depth: a tree cut off at some depth is the
    tree of that depth, and the first trees of a forest are the smaller forest.
    """
    spark = m.rows.sparkSession
    uid, y, x = m.collect()
    fold = m.rows.select("uid", "fold").toArrow().to_pandas().sort_values("uid", kind="stable")["fold"].to_numpy()
    data = spark.sparkContext.broadcast((uid, y, x, fold))
    ends = sorted(set(counts))
    blocks = []
    for since, until in zip([0, *ends], ends, strict=False):
        blocks += [(t, min(until, t + 10)) for t in range(since, until, 10)]
    jobs = [(k, f, a, b) for a, b in blocks for k in looks for f in range(folds)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uid, y, x, fold = data.value
        for b in batches:
            for k, f, since, until in zip(*(c.to_pylist() for c in b.columns), strict=True):
                train, test = fold != f, fold == f
                o = Options(trees=until, looks=k, seed=seed)
                x1, y1, uid1, x2 = x[train], y[train], uid[train], x[test]
                columns, total = Columns(x1), np.zeros((len(depths), len(x2)))
                for tree in range(since, until):
                    piece = grow(x1, y1, weights(o, tree, uid1), root_key(o, tree), o, columns=columns)
                    for i, d in enumerate(depths):
                        total[i] += piece.value[piece.nodes(x2, d)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(depths)), pa.array([f] * len(depths), pa.int32()), pa.array(np.arange(len(depths), dtype=np.int32)),
                     pa.array([until] * len(depths), pa.int32()), pa.array([t.tobytes() for t in total], pa.binary())],
                    ["looks", "fold", "depth", "until", "votes"])

    def staged(part: pa.Table) -> pa.Table:
        rows = sorted(part.to_pylist(), key=lambda r: r["until"])
        truth = data.value[1][data.value[3] == rows[0]["fold"]]
        total, out = 0.0, []
        for r in rows:
            total = total + np.frombuffer(r["votes"])
            if r["until"] in ends:
                right = ((total / r["until"] > 0.5) == truth).mean() if len(truth) else None
                out.append({"looks": r["looks"], "max_depth": depths[r["depth"]], "trees": r["until"], "fold": r["fold"], "accuracy": right})
        return pa.Table.from_pylist(out, pa.schema([("looks", pa.string()), ("max_depth", pa.int32()), ("trees", pa.int32()),
                                                    ("fold", pa.int32()), ("accuracy", pa.float64())]))
    frame = spark.createDataFrame(jobs, "looks string, fold int, since int, until int").repartition(len(jobs))
    votes = stored(frame.mapInArrow(run, "looks string, fold int, depth int, until int, votes binary"), "forest-search")
    return votes.groupBy("looks", "fold", "depth").applyInArrow(staged, "looks string, max_depth int, trees int, fold int, accuracy double")
