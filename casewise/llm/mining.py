"""Hard negatives by anchor-clustered shared lists (the MAXIMUS scheme).

Vectors become integers (floor of ``scale`` times each component); a row's score is its inner
product with the anchor.  An anchor's positives are its best rows of its own label; for each
positive the best rows of other labels whose score lies in a window around a share of the
positive's score are its hard negatives.

How rows are found:

1. Anchors are clustered by direction (spherical k-means fitted on a bounded sample of them)
   and cut into clusters of at most ``CHUNK`` members; each cluster has a mean direction and the
   largest angle of a member to it.  All rows are put into blocks of about ``BLOCK`` rows of
   like direction, each with its mean direction, largest angle and largest norm.
2. Inside a block, a cluster sorts the rows once by their angular upper bound: norm times the
   cosine of (angle to the cluster's direction less the cluster's largest angle), which no
   member can beat.  Every member walks that one list from the top, a page of scores at a time
   (one matrix product for all members still walking), until the bound times its own norm falls
   below what it still needs for every one of its searches: the lower end of the window, or
   the k-th best score found, whichever is higher.
3. What a member needs is global, not per block: a first walk over one block near the cluster
   gives each search its k-th best score there, a valid lower bound for the whole table.  Pairs
   of block and cluster whose directions rule out every member's need are dropped before any
   vector is copied, on summaries alone.
4. Winners of all blocks meet in one window per search, k rows a block at most.

Positives and negatives are the same search with another label test, window and k.

Defined edge cases: rows with a null id or label, a null vector or a null or non-finite
component take no part; vectors of different lengths do not meet; an empty or zero vector has
score 0 with all others; repeated rows count as often as they occur, but one of the anchor's own
row is neither positive nor negative; equal anchors answer once; of equal scores the smaller id
comes first, and rows that share id and score are told apart by label and vector; a label outside
0 to 9 stays one where the labels are not changed; a component or score that does not fit
a long is an error; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewise.llm.common import stored

#: Rows of a block, members of a cluster, rows scored at a time: what a task holds at once.
BLOCK = 8192
CHUNK = 256
PAGE = 512
#: Directions that blocks and clusters are grouped by, and the anchors that they are fitted on.
CENTRES = 64
SAMPLE = 4096
LOW, HIGH = -(1 << 62), 1 << 62
#: Bounds are raised by this share of the largest possible score: angles are not exact.
SLACK = 1e-7


def integers(vectors: DataFrame, scale: int, label: Column, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, label, v, n): the distinct rows that take part, with the number of equal rows."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    large = F.raise_error(F.lit(f"a component times {scale} does not fit a long"))
    fit = x.isNotNull() & F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), F.lit(False))
    v = F.transform(x, lambda c: F.when(F.abs(c * scale) < float(1 << 63), F.floor(c * scale)).otherwise(large))
    d = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), F.when(fit, v).alias("v"))
    return d.filter("id is not null and label is not null and v is not null").groupBy("id", "label", "v").agg(F.count("*").alias("n"))


def _directions(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    norm = np.sqrt((x * x).sum(-1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def fit_centres(anchors: DataFrame, centres: int = CENTRES, sample: int = SAMPLE, rounds: int = 8) -> np.ndarray:
    """Unit vectors of the sampled anchors' clusters; lengths other than the commonest are not looked at."""
    picked = anchors.orderBy(F.xxhash64("id", "label", "v")).limit(sample).select("v").collect()  # bounded by ``sample``
    by: dict[int, list] = {}
    for r in picked:
        by.setdefault(len(r.v), []).append(r.v)
    if not by:
        return np.zeros((1, 0))
    u = _directions(np.array(max(by.values(), key=len), np.float64).reshape(len(max(by.values(), key=len)), -1))
    c = u[: max(1, min(centres, len(u) // 16))]
    for _ in range(rounds):
        near = (u @ c.T).argmax(1)
        c = _directions(np.stack([u[near == j].sum(0) if (near == j).any() else c[j] for j in range(len(c))]))
    return c


def _vectors(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), dim)


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple[int, ...], list[pa.RecordBatch]]]:
    """(key, slices) for each run of rows that agree in their first ``keys`` columns, across batches."""
    now, held = None, []
    for b in batches:
        cols = [b.column(c).to_numpy() for c in range(keys)]
        cuts = np.flatnonzero(np.any([np.diff(c) != 0 for c in cols], axis=0)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(b)], strict=True):
            if end == start:
                continue
            key = tuple(int(c[start]) for c in cols)
            if held and key != now:
                yield now, held
                held = []
            now = key
            held.append(b.slice(start, end - start))
    if held:
        yield now, held


def _stacked(slices: list[pa.RecordBatch], col: int, width: int | None = None) -> np.ndarray:
    return np.concatenate([s.column(col).to_numpy() if width is None else _vectors(s.column(col), width) for s in slices])


def with_centre(rows: DataFrame, centres: np.ndarray) -> DataFrame:
    """Adds ``near``, the centre of each row (0 for other lengths), and ``dim``."""
    names = rows.columns
    at = names.index("v")
    width = centres.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = pc.list_value_length(b.column(at)).to_numpy()
            near = np.zeros(len(sizes), np.int32)
            same = np.flatnonzero(sizes == width)
            if len(same) and width:
                x = _vectors(b.column(at).take(pa.array(same)), width)
                near[same] = (x @ centres.T).argmax(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near), pa.array(sizes)], [*names, "near", "dim"])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{fields}, near int, dim int")


def _summary(x: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Mean direction, largest angle to it and largest norm of some vectors."""
    u = _directions(x)
    mean = _directions(u.sum(0))
    moved = (x != 0).any(-1)
    angle = float(np.arccos(np.clip(u[moved] @ mean, -1, 1)).max(initial=0)) if mean.any() else math.pi
    return mean, angle, float(np.sqrt((x.astype(np.float64) ** 2).sum(-1)).max(initial=0))


def summaries(rows: DataFrame) -> DataFrame:
    """(dim, part, mean, angle, norm) of each part of (dim, part, v)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (dim, part), held in _runs(batches, 2):
            mean, angle, norm = _summary(_stacked(held, 2, dim))
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([part], pa.int64()), pa.array([mean.tolist()], pa.list_(pa.float64())),
                 pa.array([angle]), pa.array([norm])], ["dim", "part", "mean", "angle", "norm"])
    parts = rows.select("dim", "part", "v").repartition("dim", "part").sortWithinPartitions("dim", "part")
    return parts.mapInArrow(run, "dim int, part long, mean array<double>, angle double, norm double")


class Cluster:
    """Anchors that share lists, with one or more searches each (windows ``lows`` to ``highs``, k rows)."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, keys: np.ndarray, x: np.ndarray, lows: np.ndarray, highs: np.ndarray, needs: np.ndarray,
                 same: bool, k: int):
        self.ids, self.labels, self.keys, self.x, self.same, self.k = ids, labels, keys, x, same, k
        self.lows, self.highs, self.needs = lows, highs, np.maximum(lows, needs)
        self.mean, self.angle, _ = _summary(x)
        self.norms = np.sqrt((x.astype(np.float64) ** 2).sum(1))
        self.walked = 0  # rows scored, summed over members

    def walk(self, ids: np.ndarray, labels: np.ndarray, keys: np.ndarray, x: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(member, search, rows, scores) with at most k rows for each search that has any."""
        n, m, wants = len(ids), len(self.x), self.lows.shape[1]
        reach = x.shape[1] * int(np.abs(x).max(initial=0)) * int(np.abs(self.x).max(initial=0))
        exact = reach < 1 << 53  # sums of doubles are exact
        norms = np.sqrt((x.astype(np.float64) ** 2).sum(1))
        angle = np.arccos(np.clip(_directions(x) @ self.mean, -1, 1)) if self.mean.any() else np.zeros(n)
        bound = norms * np.cos(np.maximum(0, angle - self.angle)) + SLACK * norms.max(initial=0)
        order = np.argsort(-bound, kind="stable")
        bound = bound[order]
        left, right = (self.x.astype(np.float64), x[order].T.astype(np.float64)) if exact else (self.x.astype(object), x[order].T.astype(object))
        own, own_id, row_label = keys[order], ids[order], labels[order]
        scores = np.zeros((m, n), np.int64)
        until = np.zeros(m, np.int64)
        needs = np.where(self.lows > self.highs, HIGH, self.needs)  # an empty window needs nothing
        best = np.full((m, wants, self.k), LOW)
        active = np.arange(m)
        for start in range(0, n, PAGE):
            # certified: no row from here on can reach what any search of the member still needs
            active = active[bound[start] * self.norms[active] + 1e-6 >= needs[active].min(1)] if len(active) else active
            if not len(active):
                break
            end = min(n, start + PAGE)
            page = left[active] @ right[:, start:end]
            page = page.astype(np.int64)  # a score that does not fit a long is an error
            scores[active, start:end] = page
            until[active] = end
            self.walked += len(active) * (end - start)
            usable = (self.labels[active, None] == row_label[start:end]) == self.same
            usable &= (self.keys[active, None] != own[start:end]) | (self.ids[active, None] != own_id[start:end])
            for w in range(wants):
                hit = usable & (page >= needs[active, w, None]) & (page <= self.highs[active, w, None])
                some = np.flatnonzero(hit.any(1))
                if len(some):
                    both = np.concatenate([best[active[some], w], np.where(hit[some], page[some], LOW)], 1)
                    top = np.partition(both, both.shape[1] - self.k, axis=1)[:, -self.k:]
                    best[active[some], w] = top
                    needs[active[some], w] = np.maximum(needs[active[some], w], top.min(1))
        for i in range(m):
            s = scores[i, : until[i]]
            usable = (row_label[: until[i]] == self.labels[i]) == self.same
            usable &= (own[: until[i]] != self.keys[i]) | (own_id[: until[i]] != self.ids[i])
            for w in range(wants):
                at = np.flatnonzero(usable & (s >= needs[i, w]) & (s <= self.highs[i, w]))
                if len(at):
                    at = at[np.lexsort((own[at], own_id[at], -s[at]))][: self.k]
                    yield i, w, order[at], s[at]


FOUND = "anchor long, key long, want int, score long, id long, other long"
ROW = ["dim", "part", "kind", "cluster", "id", "label", "key", "v", "lows", "highs", "needs"]


def _walks(blocks: DataFrame, members: DataFrame, wants: int, same: bool, k: int) -> DataFrame:
    """What ``members`` (dim, part: the block to walk, cluster, id, label, key, v, lows, highs, needs) find in ``blocks``.

    One sorted stream brings a block's rows, then cluster after cluster; a task holds one of each.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, at = None, None
        for (dim, part, kind, _), held in _runs(batches, 4):
            ids, labels, keys, x = *(_stacked(held, c) for c in (4, 5, 6)), _stacked(held, 7, dim)
            if kind == 0:
                block, at = (ids, labels, keys, x), (dim, part)
            elif at == (dim, part):
                found = list(Cluster(ids, labels, keys, x, *(_stacked(held, c, wants) for c in (8, 9, 10)), same, k).walk(*block))
                if found:
                    who = np.repeat([f[0] for f in found], [len(f[2]) for f in found])
                    rows = np.concatenate([f[2] for f in found])
                    want = np.repeat(np.array([f[1] for f in found], np.int32), [len(f[2]) for f in found])
                    cols = [ids[who], keys[who], want, np.concatenate([f[3] for f in found]), block[0][rows], block[2][rows]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["anchor", "key", "want", "score", "id", "other"])
    null = F.lit(None).cast("array<long>")
    first = blocks.withColumns({"kind": F.lit(0), "cluster": F.lit(-1).cast("long"), "lows": null, "highs": null, "needs": null})
    both = first.select(ROW).unionByName(members.withColumn("kind", F.lit(1)).select(ROW))
    return both.repartition("dim", "part").sortWithinPartitions("dim", "part", "kind", "cluster").mapInArrow(run, FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "key", "want").orderBy(F.desc("score"), "id", "other")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(blocks: DataFrame, shapes: DataFrame, anchors: DataFrame, searches: DataFrame, wants: int, same: bool, k: int,
           parts: int, homes: list[int]) -> DataFrame:
    """(anchor, key, want, rank, score, id, other): the k best rows of every search.

    ``blocks`` are rows with their part, of ``parts`` parts; ``shapes`` their summaries.  ``anchors`` have anchor,
    key, label, v, dim, cluster and home (a part near them, one of ``homes``); ``searches`` have anchor, key, lows and
    highs, arrays of ``wants`` window ends.
    """
    asked = anchors.join(searches, ["anchor", "key"]).withColumn("id", F.col("anchor"))
    asked = stored(asked.filter(F.exists(F.arrays_zip("lows", "highs"), lambda z: z["lows"] <= z["highs"])), "mining-searches")
    none = F.array_repeat(F.lit(LOW), wants)
    near = blocks.filter(F.col("part").isin(homes))  # a block per centre
    seed = _walks(near, asked.withColumn("needs", none).withColumn("part", F.col("home")), wants, same, k)
    kth = _best(seed, k).filter(F.col("rank") == k).select("anchor", "key", "want", "score")
    at = F.map_from_entries(F.collect_list(F.struct("want", "score")))  # ``wants`` entries at most
    needs = kth.groupBy("anchor", "key").agg(at.alias("m")).select("anchor", "key", F.transform(
        F.sequence(F.lit(0), F.lit(wants - 1)), lambda w: F.coalesce(F.col("m")[w], F.lit(LOW))).alias("needs"))
    ready = asked.join(needs, ["anchor", "key"], "left").withColumn("needs", F.coalesce("needs", none))
    # the least score for each unit of its length that a member still needs; its cluster's least rules out blocks
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    still = F.transform(F.arrays_zip("lows", "highs", "needs"), lambda z: F.when(z["lows"] <= z["highs"], F.greatest(z["lows"], z["needs"])))
    least = F.array_min(F.filter(still, lambda z: z.isNotNull()))
    ready = ready.withColumn("rate", F.when((norm > 0) & (least > LOW), (least - 1e-6) / norm).otherwise(float("-inf")))
    ready = stored(ready, "mining-needs")
    shape = summaries(ready.withColumn("part", F.col("cluster"))).toDF("dim", "cluster", "c_mean", "c_angle", "c_norm")
    shape = stored(shape.join(ready.groupBy("dim", "cluster").agg(F.min("rate").alias("rate")), ["dim", "cluster"]), "mining-shapes")
    # a cluster against every block, on summaries: no vector of a row is copied here
    every = F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))
    met = shape.withColumn("part", F.explode(every)).join(shapes, ["dim", "part"])
    cosine = F.aggregate(F.zip_with("mean", "c_mean", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    apart = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine))) - F.col("angle") - F.col("c_angle")
    reach = F.col("norm") * (F.cos(F.greatest(F.lit(0.0), apart)) + 1e-6)
    pairs = met.filter(reach >= F.col("rate")).select("dim", "cluster", "part")
    return _best(_walks(blocks, ready.join(pairs, ["dim", "cluster"]), wants, same, k), k)


def hard_negatives(vectors: DataFrame, anchors: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   scale: int = 256, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` tells by the column ``id`` which rows are anchors; ``label`` gives the label of a row.  A negative
    of a positive with score p has a score from ``low`` to ``high`` hundredths of p.
    """
    rows = stored(integers(vectors, scale, label, id_col, vector_col), "mining-vectors")
    centres = fit_centres(rows.filter(anchors))
    # more copies than any search returns, and one for the anchor itself, change nothing
    copies = rows.select("id", "label", "v", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(max(positives, negatives) + 1)).cast("int"))).alias("copy"))
    copies = stored(with_centre(copies.withColumn("key", F.xxhash64("id", "label", "v", "copy")), centres), "mining-rows")
    count = {r.near: r.n for r in copies.groupBy("near").agg(F.count("*").alias("n")).collect()}  # one row per centre
    subs = [max(1, math.ceil(count.get(j, 0) / block)) for j in range(len(centres))]
    start = [0, *np.cumsum(subs).tolist()]
    first = F.element_at(F.array(*[F.lit(s) for s in start[:-1]]), F.col("near") + 1)
    many = F.element_at(F.array(*[F.lit(s) for s in subs]), F.col("near") + 1)
    spread = F.pmod(F.xxhash64("key"), many.cast("long"))
    blocks = stored(copies.withColumn("part", first + spread).drop("near", "copy"), "mining-blocks")
    shapes = stored(summaries(blocks), "mining-summaries")

    chosen = copies.filter(anchors & (F.col("copy") == 1))
    members = {r.near: r.n for r in chosen.groupBy("near").agg(F.count("*").alias("n")).collect()}  # one row per centre
    cuts = [max(1, math.ceil(members.get(j, 0) / chunk)) for j in range(len(centres))]
    lead = [0, *np.cumsum(cuts).tolist()]
    own = F.element_at(F.array(*[F.lit(s) for s in lead[:-1]]), F.col("near") + 1)
    pieces = F.element_at(F.array(*[F.lit(s) for s in cuts]), F.col("near") + 1).cast("long")
    chosen = stored(chosen.select(F.col("id").alias("anchor"), "key", "label", "v", "dim", (own + F.pmod(F.xxhash64("key"), pieces)).alias("cluster"),
                                  first.cast("long").alias("home")), "mining-anchors")

    free = chosen.select("anchor", "key", F.array(F.lit(LOW)).alias("lows"), F.array(F.lit(HIGH)).alias("highs"))
    good = stored(search(blocks, shapes, chosen, free, 1, True, positives, start[-1], start[:-1]), "mining-positives")
    # no score lies between two negative shares
    least = F.when(F.col("score") >= 0, F.expr(f"({low} * cast(score as decimal(38, 0)) + 99) div 100")).otherwise(1)
    most = F.when(F.col("score") >= 0, F.expr(f"({high} * cast(score as decimal(38, 0))) div 100")).otherwise(0)
    at = F.map_from_entries(F.collect_list(F.struct("rank", F.struct(least.alias("lo"), most.alias("hi")))))  # ``positives`` entries at most
    windows = good.groupBy("anchor", "key").agg(at.alias("m"))
    ranks = F.sequence(F.lit(1), F.lit(positives))
    windows = windows.select("anchor", "key", F.transform(ranks, lambda r: F.coalesce(F.col("m")[r]["lo"], F.lit(1).cast("long"))).alias("lows"),
                             F.transform(ranks, lambda r: F.coalesce(F.col("m")[r]["hi"], F.lit(0).cast("long"))).alias("highs"))
    bad = search(blocks, shapes, chosen, windows, positives, False, negatives, start[-1], start[:-1])
    out = bad.select("anchor", "key", (F.col("want") + 1).alias("p_rank"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    pos = good.select("anchor", "key", F.col("rank").alias("p_rank"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return out.join(pos, ["anchor", "key", "p_rank"]).select(F.col("anchor").alias("anchor_id"), "positive_id", "rank", "negative_id",
                                                             "positive_score", "negative_score")
