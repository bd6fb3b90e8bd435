"""SimHash near-duplicate groups by a Gray-order hierarchical index.

A text's fingerprint has one bit per position that is set in more than half of its
shingle hashes (XXH64).  Two fingerprints link when at most ``max_bits`` bits differ;
a document's component is everything reachable over links.

How links are found:

1. Equal fingerprints collapse first (partial aggregation), so a group of exact copies
   of any size is one entry.
2. Entries meet in buckets.  Of ``max_bits + 1`` bit segments at least one is equal in
   a linked pair, so each entry goes to one bucket per segment, keyed by the segment's
   leading bits (as many as keep a bucket near ``target`` entries).  A bucket that is
   still larger than ``cap`` is split again by the same argument over its remaining
   bits, until it is small; no bucket is cut or sampled.
3. Inside a bucket, entries are sorted by Gray rank, runs of ``FAN`` become nodes, and
   the bits all children share (mask and pattern) are factored out of the children
   into the node.  A search adds up differences from the top and drops a whole node as
   soon as the sum passes ``max_bits``.
4. A bucket returns a star per local component (never all pairs); Spark joins the
   stars into components by alternating large-star and small-star rounds.

Defined edge cases: a null or empty text, or one without words, has fingerprint zero
and links like any other; a text of fewer words than a shingle is one shingle; a null
id takes part, and a component's id is its smallest non-null id (null if it has none);
repeated rows each get a result row; an empty table gives an empty result; further
columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewise.llm.common import stored, text_hash
from casewise.session import cut_lineage

FAN = 16
SEED = 42
ALL = (1 << 64) - 1


def simhash(raw: bytes | None, shingle: int = 3) -> int:
    """64-bit fingerprint of UTF-8 text; A-Z is lower-cased, words end at ASCII white space."""
    words = (raw or b"").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, n)
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: n - shingle + 1].tolist()
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:].tolist(), strict=True)]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = np.array(hashes[at:at + 65536], np.uint64).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, th, fp) for every row: th identifies the text's content, fp is the fingerprint as a signed long."""
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), text_hash(text_col).alias("th"),
                         F.col(text_col).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [simhash(x, shingle) for x in b.column(2).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.array(fp, np.uint64).view(np.int64))], ["id", "th", "fp"])

    return narrow.mapInArrow(run, "id long, th struct<a: long, b: long>, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each value in the reflected Gray sequence."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


class GrayIndex:
    """Static tree over fingerprints in Gray order; ``levels[0]`` holds the entries themselves."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps[np.argsort(gray_rank(fps))]
        low, high = self.fps, self.fps
        shared = np.full(len(self.fps), ALL, np.uint64)
        self.levels = [(self.fps, shared)]
        while len(low) > FAN:
            cuts = np.arange(0, len(low), FAN)
            low, high = np.bitwise_and.reduceat(low, cuts), np.bitwise_or.reduceat(high, cuts)
            parent = ~(low ^ high)
            pattern, mask = self.levels[-1]
            self.levels[-1] = (pattern, mask & ~np.repeat(parent, FAN)[: len(mask)])
            self.levels.append((low, parent))

    def search(self, at: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions (query, entry) with at most ``max_bits`` differing bits; queries are entries ``at``."""
        top = len(self.levels[-1][0])
        who, node = np.repeat(at, top), np.tile(np.arange(top), len(at))
        far = np.zeros(len(who), np.uint8)
        for depth in range(len(self.levels) - 1, -1, -1):
            pattern, mask = self.levels[depth]
            far = far + np.bitwise_count((self.fps[who] ^ pattern[node]) & mask[node])
            stay = far <= max_bits
            who, node, far = who[stay], node[stay], far[stay]
            if depth:
                size = len(self.levels[depth - 1][0])
                node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                who, far = np.repeat(who, FAN), np.repeat(far, FAN)
                inside = (node < size) & ((depth > 1) | (node > who))
                who, node, far = who[inside], node[inside], far[inside]
        return who, node


def bucket_stars(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(entry, root) for each entry of a bucket that is not the root of its local component."""
    index = GrayIndex(fps)
    n = len(index.fps)
    root = np.arange(n)
    step = max(1, 2_000_000 // max(n, 1))
    for begin in range(0, n, step):
        a, b = index.search(np.arange(begin, min(n, begin + step)), max_bits)
        a, b = root[a], root[b]
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1)[a != b], axis=0)
        for x, y in pairs.tolist():
            while root[x] != x:
                x = root[x]
            while root[y] != y:
                y = root[y]
            root[max(x, y)] = min(x, y)
        while (root != (up := root[root])).any():
            root = up
    other = np.flatnonzero(root != np.arange(n))
    return index.fps[other], index.fps[root[other]]


def _thirds(free: list[int], parts: int) -> list[list[int]]:
    """Bit positions cut into ``parts`` runs of like length."""
    return [list(x) for x in np.array_split(np.array(free, int), parts)]


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, max_bits: int = 2, target: int = 4096, cap: int = 65536) -> DataFrame:
    """Stars (u, v) over distinct fingerprints ``fp`` whose closure is the link relation."""
    n = fps.count()
    lead = int(np.ceil(np.log2(max(1.0, n / target))))
    segments = _thirds(list(range(63, -1, -1)), max_bits + 1)
    masks = sorted({_mask([int(b) for b in s[:lead]]) for s in segments})
    keyed = fps.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    keyed = keyed.withColumn("val", F.col("fp").bitwiseAND(F.col("mask")))
    ready = []
    while True:
        big = keyed.groupBy("mask", "val").count().filter(F.col("count") > cap).select("mask", "val")
        big = cut_lineage(big)
        finer = {m: sorted({m | _mask([int(b) for b in s]) for s in
                            _thirds([b for b in range(63, -1, -1) if not m >> b & 1], max_bits + 1) if s})
                 for m in masks}
        if big.isEmpty() or not any(finer.values()):
            ready.append(keyed)
            break
        ready.append(keyed.join(big, ["mask", "val"], "left_anti"))
        over = keyed.join(big, ["mask", "val"], "left_semi")
        to = F.create_map(*[x for m, subs in finer.items() for x in (
            F.lit(_signed(m)), F.array(*[F.lit(_signed(s)) for s in subs]))])
        keyed = over.select("fp", F.explode(to[F.col("mask")]).alias("mask"))
        keyed = keyed.withColumn("val", F.col("fp").bitwiseAND(F.col("mask"))).distinct()
        masks = sorted({s for subs in finer.values() for s in subs})

    def run(group: pd.DataFrame) -> pd.DataFrame:
        u, v = bucket_stars(group["fp"].to_numpy(np.int64).view(np.uint64), max_bits)
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    found = [x.groupBy("mask", "val").applyInPandas(run, "u long, v long") for x in ready]
    out = found[0]
    for x in found[1:]:
        out = out.union(x)
    return out


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    out = both.join(least, "u").filter(F.col("v") > F.col("u"))
    return out.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    far = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return far.union(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): each node that is not the smallest of its component, with that smallest node."""
    def state(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = cut_lineage(edges.filter("u != v").distinct())
    before = state(edges)
    if not before[0]:
        return edges
    while True:
        edges = cut_lineage(_small_star(_large_star(edges)))
        now = state(edges)
        if now == before:
            return edges
        before = now


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
            max_bits: int = 2, target: int = 4096, cap: int = 65536) -> DataFrame:
    """(id, th, fp, root, component) for every row of ``docs``; root names the component's smallest fingerprint."""
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    per_fp = cut_lineage(rows.groupBy("fp").agg(F.min("id").alias("low")))
    stars = components(links(per_fp.select("fp"), max_bits, target, cap))
    rooted = per_fp.join(stars.withColumnRenamed("u", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("v", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("low").alias("component"))
    return rows.join(rooted.select("fp", "root").join(least, "root"), "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, **index) -> DataFrame:
    """(id_col, fingerprint as 16 hex digits, component_id) for every row of ``docs``."""
    g = grouped(docs, id_col, text_col, shingle, max_bits, **index)
    return g.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.col("component").alias("component_id"))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                  max_bits: int = 2, **index) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the smallest id (ties: smallest text hash), once.

    A component whose ids are all null keeps the row with the smallest text hash.
    """
    g = grouped(docs, id_col, text_col, shingle, max_bits, **index)
    pick = F.struct(F.col("id").isNull().alias("none"), "id", "th")
    keep = g.groupBy("root").agg(F.min(pick).alias("k"))
    keep = keep.select(F.col("k.id").alias("k_id"), F.col("k.th").alias("k_th"))
    own = [f"d_{i}" for i in range(len(docs.columns))]
    d = docs.toDF(*own)
    at = dict(zip(docs.columns, own, strict=True))
    d = d.withColumns({"r_id": F.col(at[id_col]).cast("long"), "r_th": text_hash(at[text_col])})
    kept = d.join(keep, F.col("r_id").eqNullSafe(F.col("k_id")) & (F.col("r_th") == F.col("k_th")), "left_semi")
    if not g.groupBy("id", "th").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates(["r_id", "r_th"])
    return kept.select(*own).toDF(*docs.columns)

