"""Exact duplicates by a minimal perfect hash over historical digests.

Texts are equal when they are identical after deleting ASCII white space; their SHA-256 is
the digest.  Of equal texts the row with the most code points in its own text stays, then the
smallest id.

1. History: rows are grouped by digest (map-side combine first, so a group of copies of any
   size shuffles as a few rows).  Distinct digests are dealt into buckets of about ``SLOTS``
   by hash, and each bucket builds a minimal perfect hash: at every level the keys left are
   hashed into a bit array, a key that is alone on its bit is placed, the others go one level
   down.  A key's slot is the number of set bits before its own.  A slot holds the full digest
   and the winner's locator (id, code points, row number) with the number of its rows.
2. The index is a table of plain rows: per bucket one row with the level bits, then its slots
   in order.  It can be kept and read again by later runs.
3. New rows are grouped by digest too and meet the index bucket by bucket in one sorted
   stream, which holds one bucket's slots at a time, however many lookups follow.  The hash
   gives each digest one slot; all 32 bytes must agree.  Members are merged into the slot
   (repeats go, unless the new row wins), nonmembers form groups of their own.
4. Rows find their group by digest.  Groups of more than 1 / ``HOT`` of all rows (fewer than
   ``HOT``, whatever the table's size) are broadcast, so no task receives a hot group.

Defined edge cases: a null text counts as empty, and empty texts are equal to each other and
to texts of white space; a null id comes after all others, a group without any id has a null
keep_id; of repeated equal rows one stays; an empty table (or history) gives an empty result
(or index); further columns of the input, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewise.llm.common import stored

#: Digests per bucket, about: bounds what a task holds (some 100 bytes a slot).
SLOTS = 32768
#: Groups above this fraction of all rows are broadcast; there are fewer than HOT of them.
HOT = 1024
#: Levels of the hash; keys still unplaced then are listed in full (practically none).
LEVELS = 40
GAMMA = 1.5
SPACE = " \t\n\x0b\x0c\r"
INDEX = "bucket int, slot long, digest binary, id long, n_chars long, uid long, n long, sizes array<int>, bits binary"
GROUPS = "digest binary, id long, n_chars long, uid long, n long, known boolean"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", history: Column | None = None) -> DataFrame:
    """(uid, id, n_chars, digest, old) for every row; ``history`` marks the rows seen before."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    old = F.lit(False) if history is None else F.coalesce(history, F.lit(False))
    return docs.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{id_col}`").cast("long").alias("id"),
                       F.length(text).cast("long").alias("n_chars"),
                       F.unhex(F.sha2(F.translate(text, SPACE, ""), 256)).alias("digest"), old.alias("old"))


def groups(rows: DataFrame) -> DataFrame:
    """One row per digest: its winner (id, n_chars, uid) and its number of rows."""
    best = F.struct((-F.col("n_chars")).alias("short"), F.col("id").isNull().alias("none"), "id", "uid")
    g = rows.groupBy("digest").agg(F.min(best).alias("w"), F.count("*").alias("n"))
    return g.select("digest", "w.id", (-F.col("w.short")).alias("n_chars"), "w.uid", "n")


def _positions(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Bit of each key at a level: two of its four words, mixed."""
    with np.errstate(over="ignore"):
        x = words[:, level % 4] + words[:, (level // 4 + level + 1) % 4] * np.uint64(2 * level + 3)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash of 32-byte keys, from its level sizes and bits."""

    def __init__(self, sizes: list[int], bits: bytes):
        self.sizes = sizes
        raw = np.frombuffer(bits, np.uint8)
        self.bits, self.before, at, placed = [], [], 0, 0
        for size in sizes:
            width = -(-size // 8)
            level = np.unpackbits(raw[at:at + width], count=size).astype(bool)
            self.bits.append(level)
            self.before.append(placed + np.cumsum(level) - level)
            placed += int(level.sum())
            at += width
        self.placed = placed

    @classmethod
    def build(cls, words: np.ndarray) -> tuple[PerfectHash, bytes]:
        left, sizes, bits = words, [], []
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(64, int(GAMMA * len(left)))
            at = _positions(left, level, size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(np.packbits(alone).tobytes())
            left = left[~alone[at]]
        packed = b"".join(bits)
        return cls(sizes, packed), packed

    def slots(self, words: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 if no level places it; a key that was not built in may get any slot."""
        out = np.full(len(words), -1, np.int64)
        left = np.arange(len(words))
        for level, size in enumerate(self.sizes):
            at = _positions(words[left], level, size)
            here = self.bits[level][at]
            out[left[here]] = self.before[level][at[here]]
            left = left[~here]
        return out


def _bytes(col: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, 32)


def _words(raw: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(raw).view(np.uint64).reshape(-1, 4)


def _long(col: pa.Array) -> np.ndarray:
    """A long column with nulls as the smallest long."""
    return col.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


def _maybe(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=values == np.iinfo(np.int64).min)


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Pieces of sorted batches that belong to one value of the first column."""
    for b in batches:
        key = b.column(0).to_numpy()
        cuts = np.flatnonzero(np.diff(key)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(key)], strict=True):
            if end > start:
                yield int(key[start]), b.slice(start, end - start)


def build_index(history: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The stored index table over ``groups`` of historical rows."""
    kept = stored(history, "perfect-history")
    buckets = max(1, math.ceil(kept.count() / slots))

    def emit(bucket: int, pieces: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = np.concatenate([_bytes(p.column(1)) for p in pieces])
        cols = [np.concatenate([_long(p.column(c)) for p in pieces]) for c in range(2, 6)]
        words = _words(raw)
        built, packed = PerfectHash.build(words)
        slot = built.slots(words)
        rest = np.flatnonzero(slot < 0)
        slot[rest] = built.placed + np.arange(len(rest))
        order = np.argsort(slot)
        schema = pa.schema([("bucket", pa.int32()), ("slot", pa.int64()), ("digest", pa.binary()), ("id", pa.int64()),
                            ("n_chars", pa.int64()), ("uid", pa.int64()), ("n", pa.int64()),
                            ("sizes", pa.list_(pa.int32())), ("bits", pa.binary())])
        yield pa.RecordBatch.from_pylist([{"bucket": bucket, "slot": -1, "sizes": built.sizes, "bits": packed}], schema)
        n = len(order)
        sorted_raw = raw[order]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, bucket, np.int32)), pa.array(np.arange(n, dtype=np.int64)),
             pa.array([r.tobytes() for r in sorted_raw], pa.binary()), *[_maybe(c[order]) for c in cols],
             pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, pieces = None, []
        for bucket, piece in _by_bucket(batches):
            if pieces and bucket != now:
                yield from emit(now, pieces)
                pieces = []
            now = bucket
            pieces.append(piece)
        if pieces:
            yield from emit(now, pieces)

    dealt = kept.select(F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int").alias("bucket"), "digest", "id", "n_chars", "uid", "n")
    return stored(dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, INDEX), "perfect-index")


class Slots:
    """One bucket of the index, filled from a sorted stream."""

    def __init__(self):
        self.hash, self.pieces, self.raw = None, [], None

    def add(self, piece: pa.RecordBatch) -> None:
        bits = piece.column(8)
        if bits[0].is_valid:
            self.hash = PerfectHash(piece.column(7)[0].as_py(), bits[0].as_py())
            piece = piece.slice(1)
        if len(piece):
            self.pieces.append(piece)

    def ready(self) -> None:
        self.raw = np.concatenate([_bytes(p.column(2)) for p in self.pieces]) if self.pieces else np.zeros((0, 32), np.uint8)
        self.best = [np.concatenate([_long(p.column(c)) for p in self.pieces]) if self.pieces else np.zeros(0, np.int64) for c in range(3, 7)]
        self.pieces = []

    def look_up(self, raw: np.ndarray) -> np.ndarray:
        """Slot of each digest whose bytes agree, else -1."""
        if self.hash is None or not len(self.raw):
            return np.full(len(raw), -1, np.int64)
        at = self.hash.slots(_words(raw))
        for k in np.flatnonzero(at < 0):  # digests that no level places are listed after the placed ones
            listed = np.flatnonzero((self.raw[self.hash.placed:] == raw[k]).all(1))
            at[k] = self.hash.placed + listed[0] if len(listed) else -1
        same = at >= 0
        same[same] = (self.raw[at[same]] == raw[same]).all(1)
        return np.where(same, at, -1)

    def merge(self, at: np.ndarray, new: list[np.ndarray]) -> None:
        """New groups (one per slot) join their slots; the better winner stays."""
        low = np.iinfo(np.int64).min
        ids, chars, uids, n = (c[at] for c in self.best)
        n_ids, n_chars, n_uids, n_n = new
        old_key = np.stack([-chars, ids == low, ids, uids])
        new_key = np.stack([-n_chars, n_ids == low, n_ids, n_uids])
        wins, tied = np.zeros(len(at), bool), np.ones(len(at), bool)
        for a, b in zip(new_key, old_key, strict=True):
            wins |= tied & (a < b)
            tied &= a == b
        for c, v in zip(self.best[:3], (n_ids, n_chars, n_uids), strict=True):
            c[at[wins]] = v[wins]
        self.best[3][at] = n + n_n

    def groups(self) -> pa.RecordBatch:
        return _groups(self.raw, self.best, True)


def _groups(raw: np.ndarray, cols: list[np.ndarray], known: bool) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r.tobytes() for r in raw], pa.binary()), *[_maybe(c) for c in cols], pa.array(np.full(len(raw), known))],
        ["digest", "id", "n_chars", "uid", "n", "known"])


def look_up(index: DataFrame, fresh: DataFrame) -> DataFrame:
    """All groups after ``fresh`` (as ``groups`` returns) met the index: every slot, then the nonmembers' own groups."""
    top = index.agg(F.max("bucket")).first()[0]
    buckets = 1 if top is None else top + 1
    asked = fresh.select(F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int").alias("bucket"), F.lit(1 << 62).alias("slot"),
                         "digest", "id", "n_chars", "uid", "n", F.lit(None).cast("array<int>").alias("sizes"),
                         F.lit(None).cast("binary").alias("bits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, slots = None, Slots()
        for bucket, piece in _by_bucket(batches):
            if bucket != now:
                if now is not None:
                    if slots.raw is None:
                        slots.ready()
                    yield slots.groups()
                now, slots = bucket, Slots()
            held = int(np.searchsorted(piece.column(1).to_numpy(), 1 << 62))
            if held:
                slots.add(piece.slice(0, held))
            if held < len(piece):
                if slots.raw is None:
                    slots.ready()
                ask = piece.slice(held)
                raw, cols = _bytes(ask.column(2)), [_long(ask.column(c)) for c in range(3, 7)]
                at = slots.look_up(raw)
                member = at >= 0
                slots.merge(at[member], [c[member] for c in cols])
                yield _groups(raw[~member], [c[~member] for c in cols], False)
        if now is not None:
            if slots.raw is None:
                slots.ready()
            yield slots.groups()

    met = index.unionByName(asked).repartition("bucket").sortWithinPartitions("bucket", "slot")
    return met.mapInArrow(run, GROUPS)


def dedup(docs: DataFrame, history: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          slots: int = SLOTS) -> DataFrame:
    """(id_col, keep_id, group_size, kept, text_sha256, known) for every row of ``docs``.

    ``history`` selects the rows that were there before; ``known`` tells whether the text occurs among them.
    """
    rows = stored(digests(docs, id_col, text_col, history), "perfect-digests")
    index = build_index(groups(rows.filter("old")), slots)
    found = stored(look_up(index, groups(rows.filter("not old"))), "perfect-groups")
    found = found.select("digest", F.col("id").alias("keep_id"), F.col("uid").alias("keep_uid"), F.col("n").alias("group_size"), "known")
    large = F.col("group_size") > F.lit(rows.count() / HOT)
    hot = F.broadcast(found.filter(large))  # fewer than HOT rows
    out = rows.join(hot, "digest").unionByName(
        rows.join(hot.select("digest"), "digest", "left_anti").join(found.filter(~large), "digest"))
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"), "known")

