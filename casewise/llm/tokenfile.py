"""Token-ID files: one concatenated id array per shard with Elias-Fano document boundaries.

Documents are encoded where they are read, appended the end id, and sent as packed ids
to the partition that holds their range of ids (cut points come from the id column
alone, so no text is read twice).  A partition, sorted by id, is cut into shards of
about ``shard_ids`` ids; each becomes one self-describing shard image, written by
Spark's Parquet writer as a binary cell, so that commits, retries and remote stores
work as for any other table.  Cells are small; a document is never cut.

Shard image, little-endian::

    magic "EFTOK1", u8 bytes per id (2 or 4), u8 low bits l, u64 documents, u64 ids,
    u32 bytes of high part, u32 select samples,
    low part   l bits for each of documents + 1 boundaries, packed
    high part  bitmap with bit (boundary >> l) + i set for boundary i
    samples    u32 place of every 64th set bit (select structure)
    ids        the concatenated ids

The boundaries cost about 2 + log2(ids / documents) bits each; there is no table of
64-bit offsets.  ``Shard.boundary(i)`` answers one by select; ``boundaries()`` all.

Defined edge cases: null text counts as empty (its only id is the end id); null ids come
first; repeated ids are ordered by their token ids; an empty table writes no shard and
reads back as an empty table; a document longer than a shard is a shard by itself.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewise.llm.common import range_bounds, shuffle_partitions
from casewise.llm.tokens import ChunkEncoder

MAGIC = b"EFTOK1"
HEAD = "<6sBBQQII"
EVERY = 64
SHARD_IDS = 2_000_000


def pack_shard(ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """Image of one shard; ``ids`` is uint16 or uint32, ``lengths`` the documents' id counts in order."""
    ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    n = len(ends)
    low_bits = max(0, int(ends[-1] // n).bit_length() - 1)
    low = (ends[:, None] >> np.arange(low_bits)) & 1
    at = (ends >> low_bits) + np.arange(n)
    high = np.zeros(int(at[-1]) + 1, np.uint8)
    high[at] = 1
    high_bytes = np.packbits(high, bitorder="little").tobytes()
    samples = at[::EVERY].astype("<u4")
    head = struct.pack(HEAD, MAGIC, ids.dtype.itemsize, low_bits, n - 1, len(ids), len(high_bytes), len(samples))
    return b"".join([head, np.packbits(low.astype(np.uint8).ravel(), bitorder="little").tobytes(), high_bytes,
                     samples.tobytes(), ids.astype(ids.dtype.newbyteorder("<")).tobytes()])


class Shard:
    """Reader of one shard image."""

    def __init__(self, image: bytes):
        magic, width, self.low_bits, self.docs, self.n_ids, high, samples = struct.unpack_from(HEAD, image)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        low = -(-(self.docs + 1) * self.low_bits // 8)
        at = struct.calcsize(HEAD)
        self.low = np.frombuffer(image, np.uint8, low, at)
        self.high = np.frombuffer(image, np.uint8, high, at + low)
        self.samples = np.frombuffer(image, "<u4", samples, at + low + high)
        self.ids = np.frombuffer(image, f"<u{width}", self.n_ids, at + low + high + 4 * samples)

    def _low(self, i: int) -> int:
        first, last = i * self.low_bits, (i + 1) * self.low_bits
        word = int.from_bytes(self.low[first // 8: -(-last // 8)].tobytes(), "little")
        return (word >> first % 8) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """Place of set bit ``i`` of the high part: from its sample on, whole bytes are skipped by their counts."""
        at, left = int(self.samples[i // EVERY]), i % EVERY
        byte = at // 8
        word = int(self.high[byte]) >> at % 8 << at % 8
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        return byte * 8 + (word & -word).bit_length() - 1

    def boundary(self, i: int) -> int:
        """Number of ids before document ``i`` (``docs``: of all)."""
        return (self.select(i) - i << self.low_bits) | (self._low(i) if self.low_bits else 0)

    def boundaries(self) -> np.ndarray:
        n = self.docs + 1
        upper = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:n] - np.arange(n)
        if not self.low_bits:
            return upper
        bits = np.unpackbits(self.low, bitorder="little")[: n * self.low_bits].reshape(n, self.low_bits)
        return (upper << self.low_bits) + bits.astype(np.int64) @ (1 << np.arange(self.low_bits))


def write_shards(docs: DataFrame, out: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", kind: str = "word", shard_ids: int = SHARD_IDS) -> None:
    """Encode ``docs`` and write their shards under ``out`` (a path that all executors see)."""
    parts = shuffle_partitions(docs.sparkSession)
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("t"))
    bounds = np.array(range_bounds(d.filter("id is not null"), "id", parts), np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = ChunkEncoder.get(tokenizer, kind)
        width = np.uint16 if max(end_id, enc.library.get_vocab_size(with_added_tokens=True) - 1) < 1 << 16 else np.uint32
        for b in batches:
            ids = [np.append(x, end_id).astype(width).tobytes() for x in enc.encode(b.column(1).to_pylist())]
            key = b.column(0).fill_null(np.iinfo(np.int64).min).to_numpy()
            part = np.searchsorted(bounds, key, side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), b.column(0), pa.array([width().itemsize] * len(ids), pa.int32()), pa.array(ids, pa.binary())],
                ["part", "id", "width", "ids"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = number = held = 0
        keys, blobs, part, width = [], [], 0, 2

        def shard():
            lengths = np.array([len(x) // width for x in blobs], np.int64)
            image = pack_shard(np.frombuffer(b"".join(blobs), f"<u{width}"), lengths)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([base], pa.int64()),
                 pa.array([int(lengths.sum())], pa.int64()), pa.array([keys], pa.list_(pa.int64())), pa.array([image], pa.binary())],
                ["part", "shard", "base", "n_ids", "doc_ids", "image"])
        for b in batches:
            for p, key, w, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if blobs and (held >= shard_ids or p != part):
                    yield shard()
                    base, number = (base + held, number + 1) if p == part else (0, 0)
                    keys, blobs, held = [], [], 0
                part, width = p, w
                keys.append(key)
                blobs.append(raw)
                held += len(raw) // w
        if blobs:
            yield shard()

    (d.mapInArrow(encode, "part int, id long, width int, ids binary")
     .repartitionById(parts, F.col("part"))
     .sortWithinPartitions("part", F.asc_nulls_first("id"), "ids")
     .mapInArrow(build, "part int, shard int, base long, n_ids long, doc_ids array<long>, image binary")
     .write.mode("errorifexists").parquet(out))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document in the shards: ids as little-endian unsigned 32-bit integers.

    start counts the ids of all documents before; the totals of the partitions (one number
    each, as many as shuffle partitions) are the only thing added up on the driver.
    """
    shards = spark.read.schema("part int, shard int, base long, n_ids long, doc_ids array<long>, image binary").parquet(path)
    totals = {r["part"]: r["n"] for r in shards.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    before, total = {}, 0
    for part in sorted(totals):
        before[part] = total
        total += totals[part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, base, keys, image in zip(*(c.to_pylist() for c in b.columns), strict=True):
                s = Shard(image)
                cuts = np.fromiter((s.boundary(i) for i in range(s.docs + 1)), np.int64, s.docs + 1)
                raw = memoryview(s.ids.astype("<u4").tobytes())
                ids = [raw[4 * x:4 * y] for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(cuts[:-1] + (before[part] + base)), pa.array([bytes(x) for x in ids], pa.binary())],
                    ["doc_id", "start", "ids"])
    return shards.select("part", "base", "doc_ids", "image").mapInArrow(run, "doc_id long, start long, ids binary")
