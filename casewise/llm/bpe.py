"""Byte-level BPE encoding by tree concatenation, and decoding.

A text of more than ``leaf_chars`` code points is halved again and again, at any code
point, until every part is a leaf.  Leaves are rows of their own, spread over all tasks
and encoded in parallel; then neighbours are joined, pair by pair up the tree.  At a
join only a window around the cut is encoded again: it starts and ends at tokens of the
two sides and doubles until its first tokens equal the left side's and its last tokens
the right side's, so that what lies outside the window is known to stay.

Why the outside stays.  A window starts and ends where a single space stands between
two non-space characters; the file's splitting rule always cuts there and never looks
back, so the parts on either side are encoded independently.  If the cut falls into one
long unsplit run (no such place near), the window lies inside the run: a BPE encoding
is right exactly if each two neighbouring tokens are, so agreement on the outermost
token of each side is enough; two are asked for.

Short texts are leaves by themselves.  Equal long texts are encoded once.

Defined edge cases: null counts as empty (no ids, decoded to empty text); repeated rows
and null ids stay as they are; an empty table gives an empty result; further columns
pass through, except that ``ids`` and ``decoded`` are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewise.llm.common import shuffle_partitions, worker_state
from casewise.llm.tokens import LETTERS, ChunkEncoder, byte_table

LEAF_CHARS = 16384
WINDOW = 8
_SAFE = re.compile(r"(?<=[^\s\x1c-\x1f]) (?=[^\s\x1c-\x1f])")


def join_run(left: list[int], right: list[int], text: Callable[[list[int]], bytes],
             encode: Callable[[bytes], list[int]], window: int = WINDOW) -> list[int]:
    """Ids of one unsplit run from the ids of its two parts."""
    while True:
        a, b = max(0, len(left) - window), min(len(right), window)
        mid = encode(text(left[a:] + right[:b]))
        k, m = min(2, len(left) - a), min(2, b)
        if (a == 0 or mid[:k] == left[a:a + k]) and (b == len(right) or mid[len(mid) - m:] == right[b - m:b]) \
                and len(mid) >= (k if a else 0) + (m if b < len(right) else 0):
            return left[:a] + mid + right[b:]
        window *= 2


def encode_run(run: bytes, encode: Callable[[bytes], list[int]], text: Callable[[list[int]], bytes],
               leaf: int = LEAF_CHARS) -> list[int]:
    """Ids of one unsplit run of any length: halves, then joins."""
    if len(run) <= leaf:
        return encode(run)
    half = len(run) // 2
    return join_run(encode_run(run[:half], encode, text, leaf), encode_run(run[half:], encode, text, leaf),
                    text, encode)


class TreeEncoder:
    """Encodes leaves and joins them; ``library`` is the tokenizers object."""

    def __init__(self, path: str):
        self.chunks = ChunkEncoder.get(path, "byte")
        self.library = self.chunks.library
        self.table = byte_table(path)
        self.margin = max([2, *map(len, self.chunks.special)]) + 4

    @classmethod
    def get(cls, path: str) -> TreeEncoder:
        return worker_state(f"tree_{path}", lambda: cls(path), "tokens")

    def text(self, ids: list[int]) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))

    def raw(self, run: bytes) -> list[int]:
        """Ids of bytes that the splitting rule leaves whole."""
        return [t.id for t in self.chunks.model.tokenize("".join(map(LETTERS.__getitem__, run)))]

    def window(self, text: str) -> list[int]:
        """Ids of a window's text; its long unsplit runs go through ``encode_run``."""
        if len(text) <= LEAF_CHARS or any(s in text for s in self.chunks.special):
            return self.chunks.encode([text])[0].tolist()
        out: list[int] = []
        for _, (s, e) in self.library.pre_tokenizer.pre_tokenize_str(text):
            out += encode_run(text[s:e].encode(), self.raw, self.text)
        return out

    def _covering(self, ids: list[int], size: int) -> int | None:
        """How many leading tokens make up exactly ``size`` bytes."""
        n = 0
        for k, i in enumerate(ids):
            if n >= size:
                return k if n == size else None
            n += len(self.table[i])
        return len(ids) if n == size else None

    def join(self, left: tuple[str, list[int]], right: tuple[str, list[int]]) -> tuple[str, list[int]]:
        """(text, ids) of two neighbouring parts put together."""
        (lt, li), (rt, ri) = left, right
        reach = 64
        while reach < 2 * max(len(lt), len(rt)):
            lo, hi = max(0, len(lt) - reach), min(len(rt), reach)
            starts = [lo + m.start() for m in _SAFE.finditer(lt[lo:])]
            ends = [m.start() for m in _SAFE.finditer(rt[:hi])]
            a = next((x for x in starts if x <= len(lt) - self.margin), 0 if lo == 0 else None)
            b = next((x for x in reversed(ends) if x >= self.margin), len(rt) if hi == len(rt) else None)
            reach *= 2
            if a is None or b is None:
                continue
            tail = self._covering(li[::-1], len(lt[a:].encode()))
            head = self._covering(ri, len(rt[:b].encode()))
            if tail is None or head is None:
                continue
            mid = self.window(lt[a:] + rt[:b])
            first, last = li[len(li) - tail:][:1], ri[:head][-1:]
            if (a == 0 or mid[:1] == first) and (b == len(rt) or mid[-1:] == last):
                return lt + rt, li[:len(li) - tail] + mid + ri[head:]
        return lt + rt, self.window(lt + rt)

    def tree(self, parts: list[tuple[str, list[int]]]) -> list[int]:
        while len(parts) > 1:
            pairs = [parts[i:i + 2] for i in range(0, len(parts), 2)]
            parts = [self.join(*p) if len(p) == 2 else p[0] for p in pairs]
        return parts[0][1] if parts else []


def split_leaves(text: str, leaf_chars: int = LEAF_CHARS) -> list[str]:
    """The text's leaves, from left to right."""
    depth = 0
    while len(text) > leaf_chars << depth:
        depth += 1
    size = max(1, -(-len(text) // (1 << depth)))
    return [text[i:i + size] for i in range(0, len(text), size)]


def encode_decode(docs: DataFrame, path: str, text_col: str = "text", keep: list[str] | None = None,
                  leaf_chars: int = LEAF_CHARS) -> DataFrame:
    """``keep`` (all columns but the text, if not given), ids array<int>, decoded string for every row.

    ``path`` is a byte-level BPE file of the tokenizers library, readable on every executor.
    """
    spark = docs.sparkSession
    keep = [c for c in docs.columns if c not in (text_col, "ids", "decoded")] if keep is None else keep
    own = [f"k_{i}" for i in range(len(keep))]
    d = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(keep, own, strict=True)],
                    F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    kept_types = [f"{o} {d.schema[o].dataType.simpleString()}" for o in own]
    result = ", ".join([*kept_types, "ids array<int>", "decoded string"])

    def arrays(enc: TreeEncoder, ids: list[np.ndarray]) -> list[pa.Array]:
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat, pa.int32()))
        texts = [enc.text(x.tolist()).decode("utf-8", "replace") for x in ids]
        return [lists, pa.array(texts, pa.string())]

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = TreeEncoder.get(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                ids = enc.chunks.encode(b.column(len(own)).to_pylist())
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], *arrays(enc, ids)], [*own, "ids", "decoded"])

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, c, t in zip(*(x.to_pylist() for x in b.columns), strict=True):
                parts = split_leaves(t, leaf_chars)
                yield pa.RecordBatch.from_arrays([pa.array([a] * len(parts)), pa.array([c] * len(parts)),
                                                  pa.array(range(len(parts)), pa.int32()), pa.array(parts)], ["a", "c", "no", "leaf"])

    def encode_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = TreeEncoder.get(path)
        for b in batches:
            ids = [x.astype("<i4").tobytes() for x in enc.chunks.encode(b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.binary())], ["a", "c", "no", "leaf", "ids"])

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = TreeEncoder.get(path)
        rows = (r for b in batches for r in zip(*(x.to_pylist() for x in b.columns), strict=True))
        for (a, c), group in groupby(rows, key=lambda r: r[:2]):
            ids = np.array(enc.tree([(leaf, np.frombuffer(raw, "<i4").tolist()) for _, _, _, leaf, raw in group]), np.int32)
            yield pa.RecordBatch.from_arrays([pa.array([a]), pa.array([c]), *arrays(enc, [ids])], ["a", "c", "ids", "decoded"])

    is_long = F.length("t") > leaf_chars
    out = d.filter(~is_long).mapInArrow(short, result)
    long = d.filter(is_long).withColumns({"a": F.xxhash64("t"), "c": F.xxhash64(F.lit("second"), "t")})
    parts = max(2, shuffle_partitions(spark))
    done = (long.groupBy("a", "c").agg(F.first("t").alias("t"))
            .mapInArrow(leaves, "a long, c long, no int, leaf string").repartition(parts, "a", "c", "no")
            .mapInArrow(encode_leaves, "a long, c long, no int, leaf string, ids binary")
            .repartition(parts, "a", "c").sortWithinPartitions("a", "c", "no")
            .mapInArrow(trees, "a long, c long, ids array<int>, decoded string"))
    out = out.unionByName(long.join(done, ["a", "c"]).select(*own, "ids", "decoded"))
    return out.select(*[F.col(o).alias(c) for c, o in zip(keep, own, strict=True)], "ids", "decoded")
