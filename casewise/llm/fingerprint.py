"""Document fingerprints by one-permutation MinHash.

Each ``shingle``-word shingle of the lower-cased text is hashed once.  The hash's leading
bits choose one of ``bins``, and a bin keeps its smallest hash.  Empty bins are filled by
optimal densification: bin i asks bins in the order of a universal hash sequence of its
own and copies the first that is not empty (mixed with i, so that copies of one value
do not look like agreement of many).  Of each bin only ``bits`` low-order bits are
stored, packed into a hex string.  Two fingerprints agree by chance in 2 ** -bits of
their bins; ``likeness`` corrects for that.

Defined edge cases: null counts as empty; a text of fewer words than a shingle is one
shingle, a text without words the empty one (so it is like other such texts only);
repeated rows and null ids are kept, an empty table gives an empty result, and further
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewise.llm.common import range_bounds, shuffle_partitions, text_hash, worker_state
from casewise.session import cut_lineage

SHINGLE, BINS, BITS = 5, 256, 4
_GOLDEN, _MIX1, _MIX2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX2)
    return x ^ (x >> np.uint64(31))


class OnePermutation:
    """Fingerprints of one parameter set."""

    def __init__(self, shingle: int = SHINGLE, bins: int = BINS, bits: int = BITS):
        if bins & (bins - 1) or 8 % bits:
            raise ValueError("bins must be a power of two, bits a divisor of 8")
        self.shingle, self.bins, self.bits = shingle, bins, bits
        self.shift = np.uint64(64 - bins.bit_length() + 1)
        self.place = mixed(np.arange(1, shingle + 1, dtype=np.uint64) * np.uint64(_GOLDEN)) | np.uint64(1)
        self.order = self._sequences()
        self.known: dict[str, int] = {}

    def _sequences(self) -> np.ndarray:
        """Row i: the order in which empty bin i asks other bins, each once, by hash(i, attempt)."""
        tries = np.arange(64 * self.bins, dtype=np.uint64)
        out = np.empty((self.bins, self.bins), np.int64)
        for i in range(self.bins):
            seen = mixed(mixed(np.array([i + 1], np.uint64) * np.uint64(_GOLDEN)) + tries * np.uint64(_MIX2)) >> self.shift
            first = pd.unique(seen.astype(np.int64))
            rest = np.setdiff1d(np.arange(self.bins), first)
            out[i] = np.concatenate([first, rest])
        return out

    def word_hashes(self, text: str) -> np.ndarray:
        words = text.lower().split()
        known = self.known
        try:
            found = [known[w] for w in words]
        except KeyError:
            if len(known) > 500_000:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "replace"))
            found = [known[w] for w in words]
        return np.array(found, np.uint64)

    def shingle_hashes(self, text: str) -> np.ndarray:
        w = self.word_hashes(text)
        n = len(w) - self.shingle + 1
        if n < 1:
            return mixed((w * self.place[: len(w)]).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(w) + 1))
        h = np.zeros(n, np.uint64)
        for j in range(self.shingle):
            h += w[j:j + n] * self.place[j]
        return mixed(h)

    def sketch(self, text: str | None) -> np.ndarray:
        """The low-order bits of all bins."""
        h = np.sort(self.shingle_hashes(text or ""))
        at = (h >> self.shift).astype(np.int64)
        first = np.concatenate([[True], at[1:] != at[:-1]])
        value = np.zeros(self.bins, np.uint64)
        full = np.zeros(self.bins, bool)
        value[at[first]], full[at[first]] = h[first], True
        empty = np.flatnonzero(~full)
        if len(empty):
            asked = self.order[empty]
            donor = asked[np.arange(len(empty)), full[asked].argmax(1)]
            value[empty] = mixed(value[donor] + (empty + 1).astype(np.uint64) * np.uint64(_GOLDEN))
        return (value & np.uint64((1 << self.bits) - 1)).astype(np.uint8)

    def packed(self, sketch: np.ndarray) -> str:
        per = 8 // self.bits
        out = np.zeros(self.bins // per, np.uint8)
        for k in range(per):
            out |= sketch[k::per] << np.uint8(k * self.bits)
        return out.tobytes().hex()

    def likeness(self, a: np.ndarray, b: np.ndarray) -> float:
        """Estimated share of common shingles, 0 to 1."""
        chance = 2.0 ** -self.bits
        return float(min(1.0, max(0.0, ((a == b).mean() - chance) / (1 - chance))))


def _maker(shingle: int, bins: int, bits: int) -> OnePermutation:
    return worker_state(f"minhash_{shingle}_{bins}_{bits}", lambda: OnePermutation(shingle, bins, bits))


def fingerprints(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, shingle: int = SHINGLE,
                 bins: int = BINS, bits: int = BITS) -> DataFrame:
    """``keep`` (all columns but the text) and fingerprint of every row."""
    keep = [c for c in docs.columns if c not in (text_col, "fingerprint")] if keep is None else keep
    own = [f"k_{i}" for i in range(len(keep))]
    d = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(keep, own, strict=True)], F.col(f"`{text_col}`").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _maker(shingle, bins, bits)
        for b in batches:
            found = [m.packed(m.sketch(t)) for t in b.column(len(own)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found, pa.string())], [*own, "fingerprint"])

    types = ", ".join([*[f"{o} {d.schema[o].dataType.simpleString()}" for o in own], "fingerprint string"])
    return d.mapInArrow(run, types).toDF(*keep, "fingerprint")


def edited(text: str, following: str, share: int = 3) -> str:
    """The text with its last floor(n / share) code points replaced by as many first ones of ``following``."""
    k = len(text) // share
    return text[:len(text) - k] + following[:k]


def with_following(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(part, copy, id, t) spread by ranges of descending id: sorted, each row's follower is the next row of its part.

    The first row of each range is also sent to the range before it (the first of all to the
    last range), marked as a copy.  Rows go by (id, text hash) descending, null ids last.
    """
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    bounds = np.array(range_bounds(d.filter("id is not null"), "id", parts), np.int64)

    @F.pandas_udf("int")
    def part_of(ids: pd.Series) -> pd.Series:
        known = ids.fillna(0).astype(np.int64)
        part = len(bounds) - np.searchsorted(bounds, known, side="right")
        return pd.Series(np.where(ids.isna(), len(bounds), part).astype(np.int32))

    # exact ids only: a long column with nulls reaches pandas as floating point
    d = d.withColumn("part", F.when(F.col("id").isNull(), len(bounds)).otherwise(part_of(F.coalesce("id", F.lit(0)))))
    d = d.withColumn("k", F.struct("id", text_hash("t").alias("h")))
    # one row for each range at most: as many as shuffle partitions
    heads = {r["part"]: r["k"] for r in cut_lineage(d.groupBy("part").agg(F.max("k").alias("k"))).collect()}
    order = sorted(heads)
    to = [(p, heads[p]["id"], heads[p]["h"]["a"], heads[p]["h"]["b"], order[i - 1]) for i, p in enumerate(order)]
    marks = spark.createDataFrame(to, "m_part int, m_id long, m_a long, m_b long, m_to int")
    d = d.join(F.broadcast(marks), (F.col("part") == F.col("m_part")) & F.col("id").eqNullSafe(F.col("m_id"))
               & (F.col("k.h.a") == F.col("m_a")) & (F.col("k.h.b") == F.col("m_b")), "left")
    goes = F.array_compact(F.array(F.struct("part", F.lit(0).alias("copy")),
                                   F.when(F.col("m_to").isNotNull(), F.struct(F.col("m_to").alias("part"), F.lit(1).alias("copy")))))
    d = d.select("id", "t", "k", F.explode(goes).alias("g")).select("g.part", "g.copy", "id", "t", "k")
    return (d.repartitionById(parts, F.col("part"))
            .sortWithinPartitions("part", "copy", F.desc_nulls_last("k")).select("part", "copy", "id", "t"))


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                      bins: int = BINS, bits: int = BITS) -> DataFrame:
    """For every row: its fingerprint, that of its edited text, and its likeness to that and to the next row's text.

    The next row is the one with the next smaller id; after the last comes the first.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _maker(shingle, bins, bits)
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        last, out = None, []

        def flush():
            cols = list(zip(*out, strict=True))
            types = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)
        for b in batches:
            for part, copy, key, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if copy and (last is None or last[0] != part):
                    continue  # a repeated first row was sent more than once
                own = m.sketch(text)
                if last is not None and last[0] == part:
                    _, prev_key, prev, mark = last
                    new = edited(prev, text)
                    other = m.sketch(new)
                    out.append((prev_key, len(prev), hashlib.sha256(new.encode()).hexdigest(), m.packed(mark), m.packed(other),
                                m.likeness(mark, other), m.likeness(mark, own)))
                    if len(out) >= 1000:
                        yield flush()
                last = None if copy else (part, key, text, own)
        if out:
            yield flush()

    return with_following(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
