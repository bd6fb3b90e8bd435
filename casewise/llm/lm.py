"""Language-model scores by deleted interpolation of bigram, unigram and uniform estimates.

p(w | v) = l2 c(v, w) / c(v) + l1 c(w) / N + l0 / (V + 1), where the weights l depend on
how often the context v was seen (buckets of powers of two) and are learned by
expectation-maximisation: a part of the training documents is deleted from the counts,
and the weights maximise the likelihood of the deleted part under the counts of the
rest.  Final scores use the counts of all training documents.

Counts cover the whole corpus and are never held in one place:

1. Documents are packed, where they are read, into blocks of about ``block_tokens``
   tokens: the block's distinct words (64-bit hashes) and each token as an index into
   them.  Blocks are a table bucketed by block number, so that later steps find them
   without a shuffle.
2. A block asks for the counts of its distinct words, and of its distinct bigrams, and
   brings its own counts along: both are sorted by hash, cut into hash ranges, and go to
   the task of their range.  That task adds up all blocks' counts and answers each block
   in its own order.  A word that is everywhere costs one entry per block, so no key is
   hot.
3. Joined with their answers, blocks give the statistics of the deleted part (a fixed
   grid of context bucket and quantised estimates) and then all documents' scores.

Defined edge cases: null and empty texts are one end token; null ids count as empty text
for the fold; repeated rows are separate documents; without training documents N and V
are 0, the base score follows its formula and the model is uniform; an empty table gives
an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewise.llm.common import id_fold, shared_path, shuffle_partitions, stored

END = xxhash.xxh64_intdigest(b"")
START = xxhash.xxh64_intdigest(b" ")
BLOCK_TOKENS = 500_000
RANGE_KEYS = 2_000_000
BUCKETS, STEPS, DEPTH = 32, 4, 40  # context buckets; quantisation of log2 estimates: steps per bit, bits
FLOOR = STEPS * DEPTH


def squeeze(a: np.ndarray) -> bytes:
    """Compressed planes of an unsigned array's bytes."""
    raw = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def expand(blob: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)


def squeeze_sorted(a: np.ndarray) -> bytes:
    return squeeze(np.diff(a, prepend=np.uint64(0)))


def expand_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(expand(blob, np.uint64), dtype=np.uint64)


def bigram_keys(words: np.ndarray, tokens: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct 48-bit bigram hashes, each token's place among them, each token's context: index or -1)."""
    context = np.concatenate([[-1], tokens[:-1].astype(np.int64)])
    context[starts] = -1
    pair = (context + 1) * len(words) + tokens
    distinct, place = np.unique(pair, return_inverse=True)
    from_, to = distinct // len(words) - 1, distinct % len(words)
    left = np.where(from_ < 0, np.uint64(START), words[from_])
    h = left * np.uint64(0x9E3779B97F4A7C15) + words[to]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) >> np.uint64(16)
    keys, again = np.unique(h, return_inverse=True)
    return keys, again[place], context


def make_blocks(docs: DataFrame, id_col: str, text_col: str, folds: int, block_tokens: int) -> str:
    """Write the blocks; returns the name of the bucketed table."""
    d = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("t"))
    d = d.select("id", id_fold("id", folds).cast("int").alias("fold"), "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        index: dict[bytes, int] = {b"": 0}
        ids, part_of, lengths, parts, held = [], [], [], [], 0

        def block():
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, index), np.uint64, len(index))
            order = np.argsort(hashes)
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            tokens = rank[np.concatenate(parts)]
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([len(tokens)], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([part_of], pa.list_(pa.int32())),
                 pa.array([lengths], pa.list_(pa.int32())), pa.array([squeeze_sorted(hashes[order])], pa.binary()), pa.array([squeeze(tokens)], pa.binary())],
                ["block", "n", "ids", "folds", "lengths", "words", "tokens"])
        for b in batches:
            for key, fold, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist(), strict=True):
                words = (raw or b"").lower().split()
                words.append(b"")
                parts.append(np.array([index.setdefault(w, len(index)) for w in words], np.int64))
                ids.append(key)
                part_of.append(fold)
                lengths.append(len(words))
                held += len(words)
                if held >= block_tokens:
                    yield block()
                    number, held, index = number + 1, 0, {b"": 0}
                    ids, part_of, lengths, parts = [], [], [], []
        if ids:
            yield block()

    spark = docs.sparkSession
    name = f"lm_blocks_{uuid.uuid4().hex}"
    (d.mapInArrow(run, "block long, n long, ids array<long>, folds array<int>, lengths array<int>, words binary, tokens binary")
     .write.bucketBy(max(2, shuffle_partitions(spark)), "block").option("path", shared_path(spark, name)).saveAsTable(name))
    return name


def _counts(tokens: np.ndarray, fold: np.ndarray, size: int, held_out: int, deleted: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each index occurs in the retained and in the deleted training documents."""
    kept = np.bincount(tokens[(fold != held_out) & (fold != deleted)], minlength=size).astype(np.uint32)
    return kept, np.bincount(tokens[fold == deleted], minlength=size).astype(np.uint32)


def _ask(blocks: DataFrame, grams: int, ranges_bits: int, held_out: int, deleted: int) -> DataFrame:
    """(range, block, keys, kept, gone): each block's distinct words (grams 1) or bigrams (2) with its own counts."""
    top = 64 if grams == 1 else 48

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, folds, lengths, words, tokens in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words, tokens = expand_sorted(words), expand(tokens, np.uint32)
                sizes = np.array(lengths, np.int64)
                fold = np.repeat(np.array(folds, np.int32), sizes)
                if grams == 1:
                    keys, place = words, tokens
                else:
                    keys, place, _ = bigram_keys(words, tokens, np.cumsum(sizes) - sizes)
                kept, gone = _counts(place, fold, len(keys), held_out, deleted)
                cuts = np.searchsorted(keys >> np.uint64(top - ranges_bits) if ranges_bits else np.zeros(len(keys), np.uint64),
                                       np.arange((1 << ranges_bits) + 1, dtype=np.uint64))
                rows = [(r, block, squeeze_sorted(keys[x:y]), squeeze(kept[x:y]), squeeze(gone[x:y]))
                        for r, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if y > x]
                kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                                 ["range", "block", "keys", "kept", "gone"])
    return blocks.select("block", "folds", "lengths", "words", "tokens").mapInArrow(
        run, "range int, block long, keys binary, kept binary, gone binary")


def _answer(asked: DataFrame, ranges_bits: int) -> DataFrame:
    """(block, range, kept, gone) over all blocks, plus each range's totals n_kept, n_gone, v_kept, v_all (once)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        for number, group in groupby(rows, key=lambda r: r[0]):
            blocks, keys, kept, gone = [], [], [], []
            for _, block, k, x, y in group:
                blocks.append(block)
                keys.append(expand_sorted(k))
                kept.append(expand(x, np.uint32))
                gone.append(expand(y, np.uint32))
            sizes = np.array([len(k) for k in keys])
            distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
            x = np.bincount(place, weights=np.concatenate(kept), minlength=len(distinct)).astype(np.uint64)
            y = np.bincount(place, weights=np.concatenate(gone), minlength=len(distinct)).astype(np.uint64)
            totals = [int(x.sum()), int(y.sum()), int((x > 0).sum()), int(((x > 0) | (y > 0)).sum())]
            at = np.concatenate([[0], np.cumsum(sizes)])
            for i, block in enumerate(blocks):
                own = place[at[i]:at[i + 1]]
                row = [block, number, squeeze(x[own]), squeeze(y[own]), *(totals if not i else [0] * 4)]
                kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)],
                                                 ["block", "range", "kept", "gone", "n_kept", "n_gone", "v_kept", "v_all"])
    return (asked.repartitionById(1 << ranges_bits, F.col("range")).sortWithinPartitions("range", "block")
            .mapInArrow(run, "block long, range int, kept binary, gone binary, n_kept long, n_gone long, v_kept long, v_all long"))


def _gather(blocks: DataFrame, words: DataFrame, bigrams: DataFrame) -> DataFrame:
    """Blocks with the answers to them, in order of their ranges."""
    def by_block(answers, name):
        return answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("range", "kept", "gone"))).alias(name)).select(
            "block", *[F.col(f"{name}.{k}").alias(f"{name}_{k}") for k in ("kept", "gone")])
    return blocks.join(by_block(words, "w"), "block").join(by_block(bigrams, "b"), "block").select(
        "ids", "folds", "lengths", "words", "tokens", "w_kept", "w_gone", "b_kept", "b_gone")


def _opened(row: tuple) -> dict:
    """Arrays of one gathered block: per token the index, bigram place, context, fold and document."""
    ids, folds, lengths, words, tokens, *answers = row
    words, tokens = expand_sorted(words), expand(tokens, np.uint32)
    sizes = np.array(lengths, np.int64)
    _, place, context = bigram_keys(words, tokens, np.cumsum(sizes) - sizes)
    counts = [np.concatenate([expand(x, np.uint64) for x in parts]).astype(np.float64) for parts in answers]
    return {"ids": ids, "folds": folds, "sizes": sizes, "tokens": tokens, "place": place, "context": context,
            "w_kept": counts[0], "w_gone": counts[1], "b_kept": counts[2], "b_gone": counts[3]}


def _estimates(w: np.ndarray, b: np.ndarray, o: dict, use: np.ndarray, n: float, docs: float):
    """(context count, bigram estimate, unigram estimate) of the tokens ``use``; a text's start was seen ``docs`` times."""
    context = o["context"][use]
    seen = np.where(context < 0, docs, w[context])
    both = b[o["place"][use]]
    return seen, np.where(seen > 0, both / np.maximum(seen, 1), 0.0), w[o["tokens"][use]] / max(n, 1)


def context_bucket(seen: np.ndarray) -> np.ndarray:
    """0 for unseen contexts, else 1 + floor(log2 count), at most BUCKETS - 1."""
    return np.where(seen > 0, np.minimum(1 + np.log2(np.maximum(seen, 1)).astype(np.int64), BUCKETS - 1), 0)


def _grid(p: np.ndarray) -> np.ndarray:
    """Estimates as steps of a quarter bit below 1; FLOOR for 0."""
    return np.where(p > 0, np.minimum(np.round(-np.log2(np.maximum(p, 1e-300)) * STEPS), FLOOR - 1), FLOOR).astype(np.int64)


def learn_weights(cells: np.ndarray, uniform: float, rounds: int = 60) -> np.ndarray:
    """Weights (bucket x 3: bigram, unigram, uniform) by EM over cells (bucket, bigram step, unigram step, count).

    Buckets without cells, and each bucket a little, lean on the weights of all cells together.
    """
    def prob(steps):
        return np.where(steps >= FLOOR, 0.0, 2.0 ** (-steps / STEPS))
    if not len(cells):
        return np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))
    parts = np.stack([prob(cells[:, 1]), prob(cells[:, 2]), np.full(len(cells), uniform)], 1)
    parts[cells[:, 0] == 0, 0] = 0

    def em(rows, prior):
        lam = prior.copy()
        x, n = parts[rows], cells[rows, 3].astype(float)
        for _ in range(rounds):
            share = x * lam
            share *= (n / share.sum(1))[:, None]
            lam = share.sum(0) + prior
            lam /= lam.sum()
        return lam
    every = em(np.flatnonzero(cells[:, 0] > 0) if (cells[:, 0] > 0).any() else np.arange(len(cells)), np.full(3, 1 / 3))
    out = np.tile(every, (BUCKETS, 1))
    for k in range(BUCKETS):
        rows = np.flatnonzero(cells[:, 0] == k)
        if k == 0:
            start = np.array([0.0, every[1], every[2]]) / (every[1] + every[2])
            out[0] = em(rows, start) if len(rows) else start
        elif len(rows):
            out[k] = em(rows, every)
    return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_out: int = 1,
          deleted: int = 2, block_tokens: int = BLOCK_TOKENS, range_keys: int = RANGE_KEYS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    Training documents are those outside the fold ``held_out``; the fold ``deleted`` among them is
    the one whose likelihood sets the weights.
    """
    spark: SparkSession = docs.sparkSession
    name = make_blocks(docs, id_col, text_col, folds, block_tokens)
    blocks = spark.table(name)
    size = blocks.agg(F.sum("n")).first()[0] or 0
    bits = [max(0, math.ceil(math.log2(max(1.0, share * size / range_keys)))) for share in (0.3, 0.8)]
    words = stored(_answer(_ask(blocks, 1, bits[0], held_out, deleted), bits[0]), "lm-words")
    bigrams = stored(_answer(_ask(blocks, 2, bits[1], held_out, deleted), bits[1]), "lm-bigrams")
    t = words.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_kept", "n_gone", "v_kept", "v_all")]).first()
    n_all = t["n_kept"] + t["n_gone"]
    trained = blocks.select(F.expr(f"size(filter(folds, x -> x != {held_out}))").alias("a"),
                            F.expr(f"size(filter(folds, x -> x != {held_out} and x != {deleted}))").alias("k"))
    docs_all, docs_kept = (x or 0 for x in trained.agg(F.sum("a"), F.sum("k")).first())
    gathered = _gather(blocks, words, bigrams)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                o = _opened(row)
                use = np.repeat(np.array(o["folds"]) == deleted, o["sizes"])
                seen, two, one = _estimates(o["w_kept"], o["b_kept"], o, use, t["n_kept"], docs_kept)
                code = (context_bucket(seen) * (FLOOR + 1) + _grid(two)) * (FLOOR + 1) + _grid(one)
                found, n = np.unique(code, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], ["cell", "n"])

    # at most BUCKETS * (FLOOR + 1) ** 2 cells, whatever the size of the corpus
    grid = gathered.mapInArrow(cells, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    code = grid["cell"].to_numpy(np.int64)
    table = np.stack([code // (FLOOR + 1) ** 2, code // (FLOOR + 1) % (FLOOR + 1), code % (FLOOR + 1), grid["n"].to_numpy(np.int64)], 1)
    weights = learn_weights(table[np.argsort(code)], 1 / (t["v_kept"] + 1))
    v_all = t["v_all"]

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                o = _opened(row)
                w, both = o["w_kept"] + o["w_gone"], o["b_kept"] + o["b_gone"]
                seen, two, one = _estimates(w, both, o, slice(None), n_all, docs_all)
                lam = weights[context_bucket(seen)]
                p = lam[:, 0] * two + lam[:, 1] * one + lam[:, 2] / (v_all + 1)
                c = w[o["tokens"]]
                starts = np.cumsum(o["sizes"]) - o["sizes"]
                base = np.log10((c + 0.5) / (n_all + 0.5 * (v_all + 1)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(o["ids"], pa.int64()), pa.array([x == held_out for x in o["folds"]]), pa.array(o["sizes"]),
                     pa.array(np.add.reduceat((c > 0).astype(np.int64), starts)), pa.array(np.full(len(starts), n_all, np.int64)),
                     pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(np.log10(p), starts))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return gathered.mapInArrow(
        scores, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
