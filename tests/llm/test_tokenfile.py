import zlib

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F

from casewise.llm import tokenfile as T
from casewise.llm.common import shared_path
from casewise.llm.tokens import ChunkEncoder
from tests.llm.conftest import DOC_SCHEMA

WORD = P.path("word_bpe_49k.json")


def test_shard_round_trip():
    rnd = np.random.default_rng(2)
    for lengths in ([1], [0, 0, 0], [5] * 200, rnd.integers(0, 400, 500), [100000], [0, 70000, 1, 0], list(range(300))):
        lengths = np.array(lengths, np.int64)
        for kind in (np.uint16, np.uint32):
            ids = rnd.integers(0, 49000, int(lengths.sum())).astype(kind)
            image = T.pack_shard(ids, lengths)
            s = T.Shard(image)
            want = np.concatenate([[0], np.cumsum(lengths)])
            assert (s.boundaries() == want).all() and [s.boundary(i) for i in range(len(want))] == want.tolist()
            assert (s.ids == ids).all() and s.n_ids == len(ids) and s.docs == len(lengths)
    big = T.pack_shard(np.zeros(10**6, np.uint16), np.full(10**4, 100))
    assert len(big) < 2 * 10**6 + 10**4 * 1.3  # under 11 bits a boundary, select samples included


def test_files(spark):
    texts = ["Some words here", None, "", "日本語 é́", "a  b\n" * 3000, "don't <|endoftext|> x", "Some words here"]
    rows = [(10**15 - 7 * i, t, None, None, 0) for i, t in enumerate(texts)] + [(None, "no id", None, None, 0), (5, "twice", None, None, 0), (5, "twice", None, None, 0)]
    docs = spark.createDataFrame(rows, DOC_SCHEMA).withColumn("part", F.lit("x"))
    lib = ChunkEncoder(WORD, "word").library
    want, at = [], 0
    for key, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = lib.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    for size in (2_000_000, 50):
        path = shared_path(spark, "test-shards")
        T.write_shards(docs, path, WORD, 1, shard_ids=size)
        got = T.read_documents(spark, path).select("doc_id", "start", (F.length("ids") / 4).cast("long"), F.crc32("ids")).collect()
        assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    path = shared_path(spark, "test-shards")
    T.write_shards(docs.limit(0), path, WORD, 1)
    assert T.read_documents(spark, path).count() == 0
