import random

import numpy as np
import xxhash

from casewise.llm import simhash as S
from tests.llm.conftest import DOC_SCHEMA


def slow_fingerprint(text, k=3):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closure(fps, max_bits):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint_is_the_contract():
    for t in [None, "", " \t", "One", "One two", "A B c D a b C", "É é x\xa0y z w", "a  b\nc\x0bd", "w " * 5000]:
        assert S.simhash(t.encode() if t is not None else None) == slow_fingerprint(t)


def test_gray_index_finds_exactly_the_close_pairs():
    rnd = random.Random(5)
    base = [rnd.getrandbits(64) for _ in range(40)]
    fps = {b ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for b in base for _ in range(12)}
    ix = S.GrayIndex(np.array(sorted(fps), np.uint64))
    a, b = ix.search(np.arange(len(ix.fps)), 2)
    got = {(int(x), int(y)) for x, y in zip(a, b, strict=True) if x < y}
    want = {(i, j) for j in range(len(ix.fps)) for i in range(j) if bin(int(ix.fps[i]) ^ int(ix.fps[j])).count("1") <= 2}
    assert got == want


def test_links_survive_splitting_of_large_buckets(spark):
    rnd = random.Random(6)
    centre = rnd.getrandbits(64)
    fps = list({0, 1, 3, (1 << 64) - 1, *[centre ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(300)]})
    df = spark.createDataFrame([(S._signed(f),) for f in fps], "fp long")
    for target, cap in ((4096, 65536), (32, 16)):
        stars = {int(r.u) & S.ALL: int(r.v) & S.ALL for r in S.components(S.links(df, 2, target, cap)).collect()}
        mine = [stars.get(f, f) for f in fps]
        want = closure(fps, 2)
        assert len(set(zip(mine, want, strict=True))) == len(set(want)) == len(set(mine))


def test_documents(spark):
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(500)]
    base = [" ".join(rnd.choices(words, k=200)) for _ in range(6)]
    texts = [*base, *base[:3], base[0].replace("w1 ", "x "), base[0].upper(), None, "", " ", "one", "one", "a b", base[1] + " tail"]
    rows = [(100 - i if i != 4 else None, t, None, None, 0) for i, t in enumerate(texts)] + [(50, "lone row here", None, None, 1)] * 2
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    got = S.near_duplicates(docs)
    fps = [slow_fingerprint(r[1]) for r in rows]
    comp = closure(fps, 2)
    want = sorted((str(r[0]), f"{f:016x}", str(min((rows[j][0] for j in range(len(rows)) if comp[j] == comp[i] and rows[j][0] is not None), default=None)))
                  for i, (r, f) in enumerate(zip(rows, fps, strict=True)))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got.collect()) == want
    kept = S.one_per_group(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(comp))
    assert S.near_duplicates(docs.limit(0)).count() == 0 and S.one_per_group(docs.limit(0)).count() == 0
