import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from casewise.llm import pfair
from tests.llm.conftest import DOC_SCHEMA


def rows_of(sizes):
    n = 0
    for s, k in sizes.items():
        for _ in range(k):
            yield (n, f"t{n}", "en", s, 2)
            n += 1


def edf(c):
    """Slots of one period by plain simulation."""
    length, nxt, out = sum(c), [0] * len(c), []
    for t in range(length):
        ready = [(-(-(nxt[k] + 1) * length // c[k]), k) for k in range(len(c)) if nxt[k] < c[k] and nxt[k] * length // c[k] <= t]
        k = min(ready)[1]
        nxt[k] += 1
        out.append(k)
    return out


def brute(rows, a, block):
    """(doc_id, block, slot, place) by walking through the periods."""
    own = defaultdict(list)
    for r in rows:
        own[r[3] if r[3] is not None else pfair.NONE].append(r[0])
    names = sorted(own)
    blocks = {}
    for s in names:
        ids = sorted(own[s], key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))
        blocks[s] = [ids[i:i + block] for i in range(0, len(ids), block)]
    done, slot, out = Counter(), 0, []
    while any(done[s] < len(blocks[s]) for s in names):
        c = [min(a[s], len(blocks[s]) - done[s]) for s in names]
        for k in edf(c):
            b = done[names[k]]
            out += [(i, b, slot, p) for p, i in enumerate(blocks[names[k]][b])]
            done[names[k]] += 1
            slot += 1
    return sorted(out)


@pytest.mark.parametrize("sizes, weights", [
    ({"a": 300, "b": 41, "c": 7, None: 12, "d": 1}, None), ({"a": 90, "b": 90, "c": 90}, {"a": 0.6, "b": 0.3}), ({"x": 5}, None)])
def test_equals_simulation(spark, sizes, weights):
    rows = list(rows_of(sizes))
    docs = spark.createDataFrame(rows, DOC_SCHEMA)
    got = pfair.mix(docs, weights, block_docs=4, period=16, bucket_rows=20)
    counts = docs.groupBy(F.coalesce("source", F.lit(pfair.NONE)).alias("src")).agg(F.count("*").alias("docs"))
    a = {r.src: r.a for r in pfair.sources(counts, weights, block_docs=4, period=16).collect()}
    assert sorted((r.doc_id, r.block, r.slot, r.place) for r in got.collect()) == brute(rows, a, 4)


def test_less_than_one_block_from_target(spark):
    docs = spark.createDataFrame(list(rows_of({"a": 400, "b": 400, "c": 400})), DOC_SCHEMA)
    weights = {"a": 0.5, "b": 0.3, "c": 0.2}
    slots = sorted({(r.slot, r.source) for r in pfair.mix(docs, weights, rest=0.0, block_docs=1, period=100).collect()})
    assert [s for s, _ in slots] == list(range(1200))
    seen = Counter()
    for t, (_, s) in enumerate(slots[:700], 1):
        seen[s] += 1
        assert all(abs(seen[k] - w * t) < 1 for k, w in weights.items())


def test_edges(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "x", "en", "s", 1), (1, "x", "en", "s", 1)], DOC_SCHEMA)
    got = pfair.mix(docs.withColumn("slot", F.lit("mine")).withColumn("h", F.lit(1)))
    assert got.columns == [*docs.columns, "h", "block", "slot", "place"] and got.count() == 3
    assert pfair.in_order(pfair.mix(docs.limit(0))).count() == 0
    ordered = [r.slot for r in pfair.in_order(pfair.mix(docs)).collect()]
    assert ordered == sorted(ordered) and len(ordered) == 3
