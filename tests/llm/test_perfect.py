import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewise.llm import perfect

SCHEMA = "doc_id long, text string, digest string, id long"


def key(text):
    return (text or "").translate({ord(c): None for c in perfect.SPACE})


def brute(rows, old=lambda i: False):
    by = {}
    for r in rows:
        by.setdefault(key(r[1]), []).append(r)
    out = []
    for k, g in by.items():
        best = min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        first = True
        for r in sorted(g, key=repr):
            stays = first and (r[0], len(r[1] or "")) == (best[0], len(best[1] or ""))
            first = first and not stays
            out.append((r[0], best[0], len(g), stays, hashlib.sha256(k.encode()).hexdigest(), any(old(x[0]) for x in g)))
    return sorted(out, key=repr)


def made_rows():
    rnd = random.Random(5)
    words = ["a b", "ab", "a\tb\n", "é è", "éè", "", " \r\n", None, "x" * 50_000, "x " * 50_000, "a\x85b", "a b", "日本 語"]
    rows = [(i, rnd.choice(words) if i % 3 else f"text {i // 2}") for i in range(400)]
    rows += [(1000 + i, "one very common text" + " " * (i % 4)) for i in range(600)]
    rows += [rows[3], rows[3], (None, "only null"), (None, "only null"), (None, "ab"), (5, "ab   "), (5, "ab   "), (-3, "ab   ")]
    return rows


@pytest.mark.parametrize("slots", [perfect.SLOTS, 16])
def test_equals_brute_force(spark, slots):
    rows = made_rows()
    # clashing further columns are ignored
    df = spark.createDataFrame([(*r, "other", 7) for r in rows], SCHEMA)
    for history, old in ((F.col("doc_id") % 2 == 0, lambda i: i is not None and i % 2 == 0), (None, lambda i: False),
                         (F.lit(True), lambda i: True)):
        got = perfect.dedup(df, history, slots=slots)
        assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "known"]
        assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, old)


def test_empty_table(spark):
    assert perfect.dedup(spark.createDataFrame([], SCHEMA), F.col("doc_id") > 0).collect() == []


def test_hash_is_minimal_perfect_and_foreign_keys_are_seen():
    rng = np.random.default_rng(2)
    raw = rng.integers(0, 256, (30_000, 32), np.uint8)
    built, bits = perfect.PerfectHash.build(perfect._words(raw[:20_000]))
    again = perfect.PerfectHash(built.sizes, bits)
    slots = again.slots(perfect._words(raw[:20_000]))
    assert sorted(slots.tolist()) == list(range(20_000))
    assert len(bits) * 8 < 4 * 20_000  # a few bits a key
    held = perfect.Slots()
    held.hash, held.raw = again, raw[:20_000][np.argsort(slots)]
    at = held.look_up(raw)
    assert (at[:20_000] == slots).all() and (at[20_000:] == -1).all()


def test_keys_that_no_level_places_are_listed(spark, monkeypatch):
    monkeypatch.setattr(perfect, "LEVELS", 1)
    raw = np.random.default_rng(3).integers(0, 256, (500, 32), np.uint8)
    built, _ = perfect.PerfectHash.build(perfect._words(raw))
    slots = built.slots(perfect._words(raw))
    rest = slots < 0
    assert rest.any()
    held = perfect.Slots()
    held.hash, held.raw = built, np.concatenate([raw[~rest][np.argsort(slots[~rest])], raw[rest]])
    at = held.look_up(raw)
    assert (held.raw[at] == raw).all() and (held.look_up(raw[:5] ^ 1) == -1).all()


def test_hot_groups_are_broadcast_and_index_is_reused(spark):
    rows = [(i, "hot") for i in range(3000)] + [(10_000 + i, f"t{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in perfect.dedup(df, F.col("doc_id") < 2000).collect()}
    assert len(got) == 3500 and all(got[i].keep_id == 0 and got[i].group_size == 3000 and got[i].known for i in range(3000))
    assert sum(r.kept for r in got.values()) == 501
    index = perfect.build_index(perfect.groups(perfect.digests(df)))
    fresh = perfect.groups(perfect.digests(spark.createDataFrame([(-1, "h o t"), (1, "new")], "doc_id long, text string")))
    found = {r.n: r for r in perfect.look_up(index, fresh).filter("n > 1 or not known").collect()}
    assert found[3001].id == -1 and found[3001].known and not found[1].known
