import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from casewise.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string, conv string, fault string, copy string"
FULL = re.compile(r"(s?(ua)+)?")
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 0:
            continue
        text = "" if hit == 1 else re.sub("[.!?]", "", text) if hit == 2 else text
        out[conv] += [(turn, "user" if hit == 4 else role, text)] * (2 if hit == 3 else 1)
    for conv, rs in out.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    return out


def faults(rs):
    seen, out = set(), []
    for _, role, text in rs:
        bare = text.strip(SPACE)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rs, fs):
    """Least (cost, audit) by trying every edit list with at most ``len(rs) + 2`` insertions (shortest first by cost)."""
    import heapq
    heap = [(0, "", 0, "", ())]  # cost, audit, rows done, initials, lines
    best = set()
    while heap:
        cost, audit, i, got, lines = heapq.heappop(heap)
        # a prefix of the pattern is told by its last initial and whether anything came before
        if (i, got[-1:], got == "s") in best:
            continue
        # the first list popped for a state is the least one: cost first, then ASCII order
        if i == len(rs) and FULL.fullmatch(got):
            return cost, audit, "\n".join(lines)
        if i == len(rs) or cost >= 0:
            best.add((i, got[-1:], got == "s"))
        steps = [("I", 5, 0, name, "") for name in ("user", "assistant")]
        if i < len(rs):
            _, role, text = rs[i]
            more = 5 if fs[i] == "truncated" else 0
            steps.append(("D", 2, 1, None, None))
            if fs[i] not in ("blank", "duplicate"):
                steps.append(("K", more, 1, role, text))
                steps += [("R", 1 + more, 1, name, text) for name in ("user", "assistant")]
        for letter, price, used, name, text in steps:
            now = got if name is None else got + name[:1]
            if name is not None and (not name or not any(FULL.fullmatch(now + end) for end in ("", "a", "ua"))):
                continue
            heapq.heappush(heap, (cost + price, audit + letter, i + used, now, lines if name is None else (*lines, f"{name}:{text}")))
    raise AssertionError


def brute(rows):
    out = []
    for conv, rs in damage(rows).items():
        fs = faults(rs)
        ts = [r[0] for r in rs if r[0] is not None]
        gaps = max(ts) - min(ts) + 1 - len(set(ts)) if ts else 0
        first = [r[1][:1] for r in rs]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(first))
        cost, audit, text = cheapest(rs, fs) if rs else (0, "", "")
        out.append((conv, gaps, *[fs.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit,
                    hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def made_rows():
    rnd = random.Random(8)
    rows = []
    for conv in range(60):
        last = 0
        for _ in range(rnd.randrange(1, 12)):
            last += rnd.choice([1, 1, 1, 2, 5])
            rows.append((conv, last, rnd.choice(["system", "user", "user", "assistant", "assistant", "tool", "User"]),
                         rnd.choice([f"Said {last}.", "Yes!", "Yes!", "no end", "  ", "", "Why?\n", "é…", "what. \t"])))
    rows += [(100, 1, "user", "one."), (101, None, None, None), (101, None, "user", "x."), (101, 3, "assistant", None), (None, 1, "user", "Hi."),
             (None, 2, "assistant", "Ho."), (None, None, "", "Hm."), (102, 5, "user", "long " * 60_000 + "."), (102, 6, "assistant", "y" * 300_000),
             (103, -(2**40), "user", "a."), (103, 2**40, "assistant", "b.")]
    rows += [(104, i, "user", "same.") for i in range(40)] + [(105, 1, "user", "twice."), (105, 1, "user", "twice."), (105, 1, "assistant", "z.")]
    # conversations that the damage leaves without rows
    rows += [(c, 1, "user", "gone.") for c in range(200, 300) if zlib.crc32(f"{c}:1".encode()) % 20 == 0]
    return rows


@pytest.mark.parametrize("bounds", [{}, {"rows_bound": 3}, {"rows_bound": 0}, {"chars_bound": 1000}])
def test_equals_exhaustive_search(spark, bounds):
    rows = made_rows()
    df = spark.createDataFrame([(*r, "c", "f", "9") for r in rows], SCHEMA).repartition(5)
    got = turns.damage_and_repair(df, **bounds)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_empty_table(spark):
    assert turns.damage_and_repair(spark.createDataFrame([], SCHEMA)).collect() == []


def test_state_crosses_batches(spark):
    """One conversation over many Arrow batches, by both ways."""
    rows = [(7, i, ["user", "assistant"][i % 2], f"turn {i}." if i % 11 else "cut") for i in range(5000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        one = turns.damage_and_repair(df).collect()
        two = turns.damage_and_repair(df, rows_bound=100).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert one == two and len(one) == 1 and one[0].cost > 0


def test_edits_rebuild_the_conversation(spark):
    rows = [(1, 1, "assistant", "Hello."), (1, 2, "user", "Hi."), (1, 3, "user", "There?"), (1, 4, "assistant", " ")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    edits = turns.repair(turns.turns(df).withColumn("copy", F.lit(0))).collect()
    assert [(r.edit, r.fault, r.turn, r.was, r.role, r.text) for r in edits] == [
        ("D", None, "1", "assistant", None, None), ("K", None, "2", "user", "user", "Hi."),
        ("R", None, "3", "user", "assistant", "There?"), ("D", "blank", "4", "assistant", None, None)]
