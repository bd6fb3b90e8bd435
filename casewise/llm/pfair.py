"""Interleaving sources at target weights by Pfair scheduling, in DataFrame operations only.

A source's documents, in a fixed pseudo-random order, form blocks of ``block_docs``.  In
a period every source gets a whole number of blocks ``a`` (its target weight times
``period``, at least 1).  Within a period of L slots, block j of a source with c blocks
is released at floor(j L / c) and due at ceil((j + 1) L / c); in each slot the released
block with the earliest deadline goes next.  So at every slot a source is less than one
block away from its share c / L of the slots so far, and exactly on it where a period
ends.

All periods in which the same sources still have their full count are alike, so only
the distinct ones are scheduled: a source changes the pattern at most twice (its last,
partial period, and its end), which makes at most 2 S + 1 patterns for S sources,
whatever the number of rows.  The slot of a block is its pattern's slot plus an offset
in closed form.  No row is dropped or repeated: when a source has run out, the others
go on at their weights.

Ranks inside a source come from counts of hash buckets plus a rank inside the bucket, so
a source that holds most of the rows is still spread over many tasks.

Weights: ``weights`` maps sources to positive numbers; sources that it leaves out share
``rest`` equally.  Without it a source weighs its number of blocks to the power ``alpha``.

Defined edge cases: a null source is the source ``(none)``; documents of one source are
ordered by the md5 of their id (null: empty text), ties by id and text hash; repeated
rows are scheduled each; an empty table gives an empty result; further columns pass
through, except that ``block``, ``slot`` and ``place`` are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casewise.llm.common import shuffle_partitions
from casewise.session import cut_lineage

NONE = "(none)"
BUCKET_ROWS = 20_000
#: Patterns of at most so many sources are broadcast: at most (2 * 64 + 1) * (period + 64) small rows.
BROADCAST_SOURCES = 64

_EDF = """
aggregate(
  sequence(0L, len - 1),
  named_struct('next', transform(c, x -> 0L), 'out', cast(array() as array<bigint>)),
  (st, t) -> transform(
    array(array_min(transform(sequence(0, size(c) - 1), k ->
      if(st.next[k] < c[k] and (st.next[k] * len) div greatest(c[k], 1L) <= t,
         (((st.next[k] + 1) * len + c[k] - 1) div greatest(c[k], 1L)) * size(c) + k,
         null)))),
    b -> named_struct('next', transform(st.next, (x, i) -> if(i = b % size(c), x + 1, x)),
                      'out', concat(st.out, array(b % size(c)))))[0],
  st -> st.out)
"""


def _weight(weights: dict[str, float] | None, rest: float, alpha: float):
    if weights is None:
        return F.pow(F.col("blocks").cast("double"), F.lit(alpha))
    total = sum(weights.values())
    stated = F.create_map(*[F.lit(x) for k, v in weights.items() for x in (k, v / total)])
    unstated = F.sum(F.when(F.col("src").isin(list(weights)), 0).otherwise(1)).over(Window.partitionBy())
    return F.coalesce(stated[F.col("src")] * (1 - rest), F.lit(rest) / unstated)


def sources(counts: DataFrame, weights: dict[str, float] | None = None, rest: float = 0.05, alpha: float = 0.5,
            block_docs: int = 64, period: int = 256) -> DataFrame:
    """(src, docs, blocks, a): blocks of each source and blocks it gets per period; ``counts`` has a row per source."""
    s = counts.withColumn("blocks", F.ceil(F.col("docs") / block_docs))
    s = s.withColumn("w", _weight(weights, rest, alpha))
    share = F.col("w") / F.sum("w").over(Window.partitionBy())
    return s.withColumn("a", F.greatest(F.lit(1), F.round(share * period)).cast("long")).select("src", "docs", "blocks", "a")


def patterns(srcs: DataFrame) -> DataFrame:
    """(src, j, p_from, p_to, base, len, at): slot ``at`` of a source's j-th block in the periods p_from <= p < p_to."""
    one = srcs.agg(F.sort_array(F.collect_list(F.struct("src", "blocks", "a"))).alias("s")).filter("size(s) > 0")
    one = one.withColumn("cuts", F.expr(
        "array_sort(array_distinct(concat(array(0L), flatten(transform(s, x -> array(x.blocks div x.a, x.blocks div x.a + 1))))))"))
    kinds = one.select("s", "cuts", F.posexplode("cuts").alias("kind", "p_from"))
    kinds = kinds.withColumns({
        "p_to": F.expr("cuts[least(kind + 1, size(cuts) - 1)]"),
        "c": F.expr("transform(s, x -> greatest(0L, least(x.a, x.blocks - x.a * p_from)))"),
        "base": F.expr("aggregate(s, 0L, (n, x) -> n + least(x.blocks, x.a * p_from))")})
    kinds = kinds.withColumn("len", F.expr("aggregate(c, 0L, (n, x) -> n + x)")).filter("len > 0 and p_to > p_from")
    kinds = kinds.repartition(shuffle_partitions(srcs.sparkSession), "kind").withColumn("order", F.expr(_EDF))
    slots = kinds.select("s", "kind", "p_from", "p_to", "base", "len", F.posexplode("order").alias("at", "k"))
    slots = slots.withColumn("src", F.expr("s[cast(k as int)].src")).drop("s", "k")
    j = F.row_number().over(Window.partitionBy("kind", "src").orderBy("at")) - 1
    return slots.select("src", j.cast("long").alias("j"), "p_from", "p_to", "base", "len", F.col("at").cast("long").alias("at"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, rest: float = 0.05, alpha: float = 0.5,
        block_docs: int = 64, period: int = 256, id_col: str = "doc_id", source_col: str = "source",
        bucket_rows: int = BUCKET_ROWS, tie_col: str | None = None) -> DataFrame:
    """``docs`` with block (its number within the source), slot (the block's place in the mix) and place (in the block).

    ``tie_col`` orders rows of equal source and id, instead of the hash of all columns.
    """
    others = [c for c in docs.columns if c not in ("block", "slot", "place")]
    own = [f"k_{i}" for i in range(len(others))]
    at = dict(zip(others, own, strict=True))
    d = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in at.items()])
    d = d.withColumn("src", F.coalesce(F.col(at[source_col]).cast("string"), F.lit(NONE)))
    h = F.md5(F.coalesce(F.col(at[id_col]).cast("string"), F.lit("")))
    keyed = docs.select(F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit(NONE)).alias("src"),
                        F.md5(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))).alias("h"))
    total = docs.count()
    digits = max(0, math.ceil(math.log(max(1, total / bucket_rows), 16)))
    sizes = cut_lineage(keyed.groupBy("src", F.expr(f"substring(h, 1, {digits})").alias("bucket")).agg(F.count("*").alias("n")))
    before = F.sum("n").over(Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("src", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    srcs = cut_lineage(sources(sizes.groupBy("src").agg(F.sum("n").alias("docs")), weights, rest, alpha, block_docs, period))
    plan = cut_lineage(patterns(srcs))
    small = srcs.count() <= BROADCAST_SOURCES
    if small:
        srcs, plan = F.broadcast(srcs), F.broadcast(plan)
        if sizes.count() <= BROADCAST_SOURCES * 256:
            offsets = F.broadcast(offsets)
    d = d.withColumn("h", h).withColumn("bucket", F.expr(f"substring(h, 1, {digits})"))
    tie = [F.col(at[tie_col]) if tie_col else F.xxhash64(*[F.col(o) for o in own])]
    rank = F.row_number().over(Window.partitionBy("src", "bucket").orderBy("h", F.asc_nulls_first(at[id_col]), *tie)) - 1
    d = d.withColumn("rank", rank).join(offsets, ["src", "bucket"]).withColumn("rank", F.col("rank") + F.col("before"))
    d = d.withColumns({"block": F.expr(f"rank div {block_docs}"), "place": F.col("rank") % block_docs})
    d = d.join(srcs.select("src", "a"), "src").withColumns({"p": F.expr("block div a"), "j": F.col("block") % F.col("a")})
    d = d.join(plan, ["src", "j"]).filter("p >= p_from and p < p_to")
    slot = F.col("base") + (F.col("p") - F.col("p_from")) * F.col("len") + F.col("at")
    return d.select(*[F.col(o).alias(c) for c, o in at.items()], "block", slot.alias("slot"), "place")


def in_order(mixed: DataFrame) -> DataFrame:
    """The rows of ``mix`` as a table that is written and read in the order of the schedule."""
    n = mixed.agg(F.max("slot")).first()[0]
    if n is None:
        return mixed
    parts = shuffle_partitions(mixed.sparkSession)
    return (mixed.repartitionById(parts, F.expr(f"cast(slot * {parts} div {n + 1} as int)"))
            .sortWithinPartitions("slot", "place"))
