"""Exact group quantiles that stay distributed on hot groups.

Spark's exact ``percentile``/``median`` keep every distinct value of a group
in one aggregation buffer, so a group holding a third of 100 TB cannot be
finished by one task.  ``group_quantiles`` gives the same numbers (linear
interpolation between the two neighbouring ranks, as ``percentile``) by a
selection algorithm:

1. one aggregate gives ``n``, ``min``, ``max`` per group and the ranks needed;
2. if the largest group is at most ``cap`` rows, Spark's exact percentile is
   used as is (its buffer is then bounded by ``cap``); both ways have registered
   queries with an oracle (``*_selection`` sets ``cap=0``);
3. otherwise the narrow (group, value) projection is kept in columnar form (in memory,
   else on disk) until every wanted rank is found, and every rank is narrowed: a quantile sketch of the rows in the rank's current range
   gives cut points, exact counts per piece (each cut point itself, and the open
   intervals between them) tell which piece holds the rank, and that piece, with
   the data's own smallest and largest value, is the next range.  A piece
   between two cut points holds about 1 / CUTS of the rows, whatever the shape of
   the data, and ties resolve at their cut point.  Ranges of at most
   ``sort_rows`` rows are sorted.  The loop ends when every rank is resolved; a
   round that gains nothing raises.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewise.operators.joins import bounded_broadcast
from casewise.session import cut_lineage

# values per group held by one exact-percentile buffer; above it the distributed selection runs
DEFAULT_CAP = 500_000
CUTS = 32           # cut points per range and round
SKETCH = 2_000      # accuracy of the sketch that proposes them
SORT_ROWS = 100_000  # ranges of at most so many rows are sorted by one task


def _interp(n: Column, p: float, v_of_rank) -> Column:
    pos = (n - 1).cast("double") * F.lit(float(p))
    lo = F.floor(pos).cast("bigint")
    hi = F.ceil(pos).cast("bigint")
    v_lo, v_hi = v_of_rank(lo), v_of_rank(hi)
    value = F.when(lo == hi, v_lo).otherwise(
        (hi.cast("double") - pos) * v_lo + (pos - lo.cast("double")) * v_hi)
    return F.when(n > 0, value)


def _prepare(df: DataFrame, by, value):
    by = list(by)
    vcol = F.col(value) if isinstance(value, str) else value
    keys = by if by else ["__g"]
    base = df.select(*[F.col(c) for c in by], vcol.alias("__v"))
    if not by:
        base = base.withColumn("__g", F.lit(0))
    return by, keys, base


def group_quantiles(df: DataFrame, by: Sequence[str], value: str | Column,
                    probs: Sequence[float], names: Sequence[str],
                    cap: int | None = None, sort_rows: int = SORT_ROWS,
                    with_count: bool = False,
                    extra: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """Exact quantiles of ``value`` per group ``by`` (NULL values ignored).

    Returns ``by + names`` (plus ``n`` when ``with_count``, plus one column
    per ``extra`` aggregate, e.g. ``{"mean": F.avg}``, computed in the same
    pass that sizes the groups); a group whose values are all NULL gets NULL
    quantiles, like ``percentile``.
    """
    cap = DEFAULT_CAP if cap is None else cap
    extra = extra or {}
    vcol = F.col(value) if isinstance(value, str) else value
    # NaN is a missing value here (NaN-ignoring medians), not the largest number
    by, keys, base = _prepare(df, by, F.nanvl(vcol.cast("double"), F.lit(None).cast("double")))
    if cap <= 0:
        base = base.persist()
    stats = base.groupBy(*keys).agg(F.count("__v").alias("n"),
                                    *[fn(F.col("__v")).alias(nm) for nm, fn in extra.items()])
    if extra:
        stats = cut_lineage(stats)  # one row per group, joined back below
    max_n = stats.agg(F.max("n")).first()[0] or 0
    if max_n <= cap:
        aggs = [F.percentile("__v", float(p)).alias(nm) for p, nm in zip(probs, names)]
        out = base.groupBy(*keys).agg(*aggs)
        if with_count or extra:
            out = out.join(stats.select(*keys, *(["n"] if with_count else []), *extra), keys)
        return out.drop("__g") if not by else out
    if cap > 0:
        base = base.persist()
    if not extra:
        stats = cut_lineage(base.groupBy(*keys).agg(F.count("__v").alias("n")))  # one row per group
    rank_cols = []
    for p in probs:
        pos = (F.col("n") - 1).cast("double") * F.lit(float(p))
        rank_cols += [F.floor(pos).cast("bigint"), F.ceil(pos).cast("bigint")]
    ranks = stats.where(F.col("n") > 0).select(
        *keys, F.explode(F.array_distinct(F.array(*rank_cols))).alias("__r"))
    try:
        values = _select_ranks(base, keys, ranks, sort_rows)
    finally:
        base.unpersist()
    vmap = values.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("__r", "__val"))).alias("__m"))
    out = stats.join(vmap, keys, "left")
    cols = [F.col(k) for k in by]
    for p, nm in zip(probs, names):
        cols.append(_interp(F.col("n"), p, lambda r: F.element_at(F.col("__m"), r)).alias(nm))
    if with_count:
        cols.append(F.col("n"))
    cols += [F.col(nm) for nm in extra]
    return out.select(*cols)


def _select_ranks(base, keys, ranks, sort_rows):
    """(keys, __r, __val): the value at each 0-based rank; ``base`` is a persisted (keys, __v) table."""
    base = base.where(F.col("__v").isNotNull())
    bounds = base.groupBy(*keys).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"),
                                     F.count(F.lit(1)).alias("__c"))
    state = cut_lineage(ranks.join(bounds, keys).select(*keys, "__r", "__lo", "__hi", "__c",
                                                        F.lit(0).cast("bigint").alias("__below")))
    scope = [*keys, "__lo", "__hi", "__below"]
    found = []
    while True:
        single = state.where(F.col("__lo") == F.col("__hi"))
        found.append(single.select(*keys, "__r", F.col("__lo").alias("__val")))
        wide = state.where(F.col("__lo") < F.col("__hi"))
        small = wide.where(F.col("__c") <= sort_rows)
        found.append(cut_lineage(_sort_small(base, small, keys)))
        wide = wide.where(F.col("__c") > sort_rows)
        if wide.isEmpty():
            break
        inside = (F.col("__v") >= F.col("__lo")) & (F.col("__v") <= F.col("__hi"))
        rows = base.join(bounded_broadcast(wide.select(*scope).distinct()), keys).where(inside)
        cuts = rows.groupBy(*scope).agg(F.array_distinct(F.percentile_approx(
            "__v", [i / CUTS for i in range(1, CUTS)], SKETCH)).alias("__cuts"))
        rows = base.join(bounded_broadcast(cuts, materialize=True), keys).where(inside)
        # 2 * (cut points below the value), plus 1 on a cut point: ordered pieces
        piece = F.size(F.filter("__cuts", lambda c: c < F.col("__v"))) * 2 \
            + F.array_contains("__cuts", F.col("__v")).cast("int")
        hist = rows.withColumn("__b", piece) \
            .groupBy(*scope, "__b").agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__bmin"),
                                        F.max("__v").alias("__bmax"))
        w = Window.partitionBy(*scope).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("__start", F.col("__below") + F.coalesce(F.sum("__n").over(w), F.lit(0)))
        # small (ranks x groups) table; a reliable checkpoint keeps each round's plan flat
        state = cut_lineage(wide.join(hist, scope).where(
            (F.col("__r") >= F.col("__start")) & (F.col("__r") < F.col("__start") + F.col("__n"))).select(
            *keys, "__r", F.col("__bmin").alias("__lo"), F.col("__bmax").alias("__hi"), F.col("__n").alias("__c"),
            F.col("__start").alias("__below"), F.col("__c").alias("__was")))
        if not state.where((F.col("__c") >= F.col("__was")) & (F.col("__lo") < F.col("__hi"))).isEmpty():
            raise RuntimeError("a quantile range could not be narrowed")
    values = found[0]
    for extra in found[1:]:
        values = values.unionByName(extra)
    return values


def _sort_small(base, small, keys):
    """Resolve ranks whose value range holds few rows by sorting them."""
    ranges = small.select(*keys, "__lo", "__hi", "__below").distinct()
    rows = base.join(bounded_broadcast(ranges), keys).where(
        (F.col("__v") >= F.col("__lo")) & (F.col("__v") <= F.col("__hi")))
    sorted_ = rows.groupBy(*keys, "__lo", "__hi", "__below").agg(
        F.sort_array(F.collect_list("__v")).alias("__arr"))
    picked = small.join(sorted_, [*keys, "__lo", "__hi", "__below"])
    return picked.select(*keys, "__r", F.element_at(
        F.col("__arr"), (F.col("__r") - F.col("__below") + 1).cast("int")).alias("__val"))


COLUMN_SORT_ROWS = 10_000  # values of a column that one aggregate sorts


def column_quantile(df: DataFrame, cols: Sequence[str], p: float = 0.5, sort_rows: int = COLUMN_SORT_ROWS) -> dict[str, float | None]:
    """Exact quantile ``p`` of each column (NULL and NaN ignored; None without a value), as ``group_quantiles`` gives it.

    The columns go side by side, each step one aggregate over the rows as they stand; no row is
    unpivoted.  A sketch gives two values close to a column's wanted ranks, exact counts below, on
    and between them tell which open interval holds the ranks, and that one is next; intervals of
    at most ``sort_rows`` values are sorted.  Both values leave the interval, so each step narrows it.
    """
    src = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)]).persist()
    try:
        sizes = src.agg(*[F.count(c) for c in src.columns]).first()
        found = [{} for _ in cols]
        want = [{math.floor((n - 1) * p), math.ceil((n - 1) * p)} if n else set() for n in sizes]
        state = [(None, None, 0, n) for n in sizes]  # open interval, values up to it, values in it

        def inside(i):
            v, (low, high, _, _) = F.col(f"v{i}"), state[i]
            test = v.isNotNull() if low is None else v > low
            return test if high is None else test & (v < high)

        while big := [i for i, s in enumerate(state) if s[3] > sort_rows and want[i] - found[i].keys()]:
            near = []
            for i in big:
                _, _, before, n = state[i]
                ranks = want[i] - found[i].keys()
                share = [(min(ranks) - before) / n - 2 / SKETCH, (max(ranks) + 1 - before) / n + 2 / SKETCH]
                near.append(F.percentile_approx(F.when(inside(i), F.col(f"v{i}")), [min(1.0, max(0.0, x)) for x in share], SKETCH))
            cuts = src.agg(*near).first()
            pieces = []
            for i, (a, b) in zip(big, cuts, strict=True):
                v = F.col(f"v{i}")
                pieces += [F.count_if(inside(i) & t) for t in (v < a, v == a, (v > a) & (v < b), (v == b) & (v > a))]
            counts = src.agg(*pieces).first()
            for k, (i, (a, b)) in enumerate(zip(big, cuts, strict=True)):
                low, high, before, n = state[i]
                below, on_a, between, on_b = counts[4 * k:4 * k + 4]
                for r in want[i] - found[i].keys():
                    at = r - before
                    if at < below:
                        state[i] = (low, a, before, below)
                    elif at < below + on_a:
                        found[i][r] = a
                    elif at < below + on_a + between:
                        state[i] = (a, b, before + below + on_a, between)
                    elif at < below + on_a + between + on_b:
                        found[i][r] = b
                    else:
                        past = below + on_a + between + on_b
                        state[i] = (b, high, before + past, n - past)
        rest = [(i, r) for i in range(len(cols)) for r in sorted(want[i] - found[i].keys())]
        if rest:
            kept = src.agg(*[F.sort_array(F.collect_list(F.when(inside(i), F.col(f"v{i}")))).alias(f"v{i}") for i in sorted({i for i, _ in rest})])
            for (i, r), v in zip(rest, kept.select(*[F.col(f"v{i}")[r - state[i][2]] for i, r in rest]).first(), strict=True):
                found[i][r] = v
    finally:
        src.unpersist()
    out = {}
    for c, n, at in zip(cols, sizes, found, strict=True):
        pos = (n - 1) * p
        low, high = math.floor(pos), math.ceil(pos)
        out[c] = None if not n else at[low] if low == high else (high - pos) * at[low] + (pos - low) * at[high]
    return out


def median(df: DataFrame, by: Sequence[str], value: str | Column, name: str = "median",
           **kw) -> DataFrame:
    return group_quantiles(df, by, value, [0.5], [name], **kw)
