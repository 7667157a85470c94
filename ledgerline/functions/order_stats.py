"""Order statistics without funnelling a whole group through one task.

``RANK() OVER (ORDER BY x)`` with no partition and ``PERCENTILE_CONT(0.5)`` both
need the position of a value within an ordered set. Spark's own operators do
that in one task per window partition / aggregation group, which does not
hold when the set is large or one group carries a large share of the rows.

Here the position is a distributed prefix sum over value ranges that are a fixed,
monotone function of the value itself (``ordered_range``: ``RANGES_PER_OCTAVE`` ranges
between any number and its double), so no bounds are estimated, nothing is collected and every
recomputed task sees the same ranges:

1. collapse the input to distinct keys with a multiplicity (partial
   aggregation absorbs hot keys);
2. total the multiplicities of each range (a small aggregate);
3. a window over the range totals of each group gives every range its offset; their number is bounded by the
   ranges between the smallest and the largest value, whatever the number of rows;
4. position = offset of the range + running count before the key inside it.

Equal keys always fall into the same range, so ``RANK`` semantics (equal keys, equal rank; next rank
skips) are exact. All steps are lazy DataFrame operations.

``stored_ranks`` and ``stored_median`` are the form the reports use. They run the input once, into a stored table of
distinct keys with their weights, and refine the ranges by what that table holds: bounds are quantiles of its distinct keys, so
a range has about ``RANGE_ROWS`` of them however closely the values lie together. Bounds and range totals (at most
``MAX_RANGES`` numbers) become literals of the plan; they balance the work only, every position is an exact count. Tables of at most
``RANGE_ROWS`` rows (counted) are one range.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import stored

_W = "_lw_weight"
_R = "_lw_range"

#: ranges between a number and its double: neighbours differ by 0.07 %
RANGES_PER_OCTAVE = 1024
#: distinct keys of a refined range, and the number of ranges at most (beyond, ranges grow and their sort spills)
RANGE_ROWS, MAX_RANGES = 200_000, 256
_SHIFT = RANGES_PER_OCTAVE * 1100  # above the exponent of any double


def ordered_range(key: Column, nulls_first: bool = True) -> Column:
    """Range number of a numeric value, non-decreasing in the value; a NULL is below or above all.

    Non-zero values take the sign times (shifted binary logarithm in steps of 1 / RANGES_PER_OCTAVE); the
    logarithm is monotone, so a larger value never gets a smaller number."""
    x = key.cast("double")
    size = F.floor(F.log2(F.abs(x)) * RANGES_PER_OCTAVE) + _SHIFT
    number = F.when(x == 0, F.lit(0)).when(x > 0, size).otherwise(-size).cast("bigint")
    return F.when(key.isNull(), F.lit(-2 * _SHIFT if nulls_first else 2 * _SHIFT)).otherwise(number).cast("bigint")


def _match(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``cols`` where NULL matches NULL (a NULL group, e.g. a
    month of rows without a date, is a group like any other)."""
    renamed = right.select(
        *[F.col(c).alias(f"_lw_r_{c}") for c in cols],
        *[c for c in right.columns if c not in cols],
    )
    cond = None
    for c in cols:
        term = F.col(c).eqNullSafe(F.col(f"_lw_r_{c}"))
        cond = term if cond is None else cond & term
    return left.join(renamed, cond, how).drop(*[f"_lw_r_{c}" for c in cols])


def _range_offsets(freq: DataFrame, group_cols: Sequence[str], weight: str) -> DataFrame:
    """group, range, weight of the range, weight of the smaller ranges, weight of the group."""
    g = list(group_cols)
    totals = freq.groupBy(*g, _R).agg(F.sum(weight).alias("_lw_rt"))
    w = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    before = F.sum("_lw_rt").over(w.orderBy(_R).rowsBetween(Window.unboundedPreceding, -1))
    return totals.select(
        *g, _R, "_lw_rt", F.coalesce(before, F.lit(0)).alias("_lw_off"), F.sum("_lw_rt").over(w).alias("_lw_n")
    )


def prefix_weight_before(
    df: DataFrame,
    group_cols: Sequence[str],
    key: str,
    weight: str,
    out: str = "_before",
    total_out: str | None = None,
    nulls_first: bool = True,
) -> DataFrame:
    """Add ``out`` = sum of ``weight`` over rows of the same group whose ``key``
    is strictly smaller (NULL keys first or last). ``df`` holds one row per (group, key).
    ``total_out`` adds the group's total weight."""
    g = list(group_cols)
    ranged = df.withColumn(_R, ordered_range(F.col(key), nulls_first))
    offsets = _range_offsets(ranged, g, weight)
    order = F.col(key).asc_nulls_first() if nulls_first else F.col(key).asc_nulls_last()
    inside = Window.partitionBy(*g, _R).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = _match(ranged, offsets, [*g, _R]).withColumn(
        out, F.col("_lw_off") + F.coalesce(F.sum(weight).over(inside), F.lit(0))
    )
    if total_out:
        placed = placed.withColumn(total_out, F.col("_lw_n"))
    return placed.drop(_R, "_lw_rt", "_lw_off", "_lw_n")


@dataclass(frozen=True)
class RankSpec:
    """``RANK() OVER (ORDER BY key [DESC] [NULLS FIRST|LAST])`` into ``out``."""

    key: Column
    out: str
    descending: bool = True
    nulls_first: bool = True


def with_ranks(df: DataFrame, specs: Sequence[RankSpec]) -> DataFrame:
    """Add one ``bigint`` rank column per spec to every row of ``df``; distributed and lazy (see
    module doc). Keys must be numeric."""
    keys = [f"_lw_k{i}" for i in range(len(specs))]
    base = df.select("*", *[s.key.alias(k) for s, k in zip(specs, keys)])
    out = base
    for s, k in zip(specs, keys):
        sort_key = "_lw_sk"
        freq = (
            base.groupBy(k)
            .agg(F.count(F.lit(1)).alias(_W))
            .withColumn(sort_key, -F.col(k) if s.descending else F.col(k))
        )
        ranked = prefix_weight_before(freq, [], sort_key, _W, "_lw_before", nulls_first=s.nulls_first).select(
            F.col(k).alias("_lw_rk"), (F.col("_lw_before") + 1).cast("bigint").alias(s.out)
        )
        out = out.join(ranked, F.col(k).eqNullSafe(F.col("_lw_rk"))).drop("_lw_rk")
    return out.drop(*keys)


def global_rank(
    df: DataFrame,
    key: Column,
    out: str,
    descending: bool = True,
    nulls_first: bool = True,
) -> DataFrame:
    """One rank column; see ``with_ranks``."""
    return with_ranks(df, [RankSpec(key, out, descending, nulls_first)])


def exact_median(
    df: DataFrame,
    group_cols: Sequence[str],
    value: str,
    out: str,
) -> DataFrame:
    """``PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY value)`` per group, exact.

    Returns one row per group (groups whose values are all NULL are absent)
    with ``out`` = (lower middle + upper middle) / 2, in the value's own
    exact type widened by one decimal. Only the one or two ranges that hold the middle
    positions (0.07 % of the value's scale each) are ordered within."""
    g = list(group_cols)
    freq = (
        df.filter(F.col(value).isNotNull())
        .select(*g, value, ordered_range(F.col(value)).alias(_R))
        .groupBy(*g, _R, value)
        .agg(F.count(F.lit(1)).alias(_W))
    )
    lo, hi = F.floor((F.col("_lw_n") - 1) / 2), F.floor(F.col("_lw_n") / 2)
    middle = _range_offsets(freq, g, _W).filter((F.col("_lw_off") <= hi) & (F.col("_lw_off") + F.col("_lw_rt") > lo))
    near = _match(freq, middle, [*g, _R])
    inside = Window.partitionBy(*g, _R).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    placed = near.withColumn("_lw_at", F.col("_lw_off") + F.coalesce(F.sum(_W).over(inside), F.lit(0)))

    def covers(p: Column) -> Column:
        return (F.col("_lw_at") <= p) & (p < F.col("_lw_at") + F.col(_W))

    picked = placed.groupBy(*g).agg(
        F.max(F.when(covers(lo), F.col(value))).alias("_lw_lo"),
        F.max(F.when(covers(hi), F.col(value))).alias("_lw_hi"),
    )
    return picked.select(*g, ((F.col("_lw_lo") + F.col("_lw_hi")) / 2).alias(out))


# ------------------------------------------------------------------ stored, ranges refined by weight
def balanced_bounds(keys: DataFrame, key: str, rows: int) -> list[float]:
    """Ascending values that cut the rows of ``keys`` (``rows`` of them) into ranges of about RANGE_ROWS."""
    parts = min(MAX_RANGES, -(-rows // RANGE_ROWS))
    if parts <= 1:
        return []
    cuts = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    found = keys.agg(F.percentile_approx(F.col(key).cast("double"), cuts, 100 * parts)).first()[0]
    return sorted(set(found or []))


def refined_range(key: Column, bounds: Sequence[float], nulls_first: bool = True) -> Column:
    """Number of bounds at or below the key: non-decreasing in it; a NULL goes with the first or the last. A key is compared
    with about twice the root of their number."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds) - 1) + 1
    blocks = [[F.lit(float(b)) for b in bounds[i : i + step]] for i in range(0, len(bounds), step)]
    count = lambda found, x: F.size(F.filter(found, lambda b: b <= x))

    def place(x: Column) -> Column:
        # blocks that start at or below the key; all but the last of them lie below it, which is looked through
        at = count(F.array(*[b[0] for b in blocks]), x)
        inside = F.element_at(F.array(*[F.array(*b) for b in blocks]), F.greatest(at, F.lit(1)))
        return F.greatest(at - 1, F.lit(0)) * step + count(inside, x)

    below = F.transform(F.array(key.cast("double")), place)[0]  # the key is cast once
    return F.when(key.isNull(), F.lit(0 if nulls_first else len(bounds))).otherwise(below)


def stored_ranks(df: DataFrame, specs: Sequence[RankSpec]) -> DataFrame:
    """``with_ranks`` over a stored copy of ``df`` (its plan runs here, once); see module doc."""
    keys = [f"_lw_k{i}" for i in range(len(specs))]
    base = stored(df.select("*", *[s.key.alias(k) for s, k in zip(specs, keys)]), "ranked-rows")
    out = base
    if base.count() <= RANGE_ROWS:
        for s, k in zip(specs, keys):
            key = -F.col(k) if s.descending else F.col(k)
            order = key.asc_nulls_first() if s.nulls_first else key.asc_nulls_last()
            out = out.withColumn(s.out, F.rank().over(Window.orderBy(order)).cast("bigint"))
        return out.drop(*keys)
    for s, k in zip(specs, keys):
        signed = -F.col(k) if s.descending else F.col(k)
        freq = stored(base.groupBy(k).agg(F.count(F.lit(1)).alias(_W)).withColumn("_lw_sk", signed), "distinct-keys")
        bounds = balanced_bounds(freq, "_lw_sk", freq.count())
        ranged = freq.withColumn(_R, refined_range(F.col("_lw_sk"), bounds, s.nulls_first))
        totals = dict(ranged.groupBy(_R).agg(F.sum(_W)).collect())
        before = [sum(v for r, v in totals.items() if r < i) for i in range(len(bounds) + 1)]
        offset = F.element_at(F.array(*[F.lit(b).cast("bigint") for b in before]), F.col(_R) + 1)
        order = F.col("_lw_sk").asc_nulls_first() if s.nulls_first else F.col("_lw_sk").asc_nulls_last()
        inside = Window.partitionBy(_R).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        place = (offset + F.coalesce(F.sum(_W).over(inside), F.lit(0)) + 1).cast("bigint")
        ranked = ranged.withColumn(s.out, place).select(F.col(k).alias("_lw_rk"), s.out)
        out = out.join(ranked, F.col(k).eqNullSafe(F.col("_lw_rk"))).drop("_lw_rk")
    return out.drop(*keys)


def stored_median(df: DataFrame, group_cols: Sequence[str], value: str, out: str) -> DataFrame:
    """``exact_median`` over a stored table of the distinct values of each group (``df`` runs here, once). After that table
    a plan has at most three exchanges: range totals by group and range, their prefix sums by group, and the
    rows of the one or two ranges that hold a group's middle, by group."""
    g = list(group_cols)
    freq = df.filter(F.col(value).isNotNull()).groupBy(*g, value).agg(F.count(F.lit(1)).alias(_W))
    freq = stored(freq, "distinct-values")
    lo, hi = F.floor((F.col("_lw_n") - 1) / 2), F.floor(F.col("_lw_n") / 2)
    group = Window.partitionBy(*g) if g else Window.partitionBy(F.lit(0))
    before = group.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    rows = freq.count()
    if rows <= RANGE_ROWS:
        placed = freq.withColumns({"_lw_n": F.sum(_W).over(group), "_lw_at": F.coalesce(F.sum(_W).over(before), F.lit(0))})
    else:
        bounds = balanced_bounds(freq, value, rows)
        ranged = freq.withColumn(_R, refined_range(F.col(value), bounds))
        middle = _range_offsets(ranged, g, _W).filter((F.col("_lw_off") <= hi) & (F.col("_lw_off") + F.col("_lw_rt") > lo))
        near = _match(ranged, middle, [*g, _R])
        # the one or two ranges of a group are neighbours: their running counts go on from the first one's offset
        placed = near.withColumn("_lw_at", F.min("_lw_off").over(group) + F.coalesce(F.sum(_W).over(before), F.lit(0)))

    def covers(p: Column) -> Column:
        return (F.col("_lw_at") <= p) & (p < F.col("_lw_at") + F.col(_W))

    picked = placed.groupBy(*g).agg(
        F.max(F.when(covers(lo), F.col(value))).alias("_lw_lo"),
        F.max(F.when(covers(hi), F.col(value))).alias("_lw_hi"),
    )
    picked = picked.filter(F.col("_lw_lo").isNotNull())  # a total over no rows
    return picked.select(*g, ((F.col("_lw_lo") + F.col("_lw_hi")) / 2).alias(out))
