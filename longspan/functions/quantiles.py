"""Exact, linearly interpolated quantiles of groups of any size.

The built-in exact percentile keeps every distinct value of a group in one buffer, which is right while groups have few
distinct values; that is checked first. Otherwise a bounded sketch brackets each wanted rank, and brackets that still hold
many values are narrowed by sketches of what is inside them. A caller with many groupings of the same values gives sketches that it
merged from one scan. One aggregate then counts the values between the brackets and
keeps distinct values only inside them, so no task holds more than a sliver of a group. The counts decide the answer, the
sketches only set how narrow the brackets are. Null is a group like any other on either way.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longspan.functions.columns import col, column_stats, unpivot
from longspan.session import pin

ACCURACY = 50_000
BUFFERED_VALUES = 1_000_000   # distinct values of one group that fit an aggregation buffer
BUFFERED_GROUPS = 128         # groups whose buffers one task of a hash aggregate may hold at a time (Spark's own limit)
BUFFERED_TOTAL = 8_000_000    # distinct values that all of these may hold together
SLIVER_ROWS = 1_000_000       # rows of one bracket that one task may order
GRID = 256                    # values by which a bracket is cut when it is narrowed
BROADCAST_GROUPS = 100_000    # groups whose brackets are broadcast
HOT_ROWS = 50_000_000         # rows of one group that may be joined in one task
SKETCH_ITEMS = 4_096          # items of a mergeable sketch: about 80 kB, ranks within 0.1 % of the rows at 99 %
SKETCH_MARGIN = 0.005         # by which brackets from such a sketch reach beyond the wanted rank


def grouped_quantiles(
    df: DataFrame, keys: list[str], value: str, probs: list[float], names: list[str] | None = None,
    buffered: int = BUFFERED_VALUES, known: tuple[int, int] | None = None, sketches: Callable[[], DataFrame] | None = None,
) -> DataFrame:
    """One row per group with its non-null count ``n`` and one column per probability.

    ``known`` tells the distinct values of the widest group (roughly) and the number of groups where a caller has them already;
    ``sketches`` makes the groups' sketches (keys, ``_n``, ``_sketch``), and is called where values don't fit a buffer.
    """
    names = names or [f"p{round(p * 100):d}" for p in probs]
    rows = df.select(*[col(k) for k in keys], col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    group = [col(k) for k in keys]
    if known is None:
        distinct = rows.groupBy(*group).agg(F.approx_count_distinct("_v").alias("_d"))
        found = distinct.agg(F.max("_d").alias("d"), F.count("*").alias("n")).first()
        known = found["d"] or 0, found["n"]
    widest, held = known[0], min(known[1], BUFFERED_GROUPS)
    if widest > buffered or widest * held > max(buffered, BUFFERED_TOTAL):
        ready = sketch_brackets(sketches(), keys, probs) if sketches else None
        return bracketed_quantiles(rows, keys, probs, names, sketch=ready)
    q = F.percentile("_v", [float(p) for p in probs])
    out = rows.groupBy(*group).agg(F.count("*").alias("n"), q.alias("_q"))
    return out.select(*group, "n", *[F.col("_q")[i].alias(nm) for i, nm in enumerate(names)])


def _same_group(rows: DataFrame, keyed: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on the keys, null equal to null; without keys there is one row to attach."""
    if not keys:
        return rows.crossJoin(keyed) if how == "inner" else rows.where(F.lit(False))
    other = keyed.withColumnsRenamed({k: f"_key{i}" for i, k in enumerate(keys)})
    on = reduce(lambda a, b: a & b, [col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])
    return rows.join(other, on, how).drop(*[f"_key{i}" for i in range(len(keys))])


def _with_brackets(rows: DataFrame, sketch: DataFrame, keys: list[str], broadcast_groups: int, hot_rows: int) -> DataFrame:
    """Attach each group's brackets without moving a large group into one task.

    Few groups: broadcast. Many: only the large ones, of which there can be no more than rows / hot_rows.
    """
    if sketch.count() <= broadcast_groups:
        return _same_group(rows, F.broadcast(sketch), keys)
    hot = sketch.where(F.col("_n") > hot_rows)
    cold = _same_group(rows, F.broadcast(hot.select(*[col(k) for k in keys])), keys, "left_anti")
    cold = _same_group(cold, sketch.where(F.col("_n") <= hot_rows), keys)
    return cold.unionByName(_same_group(rows, F.broadcast(hot), keys))


def _narrowed(
    rows: DataFrame, sketch: DataFrame, keys: list[str], probs: list[float], broadcast_groups: int, hot_rows: int, sliver_rows: int
) -> DataFrame | None:
    """Brackets cut down to the part of a grid of their values that holds the wanted ranks; None if that gains nothing."""
    group = [col(k) for k in keys]
    m = len(probs)
    placed = _with_brackets(rows, sketch, keys, broadcast_groups, hot_rows)
    v = F.col("_v")
    inside = [v.between(F.col("_ends")[2 * i], F.col("_ends")[2 * i + 1]) for i in range(m)]
    grid = [F.percentile_approx(F.when(inside[i], v), [k / GRID for k in range(GRID + 1)], F.lit(GRID * 20)) for i in range(m)]
    cut = pin(placed.groupBy(*group, "_n", "_ends").agg(
        F.array(*[F.count_if(v < F.col("_ends")[2 * i]) for i in range(m)]).alias("_below"),
        F.array(*[F.count_if(x) for x in inside]).alias("_in"), F.array(*grid).alias("_grid")))
    ends = []
    for i, p in enumerate(probs):
        rank = F.lit(float(p)) * (F.col("_n") - 1).cast("double")
        place = (rank - F.col("_below")[i]) / F.greatest(F.col("_in")[i], F.lit(1)) * GRID
        low = F.greatest(F.floor(place).cast("int") - 1, F.lit(0))
        high = F.least(F.ceil(place).cast("int") + 2, F.lit(GRID))
        small = F.col("_in")[i] <= sliver_rows
        ends += [F.when(small, F.col("_ends")[2 * i + k]).otherwise(F.get(F.col("_grid")[i], e)) for k, e in enumerate((low, high))]
    out = pin(cut.select(*group, "_n", F.array(*ends).alias("_ends"), F.col("_ends").alias("_before")))
    moved = out.where(~F.col("_ends").eqNullSafe(F.col("_before"))).limit(1).count()
    return out.drop("_before") if moved else None


def sketch_of(value: Column) -> Column:
    """A mergeable sketch of a column's values."""
    return F.kll_sketch_agg_double(value.cast("double"), F.lit(SKETCH_ITEMS))


def merged(sketch: Column) -> Column:
    return F.kll_merge_agg_double(sketch, F.lit(SKETCH_ITEMS))


def sketch_brackets(sketches: DataFrame, keys: list[str], probs: list[float]) -> DataFrame | None:
    """The brackets (keys, ``_n``, ``_ends``) of groups with sketches of all their values; None if some hold NaN, which sketches leave out."""
    sketches = pin(sketches.where(F.col("_n") > 0))
    if sketches.where(F.kll_sketch_get_n_double("_sketch") != F.col("_n")).limit(1).count():
        return None
    ranks = [F.lit(e) for p in probs for e in (max(0.0, p - SKETCH_MARGIN), min(1.0, p + SKETCH_MARGIN))]
    return pin(sketches.select(*[col(k) for k in keys], "_n", F.kll_sketch_get_quantile_double("_sketch", F.array(*ranks)).alias("_ends")))


def _widest(placed: DataFrame, keys: list[str], m: int) -> int:
    """Distinct values, roughly, that the fullest bracket of any group holds."""
    v = F.col("_v")
    inside = [F.approx_count_distinct(F.when(v.between(F.col("_ends")[2 * i], F.col("_ends")[2 * i + 1]), v)) for i in range(m)]
    counted = placed.groupBy(*[col(k) for k in keys]).agg(F.greatest(*inside, F.lit(0)).alias("_w"))
    return counted.agg(F.max("_w").alias("w")).first()["w"] or 0


def bracketed_quantiles(
    rows: DataFrame, keys: list[str], probs: list[float], names: list[str], accuracy: int = ACCURACY,
    broadcast_groups: int = BROADCAST_GROUPS, hot_rows: int = HOT_ROWS, sliver_rows: int = SLIVER_ROWS, sketch: DataFrame | None = None,
) -> DataFrame:
    """Quantiles of ``_v`` by sketch and count, for groups with any number of distinct values. ``sketch`` gives brackets that a caller
    has; where even four margins of the largest group's rows are few, they are not measured first."""
    group = [col(k) for k in keys]
    # The sketch is pinned: every task of the second pass, retried or not, must see the same brackets.
    margin = 3.0 / accuracy
    ends = [e for p in probs for e in (max(0.0, p - margin), min(1.0, p + margin))]
    narrow = sketch is not None and 4 * SKETCH_MARGIN * (sketch.agg(F.max("_n").alias("n")).first()["n"] or 0) <= sliver_rows
    if sketch is None:
        sketch = pin(rows.groupBy(*group).agg(
            F.count("*").alias("_n"), F.percentile_approx("_v", ends, F.lit(accuracy)).alias("_ends")
        ))

    while not narrow and _widest(_with_brackets(rows, sketch, keys, broadcast_groups, hot_rows), keys, len(probs)) > sliver_rows:
        narrower = _narrowed(rows, sketch, keys, probs, broadcast_groups, hot_rows, sliver_rows)
        if narrower is None:
            break
        sketch = narrower

    v, low, high = F.col("_v"), lambda i: F.col("_ends")[2 * i], lambda i: F.col("_ends")[2 * i + 1]
    inside = reduce(lambda a, b: a | b, [(v >= low(i)) & (v <= high(i)) for i in range(len(probs))])
    gap = reduce(lambda a, b: a + b, [F.when(v > high(i), 1).otherwise(0) for i in range(len(probs))])
    placed = _with_brackets(rows, sketch, keys, broadcast_groups, hot_rows).select(*group, "_n", "_v", gap.alias("_gap"), F.when(inside, v).alias("_key"))
    tally = placed.groupBy(*group, "_n", "_gap", "_key").agg(
        F.count("*").alias("_c"), F.min("_v").alias("_min"), F.max("_v").alias("_max")
    )
    # Tally rows cover disjoint value intervals, so ordering by their minimum orders the group.
    upto = F.sum("_c").over(Window.partitionBy(*group).orderBy("_min").rowsBetween(Window.unboundedPreceding, 0))
    tally = tally.withColumn("_upto", upto)

    def at(rank: Column) -> Column:
        holds = (F.col("_upto") - F.col("_c") < rank) & (rank <= F.col("_upto"))
        found = (
            F.when(F.col("_key").isNotNull(), F.col("_key"))
            .when(rank == F.col("_upto"), F.col("_max"))
            .when(rank == F.col("_upto") - F.col("_c") + 1, F.col("_min"))
            .otherwise(F.raise_error(F.lit("quantile rank fell outside its bracket; raise accuracy")).cast("double"))
        )
        return F.max(F.when(holds, found))

    def rank(p: float) -> Column:
        return F.lit(float(p)) * (F.col("_n") - 1).cast("double")

    picked = tally.groupBy(*group, "_n").agg(*[
        e for i, p in enumerate(probs)
        for e in (at(F.floor(rank(p)) + 1).alias(f"_a{i}"), at(F.ceil(rank(p)) + 1).alias(f"_b{i}"))
    ])

    def between(i: int, p: float) -> Column:
        a, b, part = F.col(f"_a{i}"), F.col(f"_b{i}"), rank(p) - F.floor(rank(p))
        return F.when(a == b, a).otherwise(a * (F.lit(1.0) - part) + b * part)

    return picked.select(*group, F.col("_n").alias("n"), *[between(i, p).alias(names[i]) for i, p in enumerate(probs)])


def column_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], keys: list[str] | None = None, names: list[str] | None = None,
    known: tuple[int, int] | None = None,
) -> DataFrame:
    """Quantiles of several columns at once: rows (keys, column, n, one column per probability)."""
    keys = keys or []
    return grouped_quantiles(unpivot(df, keys, columns), [*keys, "column"], "value", probs, names, known=known)


def stats_and_quantiles(df: DataFrame, columns: list[str], metrics: dict[str, Column], probs: list[float], names: list[str]) -> DataFrame:
    """One row per column with aggregates of ``value`` and quantiles, in two scans: the first also counts distinct values."""
    base = pin(column_stats(df, columns, {**metrics, "_d": F.approx_count_distinct("value")}))
    found = base.agg(F.max("_d").alias("d"), F.count("*").alias("n")).first()
    q = column_quantiles(df, columns, probs, names=names, known=(found["d"] or 0, found["n"]))
    return base.drop("_d").join(q.drop("n"), "column", "left")
