"""Spearman correlation of many column pairs without ranking a whole column in one task.

The rank of a value depends only on its column, the value and which partner must be present. So distinct values are
counted once per column, together with how often each partner is present, and turned into one vector of ranks per
(column, value). Each row looks up the vectors of its values: in a broadcast table while that is small (checked), else by
a join in which the values that fill much of a column are broadcast and only the others move. Equal rows are one row with a
weight there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longspan.functions.columns import col, index_pairs
from longspan.session import pin

RANGE_VALUES = 1_000_000       # distinct values ordered in one task
BROADCAST_BYTES = 128 * 2**20  # size of the rank table up to which it is broadcast
HOT_CELLS = 1_000_000          # cells with one value from which on its vector is broadcast; rows / HOT_CELLS values at most


def _cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """(presence of every column, column number c, value v) for each known value."""
    values = [col(c).cast("double") for c in columns]
    known = F.array(*[v.isNotNull().cast("long") for v in values])
    return df.select(known.alias("known"), F.posexplode(F.array(*values)).alias("c", "v")).where("v is not null")


def _value_ranges(counts: DataFrame, ranges: int) -> DataFrame:
    """Cut each column's distinct values into ranges at sketched quantiles; where the cuts fall only affects balance.

    The cuts (one row per column) are fetched once so that every stage sees the same ones.
    """
    probs = [i / ranges for i in range(1, ranges)]
    rows = counts.groupBy("c").agg(F.percentile_approx("v", probs, F.lit(10 * ranges)).alias("cuts")).collect()
    cuts = counts.sparkSession.createDataFrame([(r["c"], r["cuts"]) for r in rows], "c int, cuts array<double>")
    placed = counts.join(F.broadcast(cuts), "c").withColumn("_range", F.lit(0))
    step = ranges // 2
    while step:  # halving search: how many cuts lie at or below the value
        beyond = F.get("cuts", F.col("_range") + (step - 1)) <= F.col("v")
        placed = placed.withColumn("_range", F.col("_range") + F.when(beyond, step).otherwise(0))
        step //= 2
    return placed.drop("cuts")


def rank_vectors(counts: DataFrame, n_columns: int, range_values: int = RANGE_VALUES) -> DataFrame:
    """(c, v, times, ranks): per partner, how often the value occurs with it and its average rank minus the mean rank."""
    width = range(n_columns)
    largest = counts.groupBy("c").count().agg(F.max("count").alias("n")).first()["n"] or 0
    ranges = 1
    while ranges * range_values < 2 * largest and largest > range_values:
        ranges *= 2
    placed = _value_ranges(counts, ranges) if ranges > 1 else counts.withColumn("_range", F.lit(0))

    whole = Window.partitionBy("c")
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("c", "_range").agg(*[F.sum(f"n{j}").alias(f"t{j}") for j in width])
    totals = totals.select("c", "_range", *[
        (F.coalesce(F.sum(f"t{j}").over(earlier), F.lit(0)) - (F.sum(f"t{j}").over(whole) + 1) / F.lit(2.0)).alias(f"o{j}")
        for j in width
    ])
    upto = Window.partitionBy("c", "_range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = placed.select("*", *[F.sum(f"n{j}").over(upto).alias(f"u{j}") for j in width])
    ranked = ranked.join(totals, ["c", "_range"])  # both sides lie by (column, range) already
    ranks = [F.col(f"o{j}") + F.col(f"u{j}") - (F.col(f"n{j}") - 1) / F.lit(2.0) for j in width]
    return ranked.select("c", "v", F.array(*[F.col(f"n{j}") for j in width]).alias("times"), F.array(*ranks).alias("ranks"))


def _looked_up(df: DataFrame, columns: list[str], vectors: DataFrame) -> tuple[DataFrame, list[Column], Column]:
    """Rank vectors per row from broadcast tables; (rows, vector per column, row weight)."""
    out = df.select(*[col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(columns)])
    for i in range(len(columns)):
        one = vectors.where(F.col("c") == i).select(F.col("v").alias(f"_v{i}"), F.col("ranks").alias(f"_r{i}"))
        out = out.join(F.broadcast(one), f"_v{i}", "left")
    return out, [F.col(f"_r{i}") for i in range(len(columns))], F.lit(1.0)


def _joined_back(df: DataFrame, columns: list[str], vectors: DataFrame, hot_cells: int) -> tuple[DataFrame, list[Column], Column]:
    """Rank vectors per row by a join on (column, value) and regrouping by row.

    Rows that are equal in all columns are counted first, in their tasks as far as they meet there. Each different row has a
    number and its count as a weight, so a group of cells is never larger than a row, however often the row repeats.
    """
    values = [f"_v{i}" for i in range(len(columns))]
    rows = df.select(*[col(c).cast("double").alias(v) for c, v in zip(columns, values, strict=True)]).groupBy(*values).agg(F.count("*").alias("_w"))
    rows = pin(rows.withColumn("_id", F.monotonically_increasing_id()))
    slim = rows.select("_id", "_w", F.posexplode(F.array(*values)).alias("c", "v")).where("v is not null")
    ranks, hot = vectors.select("c", "v", "ranks"), F.get("times", F.col("c")) >= hot_cells
    frequent, rare = vectors.where(hot).select("c", "v", "ranks"), ranks.join(vectors.where(hot).select("c", "v"), ["c", "v"], "left_anti")
    found = slim.join(F.broadcast(frequent), ["c", "v"]).unionByName(
        slim.join(F.broadcast(frequent.select("c", "v")), ["c", "v"], "left_anti").join(rare, ["c", "v"]))
    found = found.groupBy("_id").agg(F.first("_w").alias("_w"), F.map_from_entries(F.collect_list(F.struct("c", "ranks"))).alias("_r"))
    return found, [F.try_element_at("_r", F.lit(i)) for i in range(len(columns))], F.col("_w").cast("double")


def rank_correlations(
    df: DataFrame, key: list[str], pairs: list[tuple[str, str]], range_values: int = RANGE_VALUES,
    broadcast_bytes: int = BROADCAST_BYTES, hot_cells: int = HOT_CELLS,
) -> DataFrame:
    """(x, y, rho, n_pairs): ties share their average rank; rho is null when a side is constant.

    Rows equal in all values are counted as often as they occur, whatever their ``key``.
    """
    columns = sorted({c for p in pairs for c in p})
    m, number = len(columns), {c: i for i, c in enumerate(columns)}
    cells = _cells(df, columns)
    counts = pin(cells.groupBy("c", "v").agg(*[F.sum(F.col("known")[j]).alias(f"n{j}") for j in range(m)]))
    vectors = pin(rank_vectors(counts, m, range_values))
    small = counts.count() * (8 * m + 64) <= broadcast_bytes
    rows, rank, weight = _looked_up(df, columns, vectors) if small else _joined_back(df, columns, vectors, hot_cells)

    rows = rows.select(weight.alias("_w"), F.array(*rank).alias("_r"))
    rows = rows.select("_w", "_r", index_pairs([(number[a], number[b]) for a, b in pairs]))
    product = F.get(F.get("_r", "_a"), F.col("_b")) * F.get(F.get("_r", "_b"), F.col("_a"))
    crossed = rows.select("_w", "pair", product.alias("_p")).where("_p is not null")
    crossed = crossed.groupBy("pair").agg(F.sum(F.col("_w") * F.col("_p")).alias("sxy"), F.sum("_w").cast("long").alias("n_pairs"))

    squares = vectors.select("c", F.posexplode(F.arrays_zip("times", "ranks")).alias("partner", "_z")).groupBy("c", "partner").agg(
        F.sum(F.col("_z.times") * F.col("_z.ranks") * F.col("_z.ranks")).alias("ss")
    )
    names = [(i, a, b, number[a], number[b]) for i, (a, b) in enumerate(pairs)]
    names = df.sparkSession.createDataFrame(names, "pair int, x string, y string, cx int, cy int")
    sx = squares.select(F.col("c").alias("cx"), F.col("partner").alias("cy"), F.col("ss").alias("sxx"))
    sy = squares.select(F.col("c").alias("cy"), F.col("partner").alias("cx"), F.col("ss").alias("syy"))
    out = names.join(crossed, "pair").join(sx, ["cx", "cy"]).join(sy, ["cx", "cy"])
    return out.select("x", "y", F.try_divide(F.col("sxy"), F.sqrt(F.col("sxx") * F.col("syy"))).alias("rho"), "n_pairs")
