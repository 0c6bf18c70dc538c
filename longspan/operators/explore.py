"""Exploratory statistics of a typed panel."""

from __future__ import annotations

from collections import Counter
from itertools import combinations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from longspan.config import PanelSpec
from longspan.functions.columns import col, column_stats, index_pairs, per_column, percent, unpivot
from longspan.functions.moments import moment_correlation, pair_moments
from longspan.functions.quantiles import BUFFERED_VALUES, column_quantiles, grouped_quantiles, merged, sketch_of, stats_and_quantiles
from longspan.functions.stats import adjusted_skewness, pearson, sample_std
from longspan.operators import profile, validate
from longspan.operators.ranks import rank_correlations
from longspan.session import pin

DISTRIBUTION_PROBS = [0.05, 0.25, 0.50, 0.75, 0.95, 0.99]
DISTRIBUTION_NAMES = ["p5", "p25", "median", "p75", "p95", "p99"]


def overview(df: DataFrame, spec: PanelSpec) -> DataFrame:
    t = col(spec.time)
    return df.agg(
        F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"),
        F.count_distinct(col(spec.entity)).alias("n_entities"), F.min(t).alias("min_date"), F.max(t).alias("max_date"),
    ).withColumn("span_days", F.coalesce(F.date_diff("max_date", "min_date") + 1, F.lit(0)))


def rows_per_entity(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.where(col(spec.entity).isNotNull()).groupBy(col(spec.entity)).agg(F.count("*").alias("n_rows"))


def missing_by_entity(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Missing share of every non-key column per entity, long form."""
    columns = [c for c in df.columns if c not in (spec.entity, spec.time)]
    wide = df.where(col(spec.entity).isNotNull()).groupBy(col(spec.entity)).agg(
        F.count("*").alias("_n"), *[F.count_if(col(c).isNull()).alias(f"_{i}") for i, c in enumerate(columns)]
    )
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), percent(F.col(f"_{i}"), F.col("_n")).alias("pct_missing"))
        for i, c in enumerate(columns)
    ])
    return wide.select(col(spec.entity), F.col("_n").alias("n_rows"), F.inline(cells))


def missing_by_period(df: DataFrame, spec: PanelSpec, columns: list[str]) -> DataFrame:
    """Missing share over the given columns per (entity, month)."""
    month = F.date_format(col(spec.time), "yyyy-MM").alias("month")
    missing = sum((F.count_if(col(c).isNull()) for c in columns[1:]), F.count_if(col(columns[0]).isNull()))
    return df.groupBy(col(spec.entity), month).agg(
        F.count("*").alias("n_rows"), percent(missing, F.count("*") * len(columns)).alias("pct_missing")
    )


def duplicate_summary(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows beyond the first of equal rows, and of equal keys."""
    again = validate.repeats(df, [spec.entity, spec.time])
    return df.sparkSession.createDataFrame([(k, again[k]) for k in ("rows", "keys")], "kind string, n_duplicates bigint")


def fences(df: DataFrame, columns: list[str], reach: float = 1.5) -> DataFrame:
    return _fenced(column_quantiles(df, columns, [0.25, 0.5, 0.75], names=["q25", "median", "q75"]), reach)


def _fenced(q: DataFrame, reach: float = 1.5) -> DataFrame:
    iqr = F.col("q75") - F.col("q25")
    return q.select(
        "column", F.col("n").alias("n_valid"), "q25", "median", "q75", iqr.alias("iqr"),
        (F.col("q25") - reach * iqr).alias("lower"), (F.col("q75") + reach * iqr).alias("upper"),
    )


def _against_fences(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Fences and the long form of the values next to the fences of their column (one row per column)."""
    limits = pin(fences(df, columns))
    return limits, unpivot(df, [], columns).where("value is not null").join(
        F.broadcast(limits.select("column", "lower", "upper")), "column")


def outlier_audit(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values strictly outside the interquartile fences, per column; nothing is removed."""
    limits, values = _against_fences(df, columns)
    outside = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    counted = values.groupBy("column").agg(F.count_if(outside).alias("n_outliers"))
    return limits.drop("median").join(counted, "column").withColumn("pct_outliers", percent(F.col("n_outliers"), F.col("n_valid")))


def box_plot(df: DataFrame, columns: list[str]) -> DataFrame:
    """Quartiles, whisker ends (furthest values within the fences) and outlier count per column."""
    limits, values = _against_fences(df, columns)
    inside = F.when(F.col("value").between(F.col("lower"), F.col("upper")), F.col("value"))
    ends = values.groupBy("column").agg(
        F.min(inside).alias("whisker_low"), F.max(inside).alias("whisker_high"),
        (F.count("*") - F.count(inside)).alias("n_outliers"),
    )
    return limits.drop("iqr", "lower", "upper").join(ends, "column")


def entity_statistics(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Target statistics per entity; an entity without target values keeps nulls."""
    e, y = col(spec.entity), col(spec.target)
    df = df.where(e.isNotNull())
    base = df.groupBy(e).agg(
        F.count("*").alias("n_rows"), F.count(y).alias("n_valid"), F.count_if(y.isNull()).alias("n_missing"),
        F.avg(y).alias("mean"), sample_std(y).alias("std"), F.min(y).alias("min"), F.max(y).alias("max"),
        F.approx_count_distinct(y).alias("_d"),
    )
    return _with_median(df, base, spec.entity, spec.target)


def _with_median(df: DataFrame, base: DataFrame, key: str, value: str) -> DataFrame:
    """Statistics per key (with the distinct values as ``_d``) next to the median: one scan each."""
    base = pin(base)
    found = base.agg(F.max("_d").alias("d"), F.count("*").alias("n")).first()
    median = grouped_quantiles(df, [key], value, [0.5], names=["median"], known=(found["d"] or 0, found["n"])).drop("n")
    return base.drop("_d").join(median, key, "left")


def distribution_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    metrics = {**profile.basic_stats(), "skewness": adjusted_skewness(F.col("value"))}
    return stats_and_quantiles(df, columns, metrics, DISTRIBUTION_PROBS, DISTRIBUTION_NAMES)


def target_summary(df: DataFrame, spec: PanelSpec) -> DataFrame:
    v = F.col("value")
    metrics = {**profile.basic_stats(), "n_missing": F.count_if(v.isNull()), "skewness": adjusted_skewness(v)}
    out = stats_and_quantiles(df, [spec.target], metrics, [*DISTRIBUTION_PROBS, 0.90], [*DISTRIBUTION_NAMES, "p90"])
    return out.withColumn("iqr", F.col("p75") - F.col("p25"))


def _period_statistics(df: DataFrame, period: Column, name: str, value: str) -> DataFrame:
    v = col(value)
    rows = df.select(period.alias(name), v.alias("_value")).where(F.col(name).isNotNull())
    y = F.col("_value")
    base = rows.groupBy(name).agg(
        F.count(y).alias("n"), F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"),
        F.min(y).alias("min"), F.max(y).alias("max"), F.approx_count_distinct(y).alias("_d"),
    )
    return _with_median(rows, base, name, "_value")


def yearly_statistics(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return _period_statistics(df, F.year(col(spec.time)), "year", spec.target)


def monthly_statistics(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """By calendar month over all years."""
    return _period_statistics(df, F.month(col(spec.time)), "month", spec.target)


def month_end_means(df: DataFrame, spec: PanelSpec, entities: list[str] | None = None, by_entity: bool = False) -> DataFrame:
    """Mean target per month end, with a row (null mean) for months without values between the first and the last."""
    known = df.where(col(spec.target).isNotNull())
    if entities is not None:
        known = known.where(col(spec.entity).isin(*entities))
    keys = [spec.entity] if by_entity else []
    key_cols = [col(k) for k in keys]
    means = known.groupBy(*key_cols, F.last_day(col(spec.time)).alias("month_end")).agg(
        F.avg(col(spec.target)).alias("mean")
    )
    span = known.groupBy(*key_cols).agg(F.min(col(spec.time)).alias("_a"), F.max(col(spec.time)).alias("_b"))
    steps = F.sequence(F.trunc("_a", "month"), F.trunc("_b", "month"), F.expr("interval 1 month"))
    calendar = span.where(F.col("_a").isNotNull()).select(*key_cols, F.explode(steps).alias("_m")).select(
        *key_cols, F.last_day("_m").alias("month_end")
    )
    return calendar.join(means, [*keys, "month_end"], "left")


def _ranked(df: DataFrame, *order) -> DataFrame:
    """Rows of a summary (one per column or entity) in order, with their place."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))).orderBy("place")


def entity_ranking(df: DataFrame, spec: PanelSpec) -> DataFrame:
    means = df.where(col(spec.target).isNotNull()).groupBy(col(spec.entity)).agg(F.avg(col(spec.target)).alias("mean"))
    return _ranked(means, "mean", col(spec.entity))


def missing_ranking(df: DataFrame) -> DataFrame:
    return _ranked(profile.missing_by_column(df).where("pct_missing > 0"), F.desc("pct_missing"), "column")


def _over_pairs(df: DataFrame, pairs: list[tuple[str, str]], metrics: dict) -> DataFrame:
    """(x, y, metrics): aggregates of every named column pair on the rows complete for it.

    ``metrics`` maps a name to a function of the two value columns.
    """
    columns = sorted({c for p in pairs for c in p})
    at = {c: i for i, c in enumerate(columns)}
    rows = df.select(F.array(*[col(c).cast("double") for c in columns]).alias("_v"))
    rows = rows.select("_v", index_pairs([(at[x], at[y]) for x, y in pairs]))
    rows = rows.select("pair", F.get("_v", "_a").alias("a"), F.get("_v", "_b").alias("b"))
    rows = rows.where(F.col("a").isNotNull() & F.col("b").isNotNull())
    found = rows.groupBy("pair").agg(*[fn(F.col("a"), F.col("b")).alias(n) for n, fn in metrics.items()])
    names = df.sparkSession.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pairs)], "pair int, x string, y string")
    return names.join(found, "pair", "left").drop("pair")


def _with_diagonal(upper: DataFrame, df: DataFrame, columns: list[str], value: str) -> DataFrame:
    """Mirror the upper triangle and add the diagonal: 1, or null for a constant column."""
    cells = F.array(F.struct("x", "y", value), F.struct(F.col("y").alias("x"), F.col("x").alias("y"), F.col(value)))
    v = F.col("value")
    own = column_stats(df, columns, {value: F.when(F.min(v) < F.max(v), F.lit(1.0))})
    grid = df.sparkSession.createDataFrame([(a, b) for a in columns for b in columns], "x string, y string")
    found = upper.select(F.inline(cells)).unionByName(own.select(F.col("column").alias("x"), F.col("column").alias("y"), value))
    return grid.join(found, ["x", "y"], "left")


def pearson_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """All (x, y, r), each pair on the rows complete for it."""
    upper = pair_moments(df, list(combinations(columns, 2))).select("x", "y", moment_correlation().alias("r"))
    return _with_diagonal(upper, df, columns, "r")


def spearman_matrix(df: DataFrame, spec: PanelSpec, columns: list[str], upper: DataFrame | None = None) -> DataFrame:
    """All (x, y, rho), ranks taken afresh on the rows complete for each pair."""
    if upper is None:
        upper = rank_correlations(df, [spec.entity, spec.time], list(combinations(columns, 2)))
    return _with_diagonal(upper.select("x", "y", "rho"), df, columns, "rho")


def _with_rho(base: DataFrame, df: DataFrame, spec: PanelSpec, measures: list[str], rho: DataFrame | None = None) -> DataFrame:
    if rho is None:
        rho = rank_correlations(df, [spec.entity, spec.time], [(m, spec.target) for m in measures])
    rho = rho.where(F.col("y") == spec.target).select(F.col("x").alias("column"), F.col("rho").alias("spearman_rho"))
    return base.withColumnRenamed("x", "column").drop("y").join(rho, "column", "left").fillna(0, ["n_pairs"])


def target_correlations(df: DataFrame, spec: PanelSpec, rho: DataFrame | None = None) -> DataFrame:
    """Pearson, Spearman and pair count of every measure with the target; ``rho`` may hold rank correlations already at hand."""
    base = pair_moments(df, [(m, spec.target) for m in spec.measures]).select("x", "y", moment_correlation().alias("pearson_r"), "n_pairs")
    return _with_rho(base, df, spec, list(spec.measures), rho)


def regression_lines(df: DataFrame, spec: PanelSpec, measures: list[str]) -> DataFrame:
    """Least-squares line of the target on a measure, with r and rho."""
    lines = _over_pairs(df, [(m, spec.target) for m in measures], {
        "slope": lambda x, y: F.regr_slope(y, x), "intercept": lambda x, y: F.regr_intercept(y, x),
        "r2": lambda x, y: F.regr_r2(y, x), "n_pairs": F.regr_count, "pearson_r": pearson,
    })
    return _with_rho(lines, df, spec, measures)


def histograms(df: DataFrame, bins: dict[str, int]) -> DataFrame:
    """Equal-width bin counts between each column's minimum and maximum; empty bins are present with 0."""
    v = F.col("value")
    spans = column_stats(df, list(bins), {"lo": F.min(v), "hi": F.max(v)}).where("lo is not null").collect()
    limits = {r["column"]: r for r in spans}
    placed = F.array(*[
        F.struct(F.lit(c).alias("column"), _bin(col(c), r["lo"], r["hi"], bins[c]).alias("bin")) for c, r in limits.items()
    ])
    counts = df.select(F.inline(placed)).where(F.col("bin").isNotNull()).groupBy("column", "bin").agg(F.count("*").alias("n"))
    edges = [(c, b, r["lo"] + (b - 1) * (r["hi"] - r["lo"]) / bins[c], r["lo"] + b * (r["hi"] - r["lo"]) / bins[c])
             for c, r in limits.items() for b in range(1, bins[c] + 1)]
    frame = df.sparkSession.createDataFrame(edges, "column string, bin bigint, bin_start double, bin_end double")
    return frame.join(counts, ["column", "bin"], "left").fillna(0, ["n"])


def _bin(v: Column, lo: float, hi: float, n: int) -> Column:
    """1-based bin of a value. Bins are closed at their lower edge, the last one also at its upper; the edges decide."""
    step = (hi - lo) / n if lo < hi else 0.0
    edges = Counter(lo + k * step for k in range(n))
    if len(edges) < n:  # a constant column, or one so narrow that lower edges coincide: all but the last of these bins are empty
        return F.when(v.isNotNull(), sum((F.when(v >= e, times).otherwise(0) for e, times in edges.items()), F.lit(0)).cast("bigint"))
    guess = F.least(F.floor((v - lo) / F.lit(hi - lo) * F.lit(float(n))), F.lit(n - 1).cast("bigint"))
    too_high = v < F.lit(lo) + guess * F.lit(step)
    too_low = (v >= F.lit(lo) + (guess + 1) * F.lit(step)) & (guess < n - 1)
    return guess + F.when(too_high, 0).when(too_low, 2).when(v.isNotNull(), 1)


def category_shares(df: DataFrame, spec: PanelSpec) -> DataFrame:
    counts = profile.category_counts(df, spec)
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("share", F.col("n") / total)


def outlier_ranking(df: DataFrame, columns: list[str]) -> DataFrame:
    return _ranked(outlier_audit(df, columns), F.desc("pct_outliers"), "column")


def correlation_ranking(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return _ranked(target_correlations(df, spec), F.desc_nulls_last("pearson_r"), "column")


def _target_groups(df: DataFrame, spec: PanelSpec) -> Column:
    """(kind, key, v): the target value of a row under its entity, year, month and category."""
    t, y = col(spec.time), col(spec.target).cast("double")
    keys = {"entity": col(spec.entity), "year": F.year(t), "month": F.month(t), "category": F.coalesce(col(spec.category), F.lit("Missing"))}
    return F.array(*[F.struct(F.lit(k).alias("kind"), c.cast("string").alias("key"), y.alias("v")) for k, c in keys.items()])


def _group_sketches(df: DataFrame, spec: PanelSpec, columns: list[str]) -> DataFrame:
    """(kind, key, _n, _sketch) of the target's groups and of the columns, from one scan: the target is sketched by entity and month,
    which merge to entities, years and months of any year; the columns' sketches are observed meanwhile."""
    seen, t, y = Observation("columns"), col(spec.time), col(spec.target)
    watched = [e for c in columns for e in (sketch_of(col(c)).alias(f"sketch|{c}"), F.count(col(c)).alias(f"n|{c}"))]
    cells = pin(df.observe(seen, *watched).groupBy(col(spec.entity).cast("string").alias("entity"), F.year(t).alias("year"), F.month(t).alias("month")).agg(
        sketch_of(y).alias("_sketch"), F.count(y).alias("_n")))
    keys = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("key")) for k in ("entity", "year", "month")])
    up = cells.where("_n > 0").select(F.inline(keys), "_n", "_sketch").where("key is not null").groupBy("kind", "key").agg(
        F.sum("_n").alias("_n"), merged("_sketch").alias("_sketch"))
    own = [("column", c, seen.get[f"n|{c}"], bytearray(seen.get[f"sketch|{c}"])) for c in columns]  # about 80 kB a column
    return up.unionByName(df.sparkSession.createDataFrame(own, "kind string, key string, _n bigint, _sketch binary"))


def _own_value(columns: list[str]) -> Column:
    """(kind, key, v): each column's value under the column's name."""
    return F.array(*[F.struct(F.lit("column").alias("kind"), F.lit(c).alias("key"), col(c).cast("double").alias("v")) for c in columns])


def _outside_counts(df: DataFrame, columns: list[str], limits: DataFrame) -> DataFrame:
    """(column, n_outliers): values of each column outside its fences, from one scan without a shuffle of rows."""
    bounds = {r["column"]: (r["lower"], r["upper"]) for r in limits.collect()}  # a row per column

    def outside(c: str) -> Column:
        low, high = bounds.get(c, (None, None))
        return F.count_if((col(c) < F.lit(low)) | (col(c) > F.lit(high)))

    return per_column(df, columns, {"n_outliers": outside})


def explore_report(df: DataFrame, spec: PanelSpec, buffered: int = BUFFERED_VALUES) -> DataFrame:
    """All sections in long form (section, key, metric, value).

    The panel is written once, whole-table statistics being observed meanwhile, and then read a few times: counts and moments by
    entity, year, month and category; nulls by entity; quantiles of all of these and of the columns, by buffers of at most
    ``buffered`` values or else by one scan that sketches and one that counts; column pairs; outliers; signatures of repeated rows;
    and two passes of the rank correlations.
    """
    lf, spark, numeric = profile.long_form, df.sparkSession, spec.numeric
    others = [c for c in df.columns if c not in (spec.entity, spec.time)]
    whole = Observation("whole")
    per_column = {"known": lambda c: F.count(col(c))}
    per_number = {"n": F.count, "mean": F.avg, "std": sample_std, "min": F.min, "max": F.max, "skewness": adjusted_skewness,
                  "d": F.approx_count_distinct}
    watched = [F.count("*").alias("n_rows"), F.min(col(spec.time)).alias("min_date"), F.max(col(spec.time)).alias("max_date")]
    watched += [fn(c).alias(f"{m}|{c}") for m, fn in per_column.items() for c in df.columns]
    watched += [fn(col(c).cast("double")).alias(f"{m}|{c}") for m, fn in per_number.items() for c in numeric]
    df = pin(df.observe(whole, *watched))
    seen = whole.get

    groups = pin(df.select(F.inline(_target_groups(df, spec))).where("key is not null").groupBy("kind", "key").agg(
        F.count("*").alias("n_rows"), F.count("v").alias("n_valid"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"), F.approx_count_distinct("v").alias("d")))
    nulls = df.where(col(spec.entity).isNotNull()).groupBy(col(spec.entity).cast("string").alias("entity")).agg(
        F.count("*").alias("n_rows"), *[F.count_if(col(c).isNull()).alias(f"_null_{c}") for c in others])
    found = groups.agg(F.max("d").alias("d"), F.count("*").alias("n"), F.count_if(F.col("kind") == "entity").alias("e")).first()
    widest = max([found["d"] or 0, *[seen[f"d|{c}"] or 0 for c in numeric]])

    cells = df.select(F.inline(F.concat(_own_value(numeric), F.filter(_target_groups(df, spec), lambda g: g["kind"] != "category"))))
    probs, names = [*DISTRIBUTION_PROBS, 0.90], [*DISTRIBUTION_NAMES, "p90"]
    quantiles = pin(grouped_quantiles(cells.where("key is not null"), ["kind", "key"], "v", probs, names, buffered,
                                      known=(widest, found["n"] + len(numeric)), sketches=lambda: _group_sketches(df, spec, numeric)))
    own = quantiles.where("kind = 'column'").withColumnRenamed("key", "column")
    limits = _fenced(own.select("column", "n", F.col("p25").alias("q25"), "median", F.col("p75").alias("q75"))).drop("median")

    pairs = list(combinations(numeric, 2))
    centres = {c: seen[f"mean|{c}"] for c in numeric}
    upper = pin(pair_moments(df, pairs, centres).select("x", "y", moment_correlation().alias("r"), "n_pairs"))
    rho = pin(rank_correlations(df, [spec.entity, spec.time], pairs))

    def number_rows(columns: list[str], metrics: list[str]) -> DataFrame:
        kinds = {"n": "bigint"}
        schema = ", ".join(["column string", *[f"{m} {kinds.get(m, 'double')}" for m in metrics]])
        return spark.createDataFrame([(c, *[seen[f"{m}|{c}"] for m in metrics]) for c in columns], schema)

    def by(kind: str, key: str, columns: list[str]) -> DataFrame:
        median = quantiles.where(F.col("kind") == kind).select("key", "median")
        single = F.when(F.col("n_valid") == 1, F.lit(0.0)).otherwise(F.col("std"))
        rows = groups.where(F.col("kind") == kind).join(median, "key", "left")
        rows = rows.withColumns({"n": F.col("n_valid"), "n_missing": F.col("n_rows") - F.col("n_valid"),
                                 "std": single if kind == "entity" else F.col("std")})
        return rows.select(F.col("key").alias(key), *columns)

    days = (seen["max_date"] - seen["min_date"]).days + 1 if seen["min_date"] is not None else 0
    overall = spark.createDataFrame(
        [(seen["n_rows"], len(df.columns), found["e"], seen["min_date"], seen["max_date"], days)],
        "n_rows bigint, n_columns bigint, n_entities bigint, min_date date, max_date date, span_days bigint")
    missing = spark.createDataFrame(
        [(c, seen["n_rows"] - seen[f"known|{c}"], 100.0 * (seen["n_rows"] - seen[f"known|{c}"]) / max(1, seen["n_rows"])) for c in df.columns],
        "column string, n_missing bigint, pct_missing double")
    by_entity = nulls.select("entity", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), percent(col(f"_null_{c}"), F.col("n_rows")).alias("pct_missing")) for c in others])))
    moments = ["n", "mean", "std", "min", "max", "skewness"]
    target = number_rows([spec.target], moments).join(own.drop("n", "kind"), "column", "left").withColumns({
        "n_missing": F.lit(seen["n_rows"] - seen[f"known|{spec.target}"]), "iqr": F.col("p75") - F.col("p25")}).drop("column")
    outliers = limits.join(_outside_counts(df, numeric, limits), "column").withColumn(
        "pct_outliers", percent(F.col("n_outliers"), F.col("n_valid")))
    against = upper.where(F.col("y") == spec.target).select("x", "y", F.col("r").alias("pearson_r"), "n_pairs")
    statistics = ["n", "mean", "median", "std", "min", "max"]
    return profile.union_all([
        lf(overall, "dataset_overview", []),
        lf(by("entity", "entity", ["n_rows"]), "rows_per_entity", ["entity"]),
        lf(missing, "missing_values", ["column"]),
        lf(by_entity, "missing_by_entity", ["entity", "column"]),
        lf(duplicate_summary(df, spec), "duplicates", ["kind"]),
        lf(outliers, "outliers", ["column"]),
        lf(by("entity", "entity", ["n_rows", "n_valid", "n_missing", "mean", "median", "std", "min", "max"]), "entity_statistics", ["entity"]),
        lf(number_rows(list(spec.measures), moments).join(own.drop("n", "kind", "p90"), "column", "left"), "measure_summaries", ["column"]),
        lf(target, "target_summary", []),
        lf(groups.where("kind = 'category'").select(F.col("key").alias("category"), F.col("n_rows").alias("n")), "category_distribution", ["category"]),
        lf(by("year", "year", statistics), "yearly", ["year"]),
        lf(by("month", "month", statistics), "monthly", ["month"]),
        lf(_matrix(upper.select("x", "y", "r"), numeric, seen, "r"), "pearson", ["x", "y"]),
        lf(_matrix(rho.select("x", "y", "rho"), numeric, seen, "rho"), "spearman", ["x", "y"]),
        lf(_with_rho(against, df, spec, list(spec.measures), rho), "target_correlations", ["column"]),
    ])


def _matrix(upper: DataFrame, columns: list[str], seen: dict, value: str) -> DataFrame:
    """Both triangles and the diagonal (1, null for a constant column) from the upper triangle and observed minima and maxima."""
    varies = {c: seen[f"min|{c}"] is not None and seen[f"min|{c}"] < seen[f"max|{c}"] for c in columns}
    own = upper.sparkSession.createDataFrame([(c, c, 1.0 if varies[c] else None) for c in columns], f"x string, y string, {value} double")
    grid = upper.sparkSession.createDataFrame([(a, b) for a in columns for b in columns], "x string, y string")
    both = upper.unionByName(upper.select(F.col("y").alias("x"), F.col("x").alias("y"), value)).unionByName(own)
    return grid.join(both, ["x", "y"], "left")
