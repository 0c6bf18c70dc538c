"""Exploratory statistics."""

from itertools import combinations

from pyspark.sql import functions as F

from longspan.config import PanelSpec
from longspan.operators import explore, profile
from longspan.functions.quantiles import bracketed_quantiles
from longspan.operators.ranks import rank_correlations
from registry import sql
from registry.core import MEASURES, NUMERIC, SPEC, panel, query, table, tidy
from registry.profiling import MISSING, summary


@query("E1_overview", sql.with_(sql.PANEL, f"""
SELECT count(*) AS n_rows, CAST(16 AS BIGINT) AS n_columns, count(DISTINCT entity) AS n_entities, {sql.day('min(d)', 'min_date')},
       {sql.day('max(d)', 'max_date')}, CAST(max(d) - min(d) + 1 AS BIGINT) AS span_days FROM panel"""))
def overview(spark, sf):
    return tidy(explore.overview(panel(spark, sf), SPEC))


@query("E1_rows_per_entity", sql.with_(sql.PANEL, "SELECT entity, count(*) AS n_rows FROM panel GROUP BY 1"))
def rows_per_entity(spark, sf):
    return explore.rows_per_entity(panel(spark, sf), SPEC)


@query("E2_missing_by_column", sql.with_(sql.PANEL, MISSING))
def missing_by_column(spark, sf):
    return tidy(profile.missing_by_column(panel(spark, sf)))


@query("E3_missing_by_entity", sql.with_(sql.PANEL, sql.union(
    f"""SELECT entity, count(*) AS n_rows, '{c}' AS "column", {sql.r(f'100.0::DOUBLE * (count(*) - count({c})) / count(*)', 'pct_missing')}
    FROM panel GROUP BY entity""" for c in [*NUMERIC, "bucket"])))
def missing_by_entity(spark, sf):
    return tidy(explore.missing_by_entity(panel(spark, sf), SPEC))


@query("E4_duplicates", sql.with_(sql.PANEL, f"""
SELECT 'rows' AS kind, CAST(sum(c - 1) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS c FROM panel GROUP BY {', '.join(SPEC.required)})
UNION ALL SELECT 'keys', CAST(sum(c - 1) AS BIGINT) FROM (SELECT count(*) AS c FROM panel GROUP BY entity, d)"""))
def duplicates(spark, sf):
    return explore.duplicate_summary(panel(spark, sf), SPEC)


def _fences(c: str) -> str:
    return (f"SELECT '{c}' AS \"column\", {c} AS v, quantile_cont({c}, 0.25) OVER () AS q25, quantile_cont({c}, 0.75) OVER () AS q75 "
            f"FROM panel WHERE {c} IS NOT NULL")


_FENCES = sql.PANEL + f", fence AS MATERIALIZED (SELECT *, q25 - 1.5::DOUBLE * (q75 - q25) AS lo, q75 + 1.5::DOUBLE * (q75 - q25) AS hi FROM ({sql.union(_fences(c) for c in NUMERIC)}))"
_AUDIT = f"""SELECT "column", count(*) AS n_valid, {sql.r('max(q25)', 'q25')}, {sql.r('max(q75)', 'q75')}, {sql.r('max(q75 - q25)', 'iqr')},
  {sql.r('max(lo)', 'lower')}, {sql.r('max(hi)', 'upper')}, count(*) FILTER (WHERE v < lo OR v > hi) AS n_outliers,
  {sql.r('100.0::DOUBLE * count(*) FILTER (WHERE v < lo OR v > hi) / count(*)', 'pct_outliers')} FROM fence GROUP BY "column" """


@query("E5_outlier_audit", sql.with_(_FENCES, _AUDIT))
def outlier_audit(spark, sf):
    return tidy(explore.outlier_audit(panel(spark, sf), NUMERIC))


@query("E6_entity_statistics", sql.with_(sql.PANEL, f"""
SELECT entity, count(*) AS n_rows, count(target) AS n_valid, count(*) - count(target) AS n_missing, {sql.r('avg(target)', 'mean')},
  {sql.r('quantile_cont(target, 0.5)', 'median')}, {sql.r('CASE WHEN count(target) = 1 THEN 0.0 ELSE stddev_samp(target) END', 'std')},
  {sql.r('min(target)', 'min')}, {sql.r('max(target)', 'max')} FROM panel GROUP BY entity"""))
def entity_statistics(spark, sf):
    return tidy(explore.entity_statistics(panel(spark, sf), SPEC))


_PROBS = dict(zip(explore.DISTRIBUTION_NAMES, explore.DISTRIBUTION_PROBS))


@query("E6_entity_statistics_bracketed", sql.with_(sql.PANEL, f"""
SELECT entity, {', '.join(sql.r(f'quantile_cont(target, {p})', n) for p, n in ((0.05, 'p5'), (0.5, 'median'), (0.95, 'p95')))}, count(target) AS n
FROM (SELECT CASE WHEN entity <> 'NATION_13' THEN entity END AS entity, target FROM panel) GROUP BY entity HAVING count(target) > 0"""))
def entity_statistics_bracketed(spark, sf):
    """The way that groups of many distinct values take, forced, with brackets narrowed twice and a group whose key is null."""
    rows = panel(spark, sf).select(F.when(F.col("entity") != "NATION_13", F.col("entity")).alias("entity"), F.col("target").alias("_v"))
    found = bracketed_quantiles(rows.where("_v IS NOT NULL"), ["entity"], [0.05, 0.5, 0.95], ["p5", "median", "p95"], accuracy=100, sliver_rows=5)
    return tidy(found)


@query("E7_distributions", sql.with_(sql.PANEL, sql.union(summary(c, _PROBS, 4, sql.r(f"skewness({c})", "skewness", 4) + ",") for c in MEASURES)))
def distributions(spark, sf):
    return tidy(explore.distribution_summary(panel(spark, sf), MEASURES), 4)


@query("E8_target_summary", sql.with_(sql.PANEL, summary("target", {**_PROBS, "p90": 0.9}, 4, sql.r("skewness(target)", "skewness", 4)
       + ", count(*) - count(target) AS n_missing, " + sql.r("quantile_cont(target, 0.75) - quantile_cont(target, 0.25)", "iqr", 4) + ",")))
def target_summary(spark, sf):
    return tidy(explore.target_summary(panel(spark, sf), SPEC), 4)


def _period(fn: str, time: str, value: str, source: str, digits: int) -> str:
    return f"""SELECT CAST({fn}({time}) AS BIGINT) AS {fn}, count({value}) AS n, {sql.r(f'avg({value})', 'mean', digits)},
    {sql.r(f'quantile_cont({value}, 0.5)', 'median', digits)}, {sql.r(f'stddev_samp({value})', 'std', digits)},
    {sql.r(f'min({value})', 'min', digits)}, {sql.r(f'max({value})', 'max', digits)} FROM {source} GROUP BY 1"""


ORDERS = PanelSpec(entity="o_custkey", time="o_orderdate", measures=(), target="o_totalprice", category="o_orderstatus")


@query("E9_yearly", sql.with_(sql.PANEL, _period("year", "d", "target", "panel", 4)))
def yearly(spark, sf):
    return tidy(explore.yearly_statistics(panel(spark, sf), SPEC), 4)


@query("E9_yearly_orders", _period("year", "o_orderdate", "o_totalprice", "orders", 2))
def yearly_orders(spark, sf):
    return tidy(explore.yearly_statistics(table(spark, sf, "orders"), ORDERS), 2)


@query("E10_monthly", sql.with_(sql.PANEL, _period("month", "d", "target", "panel", 4)))
def monthly(spark, sf):
    return tidy(explore.monthly_statistics(panel(spark, sf), SPEC), 4)


@query("E10_monthly_orders", _period("month", "o_orderdate", "o_totalprice", "orders", 2))
def monthly_orders(spark, sf):
    return tidy(explore.monthly_statistics(table(spark, sf, "orders"), ORDERS), 2)


_PAIRS = list(combinations(NUMERIC, 2))


def _mirror(parts: str, value: str) -> str:
    diagonal = sql.union(f"SELECT '{c}' AS x, '{c}' AS y, 1.0::DOUBLE AS {value}" for c in NUMERIC)
    return f", upper_part AS MATERIALIZED ({parts})", f"""SELECT x, y, {sql.r(value, value)} FROM (
    SELECT x, y, {value} FROM upper_part UNION ALL SELECT y, x, {value} FROM upper_part UNION ALL {diagonal})"""


_pearson_cte, _pearson_body = _mirror(sql.union(f"SELECT '{a}' AS x, '{b}' AS y, corr({a}, {b}) AS r FROM panel" for a, b in _PAIRS), "r")


@query("E11_pearson_matrix", sql.with_(sql.PANEL + _pearson_cte, _pearson_body))
def pearson_matrix(spark, sf):
    return tidy(explore.pearson_matrix(panel(spark, sf), NUMERIC))


def _ranked(a: str, b: str) -> str:
    def rank(c):
        return f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE"
    return f"(SELECT {rank(a)} AS rx, {rank(b)} AS ry FROM panel WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"


_spearman_cte, _spearman_body = _mirror(
    sql.union(f"SELECT '{a}' AS x, '{b}' AS y, corr(rx, ry) AS rho FROM {_ranked(a, b)}" for a, b in _PAIRS), "rho")


@query("E12_spearman_matrix", sql.with_(sql.PANEL + _spearman_cte, _spearman_body))
def spearman_matrix(spark, sf):
    return tidy(explore.spearman_matrix(panel(spark, sf), SPEC, NUMERIC))


_JOIN_PAIRS = [("qty_a", "target"), ("disc_a", "price_n"), ("tax_r", "qty_n")]
_TWICE = """,
twice AS (SELECT * FROM panel UNION ALL SELECT * REPLACE (NULL AS qty_a, target AS disc_a) FROM panel WHERE month(d) = 3
  UNION ALL SELECT * REPLACE (NULL AS target, qty_a AS disc_a) FROM panel WHERE month(d) = 3)"""


@query("E12_spearman_join_path", sql.with_(sql.PANEL + _TWICE, sql.union(
    f"SELECT '{a}' AS x, '{b}' AS y, {sql.r('corr(rx, ry)', 'rho')}, count(*) AS n_pairs FROM {_ranked(a, b).replace('FROM panel', 'FROM twice')}"
    for a, b in _JOIN_PAIRS)))
def spearman_join_path(spark, sf):
    """The way that large rank tables take, forced: keys that occur three times with different gaps, frequent values broadcast."""
    rows, march = panel(spark, sf), F.month("d") == 3
    none = F.lit(None).cast("double")
    rows = rows.unionByName(rows.where(march).withColumns({"disc_a": F.col("target").cast("double"), "qty_a": none})).unionByName(
        rows.where(march).withColumns({"disc_a": F.col("qty_a").cast("double"), "target": none}))
    return tidy(rank_correlations(rows, ["entity", "d"], _JOIN_PAIRS, broadcast_bytes=0, hot_cells=200, range_values=500))


_TARGET_CORR = sql.union(f"""SELECT '{m}' AS "column", (SELECT corr({m}, target) FROM panel) AS pearson_r,
  (SELECT regr_count({m}, target) FROM panel) AS n_pairs, (SELECT corr(rx, ry) FROM {_ranked(m, 'target')}) AS spearman_rho""" for m in MEASURES)
_TARGET_CORR = f'SELECT "column", {sql.r("pearson_r", "pearson_r")}, CAST(n_pairs AS BIGINT) AS n_pairs, {sql.r("spearman_rho", "spearman_rho")} FROM ({_TARGET_CORR})'


@query("E13_target_correlations", sql.with_(sql.PANEL, _TARGET_CORR))
def target_correlations(spark, sf):
    return tidy(explore.target_correlations(panel(spark, sf), SPEC))


_BINS = {**{m: 40 for m in MEASURES}, "target": 60}


def _histogram(c: str, n: int) -> str:
    return f"""SELECT '{c}' AS "column", bin, {sql.r('max(lo) + (bin - 1) * max(hi - lo) / ' + str(n), 'bin_start')}, {sql.r('max(lo) + bin * max(hi - lo) / ' + str(n), 'bin_end')}, count(v) AS n
    FROM (SELECT min({c}) AS lo, max({c}) AS hi FROM panel) CROSS JOIN (SELECT unnest(range(1, {n + 1})) AS bin)
    LEFT JOIN (SELECT {c} AS v FROM panel WHERE {c} IS NOT NULL) ON v >= lo + (bin - 1) * ((hi - lo) / {n}) AND (v < lo + bin * ((hi - lo) / {n}) OR bin = {n})
    GROUP BY bin"""


@query("E15_histograms", sql.with_(sql.PANEL, sql.union(_histogram(c, n) for c, n in _BINS.items())))
def histograms(spark, sf):
    return tidy(explore.histograms(panel(spark, sf), _BINS))


def _month_ends(where: str, keys: str) -> str:
    k = f"{keys}, " if keys else ""
    return f"""
known AS (SELECT * FROM panel WHERE target IS NOT NULL AND {where}),
means AS (SELECT {k}last_day(d) AS month_end, avg(target) AS mean FROM known GROUP BY ALL),
months AS (SELECT {k}last_day(CAST(unnest(generate_series(date_trunc('month', a), date_trunc('month', b), INTERVAL 1 MONTH)) AS DATE)) AS month_end
           FROM (SELECT {k}min(d) AS a, max(d) AS b FROM known GROUP BY ALL))"""


@query("E16_month_end_means", sql.with_(sql.PANEL + "," + _month_ends("true", ""), f"""
SELECT CAST(month_end AS VARCHAR) AS month_end, {sql.r('mean', 'mean')} FROM months LEFT JOIN means USING (month_end)"""))
def month_end_means(spark, sf):
    return tidy(explore.month_end_means(panel(spark, sf), SPEC))


@query("E16_month_end_by_entity", sql.with_(sql.PANEL + "," + _month_ends("true", "entity"), f"""
SELECT entity, CAST(month_end AS VARCHAR) AS month_end, {sql.r('mean', 'mean')} FROM months LEFT JOIN means USING (entity, month_end)"""))
def month_end_by_entity(spark, sf):
    return tidy(explore.month_end_means(panel(spark, sf), SPEC, by_entity=True))


@query("E16_month_end_selected", sql.with_(sql.PANEL + "," + _month_ends("entity IN ('NATION_13', 'NATION_8')", "entity"), f"""
SELECT entity, CAST(month_end AS VARCHAR) AS month_end, {sql.r('mean', 'mean')} FROM months LEFT JOIN means USING (entity, month_end)"""))
def month_end_selected(spark, sf):
    return tidy(explore.month_end_means(panel(spark, sf), SPEC, ["NATION_13", "NATION_8"], by_entity=True))


@query("E17_entity_ranking", sql.with_(sql.PANEL, f"""
SELECT entity, {sql.r('avg(target)', 'mean')}, row_number() OVER (ORDER BY avg(target), entity) AS place FROM panel WHERE target IS NOT NULL GROUP BY entity"""))
def entity_ranking(spark, sf):
    return tidy(explore.entity_ranking(panel(spark, sf), SPEC))


@query("E18_missing_ranking", sql.with_(sql.PANEL, f"""
SELECT *, row_number() OVER (ORDER BY pct_missing DESC, "column") AS place FROM ({MISSING}) WHERE pct_missing > 0"""))
def missing_ranking(spark, sf):
    return tidy(explore.missing_ranking(panel(spark, sf)))


_LINES = ["qty_a", "price_a", "qty_n"]


@query("E19_regression_lines", sql.with_(sql.PANEL, sql.union(f"""
SELECT '{m}' AS "column", {sql.r(f'regr_slope(target, {m})', 'slope')}, {sql.r(f'regr_intercept(target, {m})', 'intercept')},
  {sql.r(f'regr_r2(target, {m})', 'r2')}, CAST(regr_count(target, {m}) AS BIGINT) AS n_pairs, {sql.r(f'corr({m}, target)', 'pearson_r')},
  {sql.r(f'(SELECT corr(rx, ry) FROM {_ranked(m, "target")})', 'spearman_rho')} FROM panel""" for m in _LINES)))
def regression_lines(spark, sf):
    return tidy(explore.regression_lines(panel(spark, sf), SPEC, _LINES))


@query("E20_category_shares", sql.with_(sql.PANEL, f"""
SELECT coalesce(bucket, 'Missing') AS category, count(*) AS n, {sql.r('count(*) / sum(count(*)) OVER ()', 'share')} FROM panel GROUP BY 1"""))
def category_shares(spark, sf):
    return tidy(explore.category_shares(panel(spark, sf), SPEC))


@query("E21_outlier_ranking", sql.with_(_FENCES, f'SELECT *, row_number() OVER (ORDER BY pct_outliers DESC, "column") AS place FROM ({_AUDIT})'))
def outlier_ranking(spark, sf):
    return tidy(explore.outlier_ranking(panel(spark, sf), NUMERIC))


@query("E21_correlation_ranking", sql.with_(sql.PANEL, f'SELECT *, row_number() OVER (ORDER BY pearson_r DESC NULLS LAST, "column") AS place FROM ({_TARGET_CORR})'))
def correlation_ranking(spark, sf):
    return tidy(explore.correlation_ranking(panel(spark, sf), SPEC))


_ABSENT = " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in MEASURES)


@query("B23_missingness_matrix", sql.with_(sql.PANEL, f"""
SELECT entity, strftime(d, '%Y-%m') AS month, count(*) AS n_rows, {sql.r(f'100.0::DOUBLE * sum({_ABSENT}) / (count(*) * {len(MEASURES)})', 'pct_missing')}
FROM panel GROUP BY 1, 2"""))
def missingness_matrix(spark, sf):
    return tidy(explore.missing_by_period(panel(spark, sf), SPEC, MEASURES))


@query("B28_box_plot", sql.with_(_FENCES, f"""
SELECT "column", count(*) AS n_valid, {sql.r('max(q25)', 'q25')}, {sql.r('max(q75)', 'q75')}, {sql.r('quantile_cont(v, 0.5)', 'median')},
  {sql.r('min(v) FILTER (WHERE v >= lo AND v <= hi)', 'whisker_low')}, {sql.r('max(v) FILTER (WHERE v >= lo AND v <= hi)', 'whisker_high')},
  count(*) FILTER (WHERE v < lo OR v > hi) AS n_outliers FROM fence GROUP BY "column" """))
def box_plot(spark, sf):
    return tidy(explore.box_plot(panel(spark, sf), NUMERIC))
