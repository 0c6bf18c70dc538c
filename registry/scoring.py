"""Forecast scoring of naive forecasts."""

from pyspark.sql import functions as F

from longspan.config import CATEGORY_LABELS
from longspan.operators import scoring
from registry import sql
from registry.core import SPEC, panel, prepared, query, tidy

_SCORED = sql.IMPUTED + f""",
naive AS (SELECT entity, d, split, lag(target) OVER w AS persistence,
    avg(target) OVER (PARTITION BY entity ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS mean_7,
    (SELECT target FROM medians) AS train_median FROM imputed WINDOW w AS (PARTITION BY entity ORDER BY d)),
forecasts AS (SELECT entity, d, split, 'persistence' AS model, persistence AS prediction FROM naive WHERE persistence IS NOT NULL
    UNION ALL SELECT entity, d, split, 'mean_7', mean_7 FROM naive WHERE mean_7 IS NOT NULL
    UNION ALL SELECT entity, d, split, 'train_median', train_median FROM naive),
all_scored AS MATERIALIZED (SELECT f.*, p.target AS actual, prediction - p.target AS error, {sql.band('prediction')} AS predicted_category,
    {sql.band('p.target')} AS actual_category FROM forecasts f JOIN panel p ON p.entity = f.entity AND p.d = f.d WHERE p.target IS NOT NULL),
scored AS (SELECT * FROM all_scored WHERE split = 'test')"""


def _scored(spark, sf):
    done = prepared(spark, sf)
    forecasts = scoring.naive_forecasts(done.table, SPEC, done.params["target"].median)
    return scoring.forecast_vs_actual(forecasts, panel(spark, sf), SPEC)


def _test(spark, sf):
    return _scored(spark, sf).where("split = 'test'")


@query("B6_forecast_vs_actual", sql.with_(_SCORED, f"""
SELECT entity, {sql.day('d', 'd')}, split, model, {sql.r('prediction', 'prediction')}, {sql.r('actual', 'actual')}, {sql.r('error', 'error')},
  predicted_category, actual_category, predicted_category = actual_category AS category_match FROM all_scored"""))
def forecast_vs_actual(spark, sf):
    return tidy(_scored(spark, sf))


_METRICS = f"""SELECT model, count(*) AS n, sqrt(avg(error * error)) AS rmse, avg(abs(error)) AS mae,
  1 - sum(error * error) / (var_pop(actual) * count(*)) AS r2, avg(abs(error / nullif(actual, 0))) * 100 AS mape FROM scored GROUP BY model"""


@query("B7_regression_metrics", sql.with_(_SCORED, f"SELECT model, n, {', '.join(sql.r(c, c) for c in ('rmse', 'mae', 'r2', 'mape'))} FROM ({_METRICS})"))
def regression_metrics(spark, sf):
    return tidy(scoring.regression_metrics(_test(spark, sf)))


@query("B8_huber_loss", sql.with_(_SCORED, f"""
SELECT model, {sql.r('avg(CASE WHEN abs(error) <= 1 THEN 0.5::DOUBLE * error * error ELSE abs(error) - 0.5::DOUBLE END)', 'huber')} FROM scored GROUP BY model"""))
def huber_loss(spark, sf):
    return tidy(scoring.huber_loss(_test(spark, sf)))


_CLASSES = """, classes AS (SELECT model, category, sum(a) AS n_actual, sum(p) AS n_predicted, sum(h) AS tp FROM (
    SELECT model, actual_category AS category, 1 AS a, 0 AS p, CASE WHEN actual_category = predicted_category THEN 1 ELSE 0 END AS h FROM scored
    UNION ALL SELECT model, predicted_category, 0, 1, 0 FROM scored) GROUP BY 1, 2),
rates AS (SELECT *, coalesce(tp / nullif(n_predicted, 0), 0.0) AS p, coalesce(tp / nullif(n_actual, 0), 0.0) AS rc FROM classes),
f1s AS (SELECT *, coalesce(2 * p * rc / nullif(p + rc, 0), 0.0) AS f1 FROM rates)"""


@query("B9_category_metrics", sql.with_(_SCORED + _CLASSES, f"""
SELECT model, {sql.r('sum(tp) / sum(n_actual)', 'accuracy')}, {sql.r('avg(p)', 'macro_precision')}, {sql.r('avg(rc)', 'macro_recall')},
  {sql.r('avg(f1)', 'macro_f1')}, {sql.r("max(rc) FILTER (WHERE category = 'Severe' AND n_actual > 0)", 'severe_recall')} FROM f1s GROUP BY model"""))
def category_metrics(spark, sf):
    return tidy(scoring.category_metrics(_test(spark, sf)))


@query("B10_confusion_matrix", sql.with_(_SCORED, "SELECT model, actual_category, " + ", ".join(
    f"count(*) FILTER (WHERE predicted_category = '{c}') AS as_{c.lower().replace(' ', '_')}" for c in CATEGORY_LABELS) + " FROM scored GROUP BY 1, 2"))
def confusion_matrix(spark, sf):
    return scoring.confusion_matrix(_test(spark, sf))


@query("B11_model_ranking", sql.with_(_SCORED, f"""
SELECT model, {sql.r('rmse', 'rmse')}, row_number() OVER (ORDER BY rmse, model) AS rank, {sql.r('rmse - lag(rmse) OVER (ORDER BY rmse, model)', 'delta')} FROM ({_METRICS})"""))
def model_ranking(spark, sf):
    return tidy(scoring.model_ranking(scoring.regression_metrics(_test(spark, sf))))


_ORDER = ["train_median", "persistence", "mean_7"]


@query("B11_ablation", sql.with_(_SCORED, f"""
SELECT model, {sql.r('rmse', 'rmse')}, step, {sql.r('rmse - lag(rmse) OVER (ORDER BY step)', 'delta')}
FROM (SELECT *, CAST(list_position({_ORDER!r}, model) AS BIGINT) AS step FROM ({_METRICS}))"""))
def ablation(spark, sf):
    return tidy(scoring.ablation(scoring.regression_metrics(_test(spark, sf)), _ORDER))


@query("B12_residual_summary", sql.with_(_SCORED, f"""
SELECT model, count(*) AS n, {sql.r('avg(error)', 'mean')}, {sql.r('stddev_samp(error)', 'std')}, {sql.r('min(error)', 'min')}, {sql.r('max(error)', 'max')},
  {', '.join(sql.r(f'quantile_cont(error, {p / 100})', f'p{p}') for p in (5, 25, 50, 75, 95))} FROM scored GROUP BY model"""))
def residual_summary(spark, sf):
    return tidy(scoring.residual_summary(_test(spark, sf)))


@query("B12_residual_histogram", sql.with_(_SCORED, """
SELECT model, CAST(floor(error / 25.0::DOUBLE) AS BIGINT) AS bin, count(*) AS n FROM scored GROUP BY 1, 2"""))
def residual_histogram(spark, sf):
    return scoring.residual_histogram(_test(spark, sf), 25.0)


@query("B13_interval_coverage", sql.with_(_SCORED + """,
spread AS (SELECT model, 1.96::DOUBLE * stddev_pop(error) AS half FROM all_scored WHERE split = 'train' GROUP BY model)""", f"""
SELECT model, count(*) AS n, {sql.r('avg(CASE WHEN actual BETWEEN prediction - half AND prediction + half THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)', 'coverage')}
FROM scored JOIN spread USING (model) GROUP BY model"""))
def interval_coverage(spark, sf):
    rows = _scored(spark, sf)
    spread = scoring.residual_spread(rows.where("split = 'train'"))
    return tidy(scoring.interval_coverage(scoring.with_interval(rows.where("split = 'test'"), spread)))
