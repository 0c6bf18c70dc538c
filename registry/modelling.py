"""Scenarios, tabular samples, tree baseline, folds and permutation importance."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from longspan.operators import baseline, scenario, sequences
from longspan.session import pin
from registry import sql
from registry.core import SPEC, model_ready, once, prepared, query, tidy
from registry.sampling import CONTINUOUS

SCENARIOS = {
    "traffic": {"qty_a": -20.0, "price_a": -20.0, "qty_n": -15.0},
    "industry": {"qty_a": -30.0, "disc_a": -10.0},
    "growth": {"qty_a": 25.0, "qty_r": 50.0},
}
_CHANGED = sorted({m for s in SCENARIOS.values() for m in s})


def _scenario_rows(source: str) -> str:
    return sql.union(
        "SELECT * REPLACE (" + ", ".join(f"greatest({m} * {1 + s.get(m, 0.0) / 100!r}::DOUBLE, 0.0::DOUBLE) AS {m}" for m in _CHANGED)
        + f"), '{name}' AS scenario FROM {source}" for name, s in SCENARIOS.items())


@query("B19_scenario_inputs", sql.with_(sql.IMPUTED + f", altered AS ({_scenario_rows('imputed')})", f"""
SELECT entity, {sql.day('d', 'd')}, scenario, {', '.join(sql.r(m, m) for m in _CHANGED)} FROM altered"""))
def scenario_inputs(spark, sf):
    return tidy(scenario.perturb(prepared(spark, sf).table, SCENARIOS).select("entity", "d", "scenario", *_CHANGED))


_LINE = f"(SELECT regr_slope(target, qty_a) FROM imputed WHERE split = 'train') * qty_a + (SELECT regr_intercept(target, qty_a) FROM imputed WHERE split = 'train')"


@query("B19_scenario_forecast", sql.with_(sql.IMPUTED + f""",
based AS (SELECT *, {_LINE} AS baseline FROM imputed),
altered AS ({_scenario_rows('based')}),
compared AS (SELECT entity, d, scenario, baseline, {_LINE} AS simulated FROM altered)""", f"""
SELECT entity, {sql.day('d', 'd')}, scenario, {sql.r('baseline', 'baseline', 4)}, {sql.r('simulated', 'simulated', 4)}, {sql.r('simulated - baseline', 'delta', 4)},
  {sql.band('baseline')} AS baseline_category, {sql.band('simulated')} AS simulated_category,
  list_position(['Good','Satisfactory','Moderate','Poor','Very Poor','Severe'], {sql.band('simulated')}) < list_position(['Good','Satisfactory','Moderate','Poor','Very Poor','Severe'], {sql.band('baseline')}) AS category_improved
FROM compared"""))
def scenario_forecast(spark, sf):
    t = prepared(spark, sf).table
    line = t.where("split = 'train'").agg(F.regr_slope("target", "qty_a").alias("a"), F.regr_intercept("target", "qty_a").alias("b")).first()
    out = scenario.compare(t, SCENARIOS, scenario.linear_forecast({"qty_a": line["a"]}, line["b"]))
    return tidy(out.select("entity", "d", "scenario", "baseline", "simulated", "delta", "baseline_category", "simulated_category", "category_improved"), 4)


_SUMMARY_OF = ["scaled_qty_a", "scaled_price_a", "scaled_qty_n", "scaled_target"]


def _samples(spark, sf):
    """Look-back samples with their summary, as stored."""
    def build():
        data, names = model_ready(spark, sf)
        return pin(sequences.keep_observed(sequences.candidate_windows(data, SPEC, CONTINUOUS, names, _SUMMARY_OF), CONTINUOUS))
    return once(spark, sf, "samples", build)


def _flat(spark, sf):
    return sequences.flatten_samples(_samples(spark, sf))


def _tail(c: str, span: int) -> list[str]:
    w = f"OVER (PARTITION BY entity ORDER BY d ROWS BETWEEN {span - 1} PRECEDING AND CURRENT ROW)"
    v = f"CAST({c} AS FLOAT)::DOUBLE"
    return [f"avg({v}) {w} AS {c}_mean_{span}", f"coalesce(stddev_samp({v}) {w}, 0.0) AS {c}_std_{span}",
            f"min({v}) {w} AS {c}_min_{span}", f"max({v}) {w} AS {c}_max_{span}"]


_SUMMARIES = [f"{c}_{m}_{n}" for c in _SUMMARY_OF for n in (7, 14) for m in ("mean", "std", "min", "max")]


@query("B24_tabular_samples", sql.with_(sql.windows() + f""",
tails AS (SELECT entity, d, {', '.join(e for c in _SUMMARY_OF for n in (7, 14) for e in _tail(c, n))} FROM model)""", f"""
SELECT c.entity, {sql.day('input_end', 'input_end')}, split, CAST(30 * 82 + 32 AS BIGINT) AS width, {sql.r('x_first', 'first_value', 4)},
  {sql.r('x_last', 'last_value', 4)}, {sql.r('x_sum', 'x_sum', 2)}, {sql.r('x_weighted', 'x_weighted', 2)}, {', '.join(sql.r(n, n, 4) for n in _SUMMARIES)}
FROM candidates c JOIN tails t ON t.entity = c.entity AND t.d = c.input_end WHERE target_observed"""))
def tabular_samples(spark, sf):
    flat = F.col("flat")
    steps = F.slice(flat, 1, 30 * 82)
    weighted = F.aggregate(F.transform(steps, lambda v, i: (F.floor(i / 82) + 1) * (i % 82 % 7 + 1) * v), F.lit(0.0), lambda a, v: a + v)
    sums = [F.round(F.aggregate(steps, F.lit(0.0), lambda a, v: a + v), 2).alias("x_sum"), F.round(weighted, 2).alias("x_weighted")]
    extras = [flat[30 * 82 + i].alias(n) for i, n in enumerate(_SUMMARIES)]
    return tidy(_flat(spark, sf).select("entity", "input_end", "split", F.size(flat).alias("width"), flat[0].alias("first_value"),
                                        flat[30 * 82 - 1].alias("last_value"), *sums, *extras), 4)


def _trees(spark, sf):
    """The samples as stored, and the tree baseline fitted on all their steps and features."""
    def build():
        samples = _flat(spark, sf)
        return samples, baseline.fit_boosted_trees(samples)
    return once(spark, sf, "trees", build)


@query("B25_boosted_trees", sql.with_(sql.windows() + """,
rivals AS (SELECT split, sqrt(avg(pow(y::DOUBLE - (SELECT quantile_cont(y::DOUBLE, 0.5) FROM candidates WHERE target_observed AND split = 'train'), 2))) AS rmse
  FROM candidates WHERE target_observed GROUP BY split)""", f"""
SELECT entity, {sql.day('target_time', 'target_time')}, split, {sql.r('y::DOUBLE', 'y', 3)}, true AS predicted, {sql.r('rmse', 'median_rmse', 3)},
  true AS fits_better FROM candidates JOIN rivals USING (split) WHERE target_observed AND split <> 'train'"""))
def boosted_trees(spark, sf):
    """Every validation and test sample with its forecast's presence and the error of the training median's forecast. On the
    training samples the trees must come closer than that median; later targets are random here, so nothing beats it there."""
    samples, model = _trees(spark, sf)
    y, train = F.col("y").cast("double"), F.col("split") == "train"
    typical = samples.where(train).agg(F.percentile(y, 0.5)).first()[0]
    scored = baseline.predict(model, samples).withColumn("y", y)
    whole = Window.partitionBy("split")
    rival = F.sqrt(F.avg(F.pow(F.lit(typical) - F.col("y"), 2)).over(whole))
    errors = scored.where(train).agg(F.avg(F.pow(F.col("prediction") - F.col("y"), 2)).alias("own"), F.avg(F.pow(F.lit(typical) - F.col("y"), 2)).alias("rival"))
    better = errors.select((F.col("own") < F.col("rival")).alias("fits_better"))  # one row
    predicted = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    rows = scored.where(~train).withColumn("median_rmse", rival).crossJoin(better)
    return tidy(rows.select("entity", "target_time", "split", "y", predicted.alias("predicted"), "median_rmse", "fits_better"), 3)


@query("B26_expanding_folds", sql.with_(sql.SPLIT + """,
parts AS (SELECT entity, d, CAST(floor((pos - 1) * 6 / n::DOUBLE) AS BIGINT) AS part FROM splits)""", """
SELECT entity, CAST(d AS VARCHAR) AS d, fold, CASE WHEN part < fold THEN 'train' ELSE 'validate' END AS role
FROM parts JOIN (SELECT unnest(range(1, 6)) AS fold) ON part <= fold"""))
def expanding_folds(spark, sf):
    return tidy(baseline.expanding_folds(prepared(spark, sf).table, SPEC).select("entity", "d", "fold", "role"))


@query("B26_fold_scores", sql.with_(sql.IMPUTED + """,
parts AS (SELECT entity, d, qty_a, target, CAST(floor((pos - 1) * 6 / n::DOUBLE) AS BIGINT) AS part FROM imputed WHERE target_valid),
uses AS (SELECT *, part < fold AS train FROM parts JOIN (SELECT unnest(range(1, 6)) AS fold) ON part <= fold),
line AS (SELECT fold, count(*) AS n_train, regr_slope(target, qty_a) AS a, regr_intercept(target, qty_a) AS b FROM uses WHERE train GROUP BY fold)""", f"""
SELECT fold, any_value(n_train) AS n_train, count(*) AS n_validate, {sql.r('sqrt(avg(pow(a * qty_a + b - target, 2)))', 'rmse', 4)},
  {sql.r('avg(abs(a * qty_a + b - target))', 'mae', 4)} FROM uses JOIN line USING (fold) WHERE NOT train GROUP BY fold"""))
def fold_scores(spark, sf):
    """A line fitted on each fold's training rows and scored on its validation rows."""
    rows = baseline.expanding_folds(prepared(spark, sf).table, SPEC).where("target_valid")

    def fit(train):
        line = train.agg(F.regr_slope("target", "qty_a").alias("a"), F.regr_intercept("target", "qty_a").alias("b")).first()
        return scenario.linear_forecast({"qty_a": line["a"]}, line["b"])

    return tidy(baseline.fold_scores(rows, "target", fit), 4)


_STEP_FEATURE, _STEP_AT, _LOW, _HIGH = "season_sin", 0.5, 40.0, 160.0


@query("B25_learned_steps", sql.with_(sql.windows(), f"""
SELECT c.entity, {sql.day('target_time', 'target_time')}, c.split, CASE WHEN CAST(m.{_STEP_FEATURE} AS FLOAT) > {_STEP_AT} THEN {_HIGH}::DOUBLE ELSE {_LOW}::DOUBLE END AS forecast
FROM candidates c JOIN model m ON m.entity = c.entity AND m.d = c.input_end WHERE target_observed AND c.split <> 'train'"""))
def learned_steps(spark, sf):
    """Forecasts of the trees on a target that one feature of the last step decides, compared by value."""
    samples, names = _flat(spark, sf), model_ready(spark, sf)[1]
    decides = F.get("flat", F.lit(29 * len(names) + names.index(_STEP_FEATURE))) > _STEP_AT
    label = F.when(decides, _HIGH).otherwise(_LOW)
    model = baseline.fit_boosted_trees(samples, rounds=40, depth=2, step=0.5, label=label)
    return tidy(baseline.predict(model, samples.where("split <> 'train'")).select("entity", "target_time", "split", F.col("prediction").alias("forecast")), 2)


@query("B26_tree_fold_scores")
def tree_fold_scores(spark, sf):
    """Trees fitted on each fold's training samples, scored on its validation samples; folds are of a sample's target time."""
    samples = _flat(spark, sf)
    held = baseline.expanding_folds(samples.withColumn("_rows", F.max("_pos").over(Window.partitionBy("entity"))), SPEC)

    def fit(train):
        last = F.col("_pos") * 10 > F.max(F.col("_pos")).over(Window.partitionBy("entity")) * 9  # a tenth watches the others
        model = baseline.fit_boosted_trees(train.withColumn("split", F.when(last, "val").otherwise("train")), rounds=20, depth=3, step=0.1, patience=5, first_rounds=10)
        return lambda rows: baseline.predict(model, rows)

    return baseline.fold_scores(held.select("fold", "role", "entity", "_pos", "y", "flat"), "y", fit)


_WEIGHTS = {"qty_n": 2.0, "price_a": 0.001, "disc_a": -40.0, "tax_r": 0.0}
_GROUP_ROWS = 500
_LINEAR = " + ".join(f"{w!r}::DOUBLE * {c}" for c, w in _WEIGHTS.items())


def _shuffled(c: str) -> str:
    order = f"md5(entity || '|' || CAST(d AS VARCHAR) || '|' || '{c}')"
    group = f"CAST('0x' || substr({order}, 1, 8) AS BIGINT) % (SELECT CAST(ceil(count(*) / {_GROUP_ROWS}.0) AS BIGINT) FROM rows)"
    w = "PARTITION BY g ORDER BY m, entity, d"
    return f"""SELECT '{c}' AS "column", sqrt(avg(pow({_LINEAR} - target, 2))) AS rmse FROM (SELECT * REPLACE (coalesce(lead({c}) OVER ({w}),
      first_value({c}) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS {c}) FROM (SELECT *, {order} AS m, {group} AS g FROM rows))"""


@query("B27_permutation_importance", sql.with_(sql.IMPUTED + ", rows AS MATERIALIZED (SELECT * FROM imputed WHERE split = 'test' AND target_valid)", f"""
SELECT "column", {sql.r('rmse', 'rmse', 3)}, {sql.r(f'rmse - (SELECT sqrt(avg(pow({_LINEAR} - target, 2))) FROM rows)', 'increase', 3)} FROM (
{sql.union(_shuffled(c) for c in _WEIGHTS)})"""))
def permutation_importance(spark, sf):
    """Of a line's inputs on the observed test rows, groups of about 500 rows."""
    rows = prepared(spark, sf).table.where("split = 'test' AND target_valid")
    forecast = scenario.linear_forecast(_WEIGHTS, 0.0)
    inputs = {c: [c] for c in _WEIGHTS}
    return tidy(baseline.permutation_importance(rows, ["entity", "d"], inputs, forecast, "target", _GROUP_ROWS), 3)


def _weight(i: int) -> float:
    """Of feature i in the line forecast: every third feature has none."""
    return 0.0 if i % 3 == 2 else (i % 7 + 1) * (0.02 if i % 2 else -0.01)


_LINE_WEIGHTS = [_weight(i) for i in range(len(sql.MODEL))]
_DONOR_GROUP = 64


def _line(df):
    """A fixed line on every step of a window, later steps weighing more, and on its summary."""
    weights = F.array(*[F.lit(w) for w in _LINE_WEIGHTS])
    step = F.transform("x", lambda s, i: (i + 1) * F.aggregate(F.zip_with(s, weights, lambda v, w: v.cast("double") * w), F.lit(0.0), lambda a, v: a + v))
    extra = F.aggregate("summary", F.lit(0.0), lambda a, v: a + v)
    return df.withColumn("prediction", F.aggregate(step, F.lit(0.0), lambda a, v: a + v) + 0.5 * extra)


def _own_share(i: int, c: str) -> str:
    """What feature i adds to the line forecast of a window."""
    v = f"CAST({c} AS FLOAT)::DOUBLE"
    w = "OVER (PARTITION BY entity ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"
    steps = f"{_LINE_WEIGHTS[i]!r}::DOUBLE * (sum({v} * pos) {w} - (pos - 30) * sum({v}) {w})"
    if c not in _SUMMARY_OF:
        return steps
    return steps + " + 0.5 * (" + " + ".join(e.split(" AS ")[0] if " AS FLOAT" not in e else e.rsplit(" AS ", 1)[0] for n in (7, 14) for e in _tail(c, n)) + ")"


@query("B27_importance_by_feature", sql.with_(sql.windows() + f""",
shares AS (SELECT entity, d, {', '.join(f'{_own_share(i, c)} AS s{i}' for i, c in enumerate(sql.MODEL))} FROM model),
tested AS (SELECT c.entity, c.input_end, c.y::DOUBLE AS y, {', '.join(f's{i}' for i in range(len(sql.MODEL)))},
  md5(c.entity || '|' || CAST(CAST(c.input_end AS DATE) AS VARCHAR)) AS m
  FROM candidates c JOIN shares s ON s.entity = c.entity AND s.d = c.input_end WHERE target_observed AND c.split = 'test'),
grouped AS (SELECT *, CAST('0x' || substr(m, 1, 8) AS BIGINT) % (SELECT CAST(ceil(count(*) / {_DONOR_GROUP}.0) AS BIGINT) FROM tested) AS g FROM tested),
given AS (SELECT y, {' + '.join(f's{i}' for i in range(len(sql.MODEL)))} AS p, {', '.join(
    f'coalesce(lead(s{i}) OVER w, first_value(s{i}) OVER v) - s{i} AS c{i}' for i in range(len(sql.MODEL)))} FROM grouped
  WINDOW w AS (PARTITION BY g ORDER BY m, entity, input_end), v AS (PARTITION BY g ORDER BY m, entity, input_end ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
base AS (SELECT sqrt(avg(pow(p - y, 2))) AS b FROM given)""", sql.union(
    f"""SELECT '{c}' AS feature, {sql.r(f'sqrt(avg(pow(p + c{i} - y, 2)))', 'rmse', 3)}, {sql.r(f'sqrt(avg(pow(p + c{i} - y, 2))) - max(b)', 'increase', 3)} FROM given, base"""
    for i, c in enumerate(sql.MODEL))))
def importance_by_feature(spark, sf):
    """All features of the test windows under a line forecast, one donor window for each window."""
    samples, names = _samples(spark, sf), model_ready(spark, sf)[1]
    found = baseline.window_importance(samples.where("split = 'test'"), ["entity", "input_end"], names, _line, "y", summary_of=_SUMMARY_OF, group_rows=_DONOR_GROUP)
    return tidy(found, 3)


@query("B27_tree_importance_by_feature")
def tree_importance_by_feature(spark, sf):
    """Every feature of the tree baseline on the test windows; features that no tree splits on add exactly nothing."""
    samples, (_, model) = _samples(spark, sf), _trees(spark, sf)
    names = model_ready(spark, sf)[1]
    used = baseline.used_features(model, names, 30, _SUMMARY_OF, len(_SUMMARIES) // len(_SUMMARY_OF))

    def forecast(df):
        return baseline.predict(model, sequences.flatten_samples(df))

    return baseline.window_importance(samples.where("split = 'test'"), ["entity", "input_end"], names, forecast, "y", used, _SUMMARY_OF)
