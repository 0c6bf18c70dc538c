"""Filling and scaling."""

from pyspark.sql import functions as F

from longspan.operators import impute, scale
from longspan.plans import stages
from longspan.session import scratch_path
from longspan.sources import files
from longspan.operators.scale import params_table
from registry import sql
from registry.core import NUMERIC, SPEC, filled, panel, prepared, query, tidy
from longspan.operators import split, validate

_KEYS = f"entity, {sql.day('d', 'd')}, split"
_VALUES = ", ".join(sql.r(c, c) for c in NUMERIC)


def _splits(spark, sf):
    return split.assign_split(validate.flag_target(panel(spark, sf), SPEC), SPEC)


@query("I1_forward_fill", sql.with_(sql.FILLED, f"SELECT {_KEYS}, {_VALUES} FROM filled"))
def forward_fill(spark, sf):
    return tidy(impute.forward_fill(_splits(spark, sf), SPEC).select("entity", "d", "split", *NUMERIC))


@query("I2_train_medians", sql.with_(sql.FILLED, sql.union(f"""SELECT '{c}' AS "column", {sql.r(c, 'median')} FROM medians""" for c in NUMERIC)))
def train_medians(spark, sf):
    medians = impute.fit_medians(filled(spark, sf), NUMERIC)
    return tidy(spark.createDataFrame(list(medians.items()), "column string, median double"))


@query("I3_median_fill", sql.with_(sql.IMPUTED, f"SELECT {_KEYS}, {_VALUES} FROM imputed"))
def median_fill(spark, sf):
    f = filled(spark, sf)
    return tidy(impute.fill_constants(f, impute.fit_medians(f, NUMERIC)).select("entity", "d", "split", *NUMERIC))


@query("I4_no_nulls", sql.with_(sql.IMPUTED, sql.union(
    f"""SELECT split, '{c}' AS "column", count(*) - count({c}) AS n_missing FROM imputed GROUP BY split""" for c in NUMERIC)))
def no_nulls(spark, sf):
    table = prepared(spark, sf).table
    impute.require_complete(table, NUMERIC)
    return impute.missing_counts(table, NUMERIC)


@query("I5_fit_scaler", sql.with_(sql.IMPUTED, sql.union(
    f"""SELECT '{c}' AS "column", {sql.r(f'avg({c})', 'mean', 4)}, {sql.r(f'var_pop({c})', 'variance', 2)},
    {sql.r(f'CASE WHEN var_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END', 'scale', 4)} FROM imputed WHERE split = 'train'""" for c in NUMERIC)))
def fit_scaler(spark, sf):
    rows = params_table(spark, prepared(spark, sf).params)
    return rows.select("column", F.round("mean", 4).alias("mean"), F.round("variance", 2).alias("variance"), F.round("scale", 4).alias("scale"))


@query("I6_apply_scaler", sql.with_(sql.SCALED, f"SELECT {_KEYS}, target_valid, {', '.join(sql.r(f'scaled_{c}', f'scaled_{c}') for c in NUMERIC)} FROM scaled"))
def apply_scaler(spark, sf):
    return tidy(prepared(spark, sf).table.select("entity", "d", "split", "target_valid", *[f"scaled_{c}" for c in NUMERIC]))


@query("I7_training_statistics", sql.with_(sql.IMPUTED, sql.union(
    f"""SELECT '{c}' AS "column", {sql.r(f'avg(i.{c})', 'mean', 4)}, {sql.r(f'var_pop(i.{c})', 'variance', 2)},
    {sql.r(f'CASE WHEN var_pop(i.{c}) > 0 THEN stddev_pop(i.{c}) ELSE 1 END', 'scale', 4)}, {sql.r(f'max(m.{c})', 'median', 4)},
    {sql.r(f'min(i.{c})', 'min', 4)}, {sql.r(f'max(i.{c})', 'max', 4)} FROM imputed i CROSS JOIN medians m WHERE split = 'train'""" for c in NUMERIC)))
def training_statistics(spark, sf):
    rows = params_table(spark, prepared(spark, sf).params)
    return rows.select("column", F.round("variance", 2).alias("variance"),
                       *[F.round(c, 4).alias(c) for c in ("mean", "scale", "median", "min", "max")])


@query("I8_validity_by_split", sql.with_(sql.FILLED, f"""
SELECT split, count(*) FILTER (WHERE target_valid) AS n_observed, count(*) FILTER (WHERE NOT target_valid) AS n_missing,
       {sql.r('100.0::DOUBLE * count(*) FILTER (WHERE target_valid) / count(*)', 'pct_observed')} FROM filled GROUP BY split"""))
def validity_by_split(spark, sf):
    return tidy(impute.validity_by_split(prepared(spark, sf).table, SPEC))


@query("I9_missing_before_after", sql.with_(sql.IMPUTED, sql.union(
    [f"""SELECT 'before' AS stage, split, '{c}' AS "column", count(*) - count({c}) AS n_missing FROM splits GROUP BY split""" for c in NUMERIC]
    + [f"SELECT 'after', split, '{c}', count(*) - count({c}) FROM imputed GROUP BY split" for c in NUMERIC])))
def missing_before_after(spark, sf):
    before = impute.missing_counts(_splits(spark, sf), NUMERIC).select(F.lit("before").alias("stage"), "*")
    after = impute.missing_counts(prepared(spark, sf).table, NUMERIC).select(F.lit("after").alias("stage"), "*")
    return before.unionByName(after)


@query("I10_preprocess", sql.with_(sql.SCALED, f"""
SELECT split, entity, count(*) AS n, count(*) FILTER (WHERE target_valid) AS n_observed, {', '.join(sql.r(f'sum(scaled_{c})', f's_{c}', 4) for c in NUMERIC)}
FROM scaled GROUP BY 1, 2"""))
def preprocess(spark, sf):
    source, out, params = (scratch_path(spark, n) for n in ("cleaned", "prepared", "params"))
    files.write_panel(panel(spark, sf), source)
    done = stages.preprocess(spark, source, out, params, SPEC)
    return tidy(done.table.groupBy("split", "entity").agg(
        F.count("*").alias("n"), F.count_if("target_valid").alias("n_observed"), *[F.sum(f"scaled_{c}").alias(f"s_{c}") for c in NUMERIC]), 4)


def _neighbours(c: str) -> str:
    w = "OVER (PARTITION BY entity, split ORDER BY d ROWS BETWEEN"
    return (f"last_value(CASE WHEN {c} IS NOT NULL THEN pos END IGNORE NULLS) {w} UNBOUNDED PRECEDING AND CURRENT ROW) AS p0_{c}, "
            f"last_value({c} IGNORE NULLS) {w} UNBOUNDED PRECEDING AND CURRENT ROW) AS v0_{c}, "
            f"first_value(CASE WHEN {c} IS NOT NULL THEN pos END IGNORE NULLS) {w} CURRENT ROW AND UNBOUNDED FOLLOWING) AS p1_{c}, "
            f"first_value({c} IGNORE NULLS) {w} CURRENT ROW AND UNBOUNDED FOLLOWING) AS v1_{c}")


def _interpolated(c: str) -> str:
    return (f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN p1_{c} - p0_{c} - 1 <= 5 "
            f"THEN v0_{c} + (v1_{c} - v0_{c}) * ((pos - p0_{c})::DOUBLE / (p1_{c} - p0_{c})) ELSE coalesce(v0_{c}, v1_{c}) END")


@query("B20_interpolation", sql.with_(sql.SPLIT + f", near AS (SELECT *, {', '.join(_neighbours(c) for c in NUMERIC)} FROM splits)",
       f"SELECT {_KEYS}, {', '.join(sql.r(_interpolated(c), c) for c in NUMERIC)} FROM near"))
def interpolation(spark, sf):
    return tidy(impute.interpolate(_splits(spark, sf), SPEC, NUMERIC).select("entity", "d", "split", *NUMERIC))


_MASK = "((d - DATE '1970-01-01') % 10 = 3)"


@query("B21_masked_audit", sql.with_(sql.SPLIT + f""",
hidden AS (SELECT * REPLACE ({', '.join(f'CASE WHEN NOT {_MASK} THEN {c} END AS {c}' for c in NUMERIC)}), {', '.join(f'CASE WHEN {_MASK} THEN {c} END AS t_{c}' for c in NUMERIC)} FROM splits),
refilled AS MATERIALIZED (SELECT split, {', '.join(f't_{c}, {sql.ffill(c)} AS {c}' for c in NUMERIC)} FROM hidden),
remed AS (SELECT {', '.join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in NUMERIC)} FROM refilled WHERE split = 'train')""",
    sql.union(f"""SELECT '{c}' AS "column", count(*) AS n_masked, {sql.r(f'sqrt(avg(pow(coalesce({c}, m_{c}) - t_{c}, 2)))', 'rmse', 4)},
    {sql.r(f'avg(abs(coalesce({c}, m_{c}) - t_{c}))', 'mae', 4)} FROM refilled CROSS JOIN remed WHERE t_{c} IS NOT NULL""" for c in NUMERIC)))
def masked_audit(spark, sf):
    def fill(df):
        f = impute.forward_fill(df, SPEC)
        return impute.fill_constants(f, impute.fit_medians(f, NUMERIC))

    mask = F.unix_date("d") % 10 == 3
    return tidy(impute.masked_audit(_splits(spark, sf), SPEC, NUMERIC, mask, fill), 4)


def _digits(c: str, at: int) -> str:
    return f"CAST('0x' || substr(md5(entity || '|' || CAST(d AS VARCHAR) || '|{c}'), {at}, 4) AS BIGINT)"


_W = "OVER (PARTITION BY entity, split ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_REFILLED = sql.SPLIT + f""",
near AS MATERIALIZED (SELECT *, {', '.join(_neighbours(c) for c in NUMERIC)} FROM splits),
gaps AS (""" + sql.union(f"""SELECT '{c}' AS col, p1_{c} - p0_{c} - 1 AS len, count(*) AS n FROM near
  WHERE {c} IS NULL AND pos = p0_{c} + 1 AND p1_{c} IS NOT NULL GROUP BY 2""" for c in NUMERIC) + f"""),
shares AS (SELECT col, len, sum(n) OVER (PARTITION BY col ORDER BY len) AS upto, sum(n) OVER (PARTITION BY col) AS total FROM gaps),
draws AS (SELECT c.col, k, coalesce(min(len), 1) AS len FROM (SELECT unnest({NUMERIC}) AS col) c CROSS JOIN range(100) AS r(k)
          LEFT JOIN shares s ON s.col = c.col AND upto * 100 > k * total GROUP BY 1, 2),
lists AS MATERIALIZED (SELECT col, list(len ORDER BY k) AS lens, CAST(sum(len) AS BIGINT) AS total FROM draws GROUP BY 1),
started AS (SELECT *, {', '.join(f"""CASE WHEN {_digits(c, 1)} * (SELECT total FROM lists WHERE col = '{c}') < 655360
  THEN (SELECT lens FROM lists WHERE col = '{c}')[{_digits(c, 5)} % 100 + 1] END AS st_{c}""" for c in NUMERIC)} FROM splits),
ran AS MATERIALIZED (SELECT *, {', '.join(f"coalesce(last_value(pos + st_{c} IGNORE NULLS) {_W} > pos, false) AS hid_{c}, last_value(st_{c} IGNORE NULLS) {_W} AS len_{c}" for c in NUMERIC)} FROM started),
hidden AS (SELECT * REPLACE ({', '.join(f'CASE WHEN NOT hid_{c} THEN {c} END AS {c}' for c in NUMERIC)}), {', '.join(f'CASE WHEN hid_{c} THEN {c} END AS t_{c}' for c in NUMERIC)} FROM ran),
refilled AS MATERIALIZED (SELECT split, {', '.join(f't_{c}, len_{c}, {sql.ffill(c)} AS {c}' for c in NUMERIC)} FROM hidden),
remed AS (SELECT {', '.join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in NUMERIC)} FROM refilled WHERE split = 'train')"""


@query("B21_gap_audit", sql.with_(_REFILLED, sql.union(
    f"""SELECT '{c}' AS "column", CAST(len_{c} AS BIGINT) AS gap_length, count(*) AS n_masked, {sql.r(f'sqrt(avg(pow(coalesce({c}, m_{c}) - t_{c}, 2)))', 'rmse', 4)},
    {sql.r(f'avg(abs(coalesce({c}, m_{c}) - t_{c}))', 'mae', 4)} FROM refilled CROSS JOIN remed WHERE t_{c} IS NOT NULL GROUP BY len_{c}""" for c in NUMERIC)))
def gap_audit(spark, sf):
    """Cells hidden in runs as long as the column's own gaps; the error of each gap length."""
    def fill(df):
        f = impute.forward_fill(df, SPEC)
        return impute.fill_constants(f, impute.fit_medians(f, NUMERIC))

    return tidy(impute.gap_audit(_splits(spark, sf), SPEC, NUMERIC, fill), 4)


@query("B22_robust_minmax", sql.with_(sql.IMPUTED + f""",
fit AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS q_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS i_{c}, min({c}) AS lo_{c}, max({c}) - min({c}) AS w_{c}' for c in NUMERIC)}
        FROM imputed WHERE split = 'train')""",
    f"""SELECT {_KEYS}, {', '.join(sql.r(f'({c} - q_{c}) / CASE WHEN i_{c} = 0 THEN 1 ELSE i_{c} END', f'robust_{c}') + ', ' + sql.r(f'({c} - lo_{c}) / CASE WHEN w_{c} = 0 THEN 1 ELSE w_{c} END', f'minmax_{c}') for c in NUMERIC)}
    FROM imputed CROSS JOIN fit"""))
def robust_minmax(spark, sf):
    t = prepared(spark, sf).table
    train = t.where("split = 'train'")
    out = scale.apply_shift_scale(t, scale.fit_robust(train, NUMERIC), "robust_")
    out = scale.apply_shift_scale(out, scale.fit_minmax(train, NUMERIC), "minmax_")
    return tidy(out.select("entity", "d", "split", *[f"{p}_{c}" for c in NUMERIC for p in ("robust", "minmax")]))
