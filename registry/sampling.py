"""Q1-Q12: look-back samples."""

from pyspark.sql import functions as F

from longspan.config import SequenceConfig
from longspan.operators import sequences
from longspan.plans import stages
from longspan.session import scratch_path
from longspan.sources import files
from registry import sql
from registry.core import FEATURES, SPEC, model_ready, prepared, query, tidy

CONTINUOUS, ISOLATED = SequenceConfig(), SequenceConfig(boundary="isolated_partition")
_META = f"entity, {sql.day('input_start', 'input_start')}, {sql.day('input_end', 'input_end')}, {sql.day('target_time', 'target_time')}, split"
_COUNTS = """SELECT split, count(*) AS candidates, count(*) FILTER (WHERE NOT target_observed) AS skipped,
count(*) FILTER (WHERE target_observed) AS kept FROM candidates GROUP BY split"""


def _windows(spark, sf, cfg=CONTINUOUS, tensors=False):
    data, names = model_ready(spark, sf)
    return sequences.candidate_windows(data, SPEC, cfg, names if tensors else None)


def _weighted():
    """Sum of all values, each times its step (from 1) and a weight of its feature."""
    def step(s, i):
        return (i + 1) * F.aggregate(F.transform(s, lambda v, j: (j % 7 + 1) * v.cast("double")), F.lit(0.0), lambda b, v: b + v)
    return F.aggregate(F.transform("x", step), F.lit(0.0), lambda a, v: a + v)


def _checksum(windows, group=()):
    """Collapse each window's array to its sum, a sum weighted by step and feature (which any exchange changes) and corners."""
    total = F.aggregate("x", F.lit(0.0), lambda a, s: a + F.aggregate(s, F.lit(0.0), lambda b, v: b + v))
    return windows.withColumns({
        "x_sum": F.round(total, 2), "x_weighted": F.round(_weighted(), 2), "x_first": F.round(F.col("x")[0][0].cast("double"), 4),
        "x_last": F.round(F.element_at(F.element_at("x", -1), -1).cast("double"), 4), "steps": F.size("x"),
    }).drop("x")


@query("Q1_look_back_windows", sql.with_(sql.windows(), f"""
SELECT entity, {sql.day('input_end', 'input_end')}, {sql.r('x_sum', 'x_sum', 2)}, {sql.r('x_weighted', 'x_weighted', 2)}, {sql.r('x_first', 'x_first', 4)}, {sql.r('x_last', 'x_last', 4)},
  CAST(30 AS BIGINT) AS steps FROM candidates"""))
def look_back_windows(spark, sf):
    return tidy(_checksum(_windows(spark, sf, tensors=True)).select("entity", "input_end", "x_sum", "x_weighted", "x_first", "x_last", "steps"))


@query("Q2_horizon_targets", sql.with_(sql.windows(horizon=3), f"""
SELECT {_META}, {sql.r('y::DOUBLE', 'y', 3)}, {sql.r('y_scaled::DOUBLE', 'y_scaled', 3)}, target_observed FROM candidates"""))
def horizon_targets(spark, sf):
    out = _windows(spark, sf, SequenceConfig(horizon=3))
    return tidy(out.select("entity", "input_start", "input_end", "target_time", "split", "y", "y_scaled", "target_observed"), 3)


@query("Q3_target_split", sql.with_(sql.windows(), "SELECT entity, split, count(*) AS n FROM candidates GROUP BY 1, 2"))
def target_split(spark, sf):
    return _windows(spark, sf).groupBy("entity", "split").agg(F.count("*").alias("n"))


@query("Q4_observed_targets", sql.with_(sql.windows(), f"SELECT {_META} FROM candidates WHERE target_observed"))
def observed_targets(spark, sf):
    return tidy(sequences.keep_observed(_windows(spark, sf), CONTINUOUS).select("entity", "input_start", "input_end", "target_time", "split"))


@query("Q5_window_counts", sql.with_(sql.windows(), _COUNTS))
def window_counts(spark, sf):
    return sequences.window_counts(_windows(spark, sf), CONTINUOUS)


@query("Q6_continuous_history", sql.with_(sql.windows(), f"SELECT {_META}, target_observed, {sql.r('y::DOUBLE', 'y', 3)} FROM candidates"))
def continuous_history(spark, sf):
    return tidy(_windows(spark, sf).select("entity", "input_start", "input_end", "target_time", "split", "target_observed", "y"), 3)


@query("Q7_isolated_partition", sql.with_(sql.windows(isolated=True), f"SELECT {_META}, target_observed, {sql.r('y::DOUBLE', 'y', 3)} FROM candidates"))
def isolated_partition(spark, sf):
    return tidy(_windows(spark, sf, ISOLATED).select("entity", "input_start", "input_end", "target_time", "split", "target_observed", "y"), 3)


@query("Q7_isolated_counts", sql.with_(sql.windows(isolated=True), _COUNTS))
def isolated_counts(spark, sf):
    return sequences.window_counts(_windows(spark, sf, ISOLATED), ISOLATED)


@query("Q8_sample_metadata", sql.with_(sql.windows(), f"""
SELECT {_META}, {sql.r('y::DOUBLE', 'y', 3)}, {sql.r('y_scaled::DOUBLE', 'y_scaled', 3)}, target_observed FROM candidates WHERE target_observed"""))
def sample_metadata(spark, sf):
    out = sequences.keep_observed(_windows(spark, sf), CONTINUOUS)
    return tidy(out.select("entity", "input_start", "input_end", "target_time", "split", "y", "y_scaled", "target_observed"), 3)


@query("Q9_short_series", sql.with_(sql.windows(isolated=True, lookback=200), "SELECT entity, split, count(*) AS n FROM candidates GROUP BY 1, 2"))
def short_series(spark, sf):
    """Splits shorter than look-back plus horizon give no windows."""
    out = _windows(spark, sf, SequenceConfig(lookback=200, boundary="isolated_partition"))
    return out.groupBy("entity", "split").agg(F.count("*").alias("n"))


@query("Q10_integrity", sql.with_(sql.windows(), """
SELECT DISTINCT split, 0::BIGINT AS bad_length, 0::BIGINT AS bad_width, 0::BIGINT AS bad_value, 0::BIGINT AS bad_target, 0::BIGINT AS unobserved_target
FROM candidates WHERE target_observed"""))
def integrity(spark, sf):
    names = model_ready(spark, sf)[1]
    return sequences.integrity(sequences.keep_observed(_windows(spark, sf, tensors=True), CONTINUOUS), CONTINUOUS, len(names))


@query("Q10_planted_damage", sql.with_(sql.windows(), """
SELECT split, count(*) FILTER (WHERE place % 11 = 0) AS bad_length, count(*) FILTER (WHERE place % 13 = 0) AS bad_width,
  count(*) FILTER (WHERE place % 17 = 0) AS bad_value, count(*) FILTER (WHERE place % 19 = 0) AS bad_target,
  count(*) FILTER (WHERE NOT target_observed) AS unobserved_target FROM candidates GROUP BY split"""))
def planted_damage(spark, sf):
    """Windows with a step too few, a feature too few in a step, an infinite value, or no target."""
    names = model_ready(spark, sf)[1]
    at, odd = F.col("_pos"), F.lit(float("inf")).cast("float")
    windows = _windows(spark, sf, tensors=True)
    x = F.when(at % 17 == 0, F.transform("x", lambda s, i: F.when(i == 3, F.transform(s, lambda v, j: F.when(j == 0, odd).otherwise(v))).otherwise(s))).otherwise(F.col("x"))
    windows = windows.withColumn("x", x)
    windows = windows.withColumn("x", F.when(at % 13 == 0, F.transform("x", lambda s, i: F.when(i == 5, F.slice(s, 1, len(names) - 1)).otherwise(s))).otherwise(F.col("x")))
    windows = windows.withColumn("x", F.when(at % 11 == 0, F.slice("x", 1, 29)).otherwise(F.col("x")))
    windows = windows.withColumn("y", F.when(at % 19 != 0, F.col("y")))
    return sequences.integrity(windows, CONTINUOUS, len(names))


@query("Q11_dataset_summary", sql.with_(sql.windows(), """
SELECT split, count(*) AS n_samples, CAST(30 AS BIGINT) AS steps, CAST(82 AS BIGINT) AS width FROM candidates WHERE target_observed GROUP BY split"""))
def dataset_summary(spark, sf):
    names = model_ready(spark, sf)[1]
    return tidy(sequences.dataset_summary(sequences.keep_observed(_windows(spark, sf), CONTINUOUS), CONTINUOUS, names))


@query("Q12_build_samples", sql.with_(sql.windows(), f"""
SELECT split, entity, count(*) AS n, {sql.r('sum(x_sum)', 'x_sum', 2)}, {sql.r('sum(x_weighted)', 'x_weighted', 2)}, {sql.r('sum(y::DOUBLE)', 'y_sum', 2)} FROM candidates WHERE target_observed GROUP BY 1, 2"""))
def build_samples(spark, sf):
    source, out, params = (scratch_path(spark, n) for n in ("prepared", "samples", "params"))
    files.write_by_split(prepared(spark, sf).table, source)
    done = stages.build_samples(spark, source, out, params, SPEC, FEATURES)
    total = F.aggregate("x", F.lit(0.0), lambda a, s: a + F.aggregate(s, F.lit(0.0), lambda b, v: b + v))
    return tidy(done.windows.groupBy("split", "entity").agg(
        F.count("*").alias("n"), F.sum(total).alias("x_sum"), F.sum(_weighted()).alias("x_weighted"),
        F.sum(F.col("y").cast("double")).alias("y_sum")), 2)
