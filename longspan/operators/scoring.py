"""Scoring of forecasts held as (entity, time, model, prediction) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longspan.config import CATEGORY_LABELS, PanelSpec
from longspan.functions.columns import col
from longspan.functions.quantiles import grouped_quantiles
from longspan.operators.catalogue import hazard_band
from longspan.operators.ordering import block_window, core_rows, with_blocks

def forecast_error() -> Column:
    return F.col("prediction") - F.col("actual")


def naive_forecasts(df: DataFrame, spec: PanelSpec, train_median: float, span: int = 7) -> DataFrame:
    """Reference forecasts from an imputed panel: last value, mean of the last ``span`` rows, training median."""
    rows = with_blocks(df, spec, back=span)
    w = block_window(spec)
    y = col(spec.target)
    rows = core_rows(rows.withColumns({
        "_last": F.lag(y, 1).over(w), "_mean": F.avg(y).over(w.rowsBetween(-span, -1)),
    }))
    models = F.array(
        F.struct(F.lit("persistence").alias("model"), F.col("_last").alias("prediction")),
        F.struct(F.lit(f"mean_{span}").alias("model"), F.col("_mean").alias("prediction")),
        F.struct(F.lit("train_median").alias("model"), F.lit(train_median).alias("prediction")),
    )
    return rows.select(col(spec.entity), col(spec.time), "split", F.inline(models)).where(F.col("prediction").isNotNull())


def forecast_vs_actual(predictions: DataFrame, panel: DataFrame, spec: PanelSpec) -> DataFrame:
    """Predictions next to observed targets, with error and category agreement."""
    actuals = panel.where(col(spec.target).isNotNull()).select(
        col(spec.entity), col(spec.time), col(spec.target).alias("actual")
    )
    joined = predictions.join(actuals, [spec.entity, spec.time])
    return joined.withColumns({
        "error": forecast_error(),
        "predicted_category": hazard_band(F.col("prediction")),
        "actual_category": hazard_band(F.col("actual")),
    }).withColumn("category_match", F.col("predicted_category") == F.col("actual_category"))


def huber(error: Column, delta: float = 1.0) -> Column:
    size = F.abs(error)
    return F.when(size <= delta, 0.5 * error * error).otherwise(delta * (size - 0.5 * delta))


def regression_metrics(scored: DataFrame) -> DataFrame:
    """RMSE, MAE, R2 and MAPE (percent, zero actuals skipped) per model."""
    total = F.var_pop("actual") * F.count("*")
    return scored.groupBy("model").agg(
        F.count("*").alias("n"), F.sqrt(F.avg(forecast_error() * forecast_error())).alias("rmse"), F.avg(F.abs(forecast_error())).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.sum(forecast_error() * forecast_error()), total)).alias("r2"),
        (F.avg(F.abs(F.try_divide(forecast_error(), F.col("actual")))) * 100.0).alias("mape"),
    )


def huber_loss(scored: DataFrame, delta: float = 1.0) -> DataFrame:
    return scored.groupBy("model").agg(F.avg(huber(forecast_error(), delta)).alias("huber"))


def confusion(scored: DataFrame) -> DataFrame:
    return scored.groupBy("model", "actual_category", "predicted_category").agg(F.count("*").alias("n"))


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """One row per (model, actual category), one count column per predicted category."""
    counts = scored.groupBy("model", "actual_category").pivot("predicted_category", list(CATEGORY_LABELS)).agg(F.count(F.lit(1)))
    names = {c: "as_" + c.lower().replace(" ", "_") for c in CATEGORY_LABELS}
    return counts.select("model", "actual_category", *[F.coalesce(col(c), F.lit(0)).alias(n) for c, n in names.items()])


def class_metrics(scored: DataFrame) -> DataFrame:
    """Precision, recall and F1 of every category that occurs as actual or predicted; 0 where undefined."""
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("actual_category") == F.col("predicted_category"), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("actual_category").alias("category"), F.col("n").alias("_a"), zero.alias("_p"), hit.alias("_h")),
        F.struct(F.col("predicted_category").alias("category"), zero.alias("_a"), F.col("n").alias("_p"), zero.alias("_h")),
    )
    per_class = confusion(scored).select("model", F.inline(sides)).groupBy("model", "category").agg(
        F.sum("_a").alias("n_actual"), F.sum("_p").alias("n_predicted"), F.sum("_h").alias("_tp")
    )
    precision = F.coalesce(F.try_divide(F.col("_tp"), F.col("n_predicted")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("_tp"), F.col("n_actual")), F.lit(0.0))
    scored_classes = per_class.withColumns({"precision": precision, "recall": recall})
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return scored_classes.withColumn("f1", f1)


def category_metrics(scored: DataFrame) -> DataFrame:
    """Accuracy, macro precision, recall and F1, and recall of the worst category, per model."""
    worst = F.max(F.when((F.col("category") == CATEGORY_LABELS[-1]) & (F.col("n_actual") > 0), F.col("recall")))
    return class_metrics(scored).groupBy("model").agg(
        (F.sum("_tp") / F.sum("n_actual")).alias("accuracy"), F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"), F.avg("f1").alias("macro_f1"), worst.alias("severe_recall"),
    )


def model_ranking(metrics: DataFrame, by: str = "rmse") -> DataFrame:
    """Models ordered by a metric, with the change against the model ranked just before. One row per model."""
    w = Window.partitionBy(F.lit(0)).orderBy(by, "model")
    return metrics.select("model", by, F.row_number().over(w).alias("rank"), (F.col(by) - F.lag(by, 1).over(w)).alias("delta"))


def ablation(metrics: DataFrame, variants: list[str], by: str = "rmse") -> DataFrame:
    """Metric change of each variant against the variant before it in the given order."""
    step = F.array_position(F.array(*[F.lit(v) for v in variants]), F.col("model"))
    w = Window.partitionBy(F.lit(0)).orderBy("step")
    return metrics.where(F.col("model").isin(*variants)).select("model", by, step.alias("step")).withColumn(
        "delta", F.col(by) - F.lag(by, 1).over(w)
    )


def residual_summary(scored: DataFrame) -> DataFrame:
    rows = scored.withColumn("residual", forecast_error())
    base = rows.groupBy("model").agg(
        F.count("residual").alias("n"), F.avg("residual").alias("mean"), F.stddev_samp("residual").alias("std"),
        F.min("residual").alias("min"), F.max("residual").alias("max"),
    )
    found = grouped_quantiles(rows, ["model"], "residual", [0.05, 0.25, 0.5, 0.75, 0.95]).drop("n").withColumnRenamed("model", "_model")
    return base.join(found, F.col("model").eqNullSafe(F.col("_model")), "left").drop("_model")


def residual_histogram(scored: DataFrame, width: float) -> DataFrame:
    """Counts of residuals in bins of a fixed width, bin 0 starting at 0."""
    return scored.groupBy("model", F.floor(forecast_error() / F.lit(width)).alias("bin")).agg(F.count("*").alias("n"))


def residual_spread(scored: DataFrame) -> DataFrame:
    """``model, spread``: population standard deviation of the error, for symmetric intervals."""
    return scored.groupBy("model").agg(F.stddev_pop(forecast_error()).alias("spread"))


def with_interval(predictions: DataFrame, spread: DataFrame, z: float = 1.96) -> DataFrame:
    """Interval of each prediction; without a spread for its model the ends are null."""
    half, other = z * F.col("spread"), spread.withColumnRenamed("model", "_model")
    joined = predictions.join(other, F.col("model").eqNullSafe(F.col("_model")), "left")
    return joined.withColumns({"lower": F.col("prediction") - half, "upper": F.col("prediction") + half}).drop("_model", "spread")


def interval_coverage(scored: DataFrame) -> DataFrame:
    inside = F.col("actual").between(F.col("lower"), F.col("upper"))
    return scored.groupBy("model").agg(F.count("*").alias("n"), F.avg(inside.cast("int")).alias("coverage"))
