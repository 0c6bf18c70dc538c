"""What-if scenarios: percentage changes of measures, and the change they make to a forecast."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longspan.config import CATEGORY_LABELS
from longspan.functions.columns import col
from longspan.operators.catalogue import hazard_band


def perturb(df: DataFrame, scenarios: dict[str, dict[str, float]]) -> DataFrame:
    """Every row once per scenario, with the named measures changed by their percentage and floored at zero."""
    measures = sorted({m for s in scenarios.values() for m in s})
    options = F.array(*[
        F.struct(F.lit(name).alias("scenario"), *[F.lit(1.0 + s.get(m, 0.0) / 100.0).alias(f"_f_{m}") for m in measures])
        for name, s in scenarios.items()
    ])
    rows = df.select("*", F.inline(options))
    # greatest would turn a missing measure into 0
    changed = {m: F.when(col(m).isNotNull(), F.greatest(col(m) * col(f"_f_{m}"), F.lit(0.0))) for m in measures}
    return rows.withColumns(changed).drop(*[f"_f_{m}" for m in measures])


def linear_forecast(weights: dict[str, float], intercept: float) -> Callable[[DataFrame], DataFrame]:
    """A forecast function: a weighted sum of columns."""
    def forecast(df: DataFrame) -> DataFrame:
        out = F.lit(float(intercept))
        for c, w in weights.items():
            out = out + F.lit(float(w)) * col(c)
        return df.withColumn("prediction", out)

    return forecast


def compare(df: DataFrame, scenarios: dict[str, dict[str, float]], forecast: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Baseline and scenario forecasts side by side. ``forecast`` appends a ``prediction`` column."""
    baseline = forecast(df).withColumnRenamed("prediction", "baseline")
    simulated = forecast(perturb(baseline, scenarios)).withColumnRenamed("prediction", "simulated")
    out = simulated.withColumns({
        "baseline_category": hazard_band(F.col("baseline")), "simulated_category": hazard_band(F.col("simulated")),
        "delta": F.col("simulated") - F.col("baseline"),
    })
    return out.withColumn("category_improved", _severity("simulated") < _severity("baseline"))


def _severity(name: str) -> Column:
    """Place of the value's band; null for a missing value."""
    band = F.array_position(F.array(*[F.lit(c) for c in CATEGORY_LABELS]), hazard_band(F.col(name)))
    return F.when(F.col(name).isNotNull(), band)
