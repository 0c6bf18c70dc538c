"""Fuzzy volatility: composite rate of change, memberships, multiplier and modulated attention weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longspan.config import PanelSpec
from longspan.functions.columns import col
from longspan.operators.ordering import POS, ROWS, block_window, core_rows, with_blocks

# Weights of the three indicator measures, guard of the ratio, and the shape of each fuzzy set.
COMPOSITE_WEIGHTS = (0.5, 0.3, 0.2)
RATIO_GUARD = 1e-3
STABLE_SIGMA = 0.10
MODERATE_CORNERS = (0.05, 0.15, 0.30, 0.45)
SURGE_STEEPNESS, SURGE_CENTRE = 15.0, 0.35
GAMMA_MODERATE, GAMMA_SURGE, GAMMA_STABLE = 0.5, 1.0, 0.3


def composite_change(df: DataFrame, spec: PanelSpec, indicators: list[str]) -> DataFrame:
    """Weighted relative change of three measures against the previous row; null on an entity's first row."""
    rows = with_blocks(df, spec, back=1)
    w = block_window(spec)
    terms = []
    for c, weight in zip(indicators, COMPOSITE_WEIGHTS, strict=True):
        prev = F.lag(col(c), 1).over(w)
        terms.append(F.lit(weight) * F.try_divide(col(c) - prev, prev + F.lit(RATIO_GUARD)))
    return core_rows(rows.withColumn("composite_roc", terms[0] + terms[1] + terms[2]))


def stable(u: Column) -> Column:
    return F.exp(-(u * u) / F.lit(2 * STABLE_SIGMA ** 2))


def moderate(u: Column) -> Column:
    a, b, c, d = MODERATE_CORNERS
    rise, fall = (u - a) / F.lit(b - a), (d - u) / F.lit(d - c)
    return F.when(u.isNotNull(), F.greatest(F.lit(0.0), F.least(rise, F.lit(1.0), fall)))


def surge(u: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.lit(SURGE_STEEPNESS) * (u - SURGE_CENTRE)))


def memberships(df: DataFrame, u: str = "composite_roc") -> DataFrame:
    return df.withColumns({"stable": stable(col(u)), "moderate": moderate(col(u)), "surge": surge(col(u))})


def multiplier(df: DataFrame) -> DataFrame:
    """Attention multiplier gamma from the three memberships."""
    gamma = 1.0 + GAMMA_MODERATE * F.col("moderate") + GAMMA_SURGE * F.col("surge") - GAMMA_STABLE * F.col("stable")
    return df.withColumn("gamma", gamma)


def attention_weights(df: DataFrame, spec: PanelSpec, score: str, lookback: int = 30) -> DataFrame:
    """Per full look-back window ending at a row: the softmax of score * gamma over its steps, oldest first.

    A missing gamma (first row of an entity) leaves the score unchanged. A missing score keeps its place with weight 0.
    """
    df = df.withColumn("_e", col(score) * F.coalesce(F.col("gamma"), F.lit(1.0)))
    rows = with_blocks(df.select(col(spec.entity), col(spec.time), POS, ROWS, "_e"), spec, back=lookback - 1)
    steps = F.collect_list(F.struct("_e")).over(block_window(spec).rowsBetween(-(lookback - 1), 0))  # a bare null would be left out
    rows = core_rows(rows.withColumn("_steps", steps)).where(F.col(POS) >= lookback)
    rows = rows.withColumn("_energies", F.transform("_steps", lambda s: s["_e"]))
    rows = rows.withColumn("_peak", F.array_max("_energies"))
    rows = rows.withColumn("_exp", F.transform("_energies", lambda e: F.coalesce(F.exp(e - F.col("_peak")), F.lit(0.0))))
    rows = rows.withColumn("_total", F.aggregate("_exp", F.lit(0.0), lambda a, v: a + v))
    weights = F.transform("_exp", lambda v: F.coalesce(F.try_divide(v, F.col("_total")), F.lit(0.0)))
    return rows.select(col(spec.entity), col(spec.time), weights.alias("weights"))
