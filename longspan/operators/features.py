"""Backward-looking features. Every window stays inside (entity, split)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longspan.config import FeatureConfig, PanelSpec
from longspan.functions.columns import col
from longspan.operators.ordering import block_window, core_rows, next_known, with_blocks
from longspan.operators.scale import ColumnParams, apply_standard, fit_standard
from longspan.operators.split import SPLIT_POS, SPLIT_ROWS

TAU = 2.0 * math.pi


def calendar_exprs(spec: PanelSpec, cfg: FeatureConfig) -> dict[str, Column]:
    t = col(spec.time)
    month = F.month(t)
    season = F.lit(0)
    for m, s in cfg.seasons.items():
        season = F.when(month == m, s).otherwise(season)
    phases = {
        "day_of_week": F.weekday(t) / F.lit(7.0),
        "month": month / F.lit(12.0),
        "day_of_year": F.dayofyear(t) / F.lit(365.25),
        "season": season / F.lit(4.0),
    }
    return {f"{n}_{fn}": getattr(F, fn)(F.lit(TAU) * p) for n, p in phases.items() for fn in ("sin", "cos")}


class _Frames:
    """Window expressions of one block scan, each built once and shared by the features that need it."""

    def __init__(self, spec: PanelSpec):
        self.window = block_window(spec, ["split"])

    def trailing(self, n: int):
        return self.window.rowsBetween(-(n - 1), 0)

    def lagged(self, c: str, k: int) -> Column:
        """Value ``k`` rows back; the first ``k`` rows of a split take its first value, a split of ``k`` rows or less none."""
        return F.when(F.col(SPLIT_ROWS) > k, F.first(col(c)).over(self.window.rowsBetween(-k, 0)))

    def mean(self, c: str, w: int) -> Column:
        return F.avg(col(c)).over(self.trailing(w))

    def std(self, c: str, w: int) -> Column:
        return F.coalesce(F.stddev_samp(col(c)).over(self.trailing(w)), F.lit(0.0))

    def low(self, c: str, w: int) -> Column:
        return F.min(col(c)).over(self.trailing(w))

    def high(self, c: str, w: int) -> Column:
        return F.max(col(c)).over(self.trailing(w))


def lag_exprs(f: _Frames, cfg: FeatureConfig) -> dict[str, Column]:
    return {f"{c}_lag_{k}": f.lagged(c, k) for c in cfg.lags.columns for k in cfg.lags.steps}


def rolling_exprs(f: _Frames, cfg: FeatureConfig) -> dict[str, Column]:
    how = {"mean": f.mean, "std": f.std, "min": f.low, "max": f.high}
    return {f"{c}_roll_{kind}_{w}": how[kind](c, w) for c in cfg.rolling.columns for kind, w in _rolling_kinds(cfg)}


def _rolling_kinds(cfg: FeatureConfig) -> list[tuple[str, int]]:
    """Statistics and lengths in model order: all lengths of a statistic, but the lowest and highest of a length together."""
    windows = cfg.rolling.windows
    out = [(kind, w) for kind in ("mean", "std") for w in windows.get(kind, ())]
    extremes = sorted({*windows.get("min", ()), *windows.get("max", ())})
    return out + [(kind, w) for w in extremes for kind in ("min", "max") if w in windows.get(kind, ())]


def clip(value: Column, low: float, high: float) -> Column:
    """Bound a value; null stays null (greatest and least would skip it)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def feature_names(spec: PanelSpec, cfg: FeatureConfig) -> dict[str, list[str]]:
    """Engineered columns by category, in model order."""
    return {
        "calendar": [f"{n}_{fn}" for n in ("day_of_week", "month", "day_of_year", "season") for fn in ("sin", "cos")],
        "lag": [f"{c}_lag_{k}" for c in cfg.lags.columns for k in cfg.lags.steps],
        "rolling": [f"{c}_roll_{kind}_{w}" for c in cfg.rolling.columns for kind, w in _rolling_kinds(cfg)],
        "roc": [f"{c}_roc_{k}" for c in cfg.change.columns for k in cfg.change.steps],
        "volatility": [f"{c}_volatility_{w}" for c in cfg.volatility.columns for w in cfg.volatility.lengths],
    }


def continuous_names(spec: PanelSpec, cfg: FeatureConfig) -> list[str]:
    names = feature_names(spec, cfg)
    return names["lag"] + names["rolling"] + names["roc"] + names["volatility"]


def model_features(spec: PanelSpec, cfg: FeatureConfig, available: list[str]) -> list[str]:
    """Ordered model input: scaled base columns, calendar, engineered columns."""
    base = [f"scaled_{c}" for c in spec.numeric if f"scaled_{c}" in available]
    return base + feature_names(spec, cfg)["calendar"] + continuous_names(spec, cfg)


def calendar_features(df: DataFrame, spec: PanelSpec, cfg: FeatureConfig) -> DataFrame:
    return df.withColumns(calendar_exprs(spec, cfg))


def engineer(
    df: DataFrame, spec: PanelSpec, cfg: FeatureConfig,
    categories: tuple[str, ...] = ("calendar", "lag", "rolling", "roc", "volatility"),
) -> DataFrame:
    """All requested features from one shuffle and one sort. Inputs carry split positions.

    Lags and changes are those of columns without nulls; a null in one of them fails the job, since a shift that is then
    back-filled (``anchored_lag``) would give other values. Rolling statistics skip nulls.
    """
    shifted = {"lag": cfg.lags.columns, "roc": cfg.change.columns}
    complete = {c for family, columns in shifted.items() if family in categories for c in columns}
    out = df.withColumns({c: _present(c) for c in sorted(complete) if df.schema[c].nullable})
    if set(categories) - {"calendar"}:
        out = _windowed(out, spec, cfg, categories)
    return calendar_features(out, spec, cfg) if "calendar" in categories else out


def _present(c: str) -> Column:
    message = F.lit(f"column '{c}' holds nulls: fill it, or take its lags with anchored_lag")
    return F.when(col(c).isNull(), F.raise_error(message).cast("double")).otherwise(col(c))


def _windowed(df: DataFrame, spec: PanelSpec, cfg: FeatureConfig, categories: tuple[str, ...]) -> DataFrame:
    f = _Frames(spec)
    wanted: dict[str, Column] = {}
    if "lag" in categories:
        wanted.update(lag_exprs(f, cfg))
    if "rolling" in categories:
        wanted.update(rolling_exprs(f, cfg))
    helpers: dict[str, Column] = {}

    def shared(name: str, expr: Column) -> Column:
        if name not in wanted:
            helpers[f"_h_{name}"] = expr
            return col(f"_h_{name}")
        return col(name)

    late: dict[str, Column] = {}
    if "roc" in categories:
        for c in cfg.change.columns:
            for k in cfg.change.steps:
                prev = shared(f"{c}_lag_{k}", f.lagged(c, k))
                late[f"{c}_roc_{k}"] = clip((col(c) - prev) / (F.abs(prev) + F.lit(cfg.change.guard)), *cfg.change.bounds)
    if "volatility" in categories:
        for c in cfg.volatility.columns:
            for w in cfg.volatility.lengths:
                mean = shared(f"{c}_roll_mean_{w}", f.mean(c, w))
                std = shared(f"{c}_roll_std_{w}", f.std(c, w))
                cv = std / (F.abs(mean) + F.lit(cfg.volatility.guard))
                late[f"{c}_volatility_{w}"] = clip(cv, 0.0, cfg.volatility.bound)

    rows = with_blocks(df, spec, back=cfg.reach)
    rows = rows.select("*", *[e.alias(n) for n, e in {**wanted, **helpers}.items()])
    return core_rows(rows).withColumns(late).drop(*helpers) if late else core_rows(rows)


def anchored_lag(df: DataFrame, spec: PanelSpec, c: str, k: int, name: str | None = None) -> DataFrame:
    """Shift by ``k`` then back-fill, for columns that may hold nulls.

    Row p takes the first known value at or after position max(1, p - k), as long as that value lies ``k`` or more rows
    before the end of the split.
    """
    name = name or f"{c}_lag_{k}"
    df = next_known(df, spec, [c], ["split"], "_nk_")
    split_pos_of = col(f"_nk_{c}").getField("pos") - F.col("_pos") + F.col(SPLIT_POS)
    df = df.withColumn("_nk", F.struct(split_pos_of.alias("at"), col(f"_nk_{c}").getField("value").alias("value")))
    rows = with_blocks(df.drop(f"_nk_{c}"), spec, back=k)
    found = F.first("_nk").over(block_window(spec, ["split"]).rowsBetween(-k, 0))
    rows = core_rows(rows.withColumn("_found", found))
    usable = F.col("_found.at") <= F.col(SPLIT_ROWS) - k
    return rows.withColumn(name, F.when(usable, F.col("_found.value"))).drop("_nk", "_found")


def fit_feature_scaler(features: DataFrame, spec: PanelSpec, cfg: FeatureConfig) -> dict[str, ColumnParams]:
    return fit_standard(features.where(F.col("split") == "train"), continuous_names(spec, cfg))


def scale_engineered(features: DataFrame, spec: PanelSpec, cfg: FeatureConfig, params: dict[str, ColumnParams]) -> DataFrame:
    """Standardise the engineered columns in place; calendar columns stay as they are."""
    if not cfg.scale_engineered:
        return features
    return apply_standard(features, params, continuous_names(spec, cfg), prefix="")


def first_difference(df: DataFrame, spec: PanelSpec, columns: list[str]) -> DataFrame:
    """Change from the entity's previous row."""
    rows = with_blocks(df, spec, back=1)
    w = block_window(spec)
    diffs = {f"{c}_diff": col(c) - F.lag(col(c), 1).over(w) for c in columns}
    return core_rows(rows.withColumns(diffs))
