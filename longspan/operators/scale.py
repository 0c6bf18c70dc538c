"""Scalers fitted on training rows, kept as a small parameter table and applied as plain projections."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longspan.functions.columns import col, column_stats
from longspan.functions.quantiles import column_quantiles


@dataclass(frozen=True)
class ColumnParams:
    """What training taught about one column. ``median`` is taken before the constant fill, the rest after it."""

    column: str
    median: float
    mean: float
    variance: float
    scale: float
    min: float
    max: float


PARAMS_SCHEMA = T.StructType(
    [T.StructField("column", T.StringType())]
    + [T.StructField(n, T.DoubleType()) for n in ("median", "mean", "variance", "scale", "min", "max")]
)


def params_table(spark: SparkSession, params: dict[str, ColumnParams]) -> DataFrame:
    return spark.createDataFrame([tuple(asdict(p).values()) for p in params.values()], PARAMS_SCHEMA)


def params_from_table(df: DataFrame) -> dict[str, ColumnParams]:
    return {r["column"]: ColumnParams(**r.asDict()) for r in df.collect()}


def standard_scale(variance: float) -> float:
    """Population standard deviation; 1 for a constant column."""
    return variance ** 0.5 if variance > 0 else 1.0


def moments(df: DataFrame, columns: list[str]) -> DataFrame:
    v = F.col("value")
    return column_stats(df, columns, {
        "n_known": F.count(v), "n_missing": F.count_if(v.isNull()), "mean": F.avg(v), "variance": F.var_pop(v),
        "min": F.min(v), "max": F.max(v),
    })


def fit_fill_and_scale(filled: DataFrame, columns: list[str]) -> dict[str, ColumnParams]:
    """Medians and scaling parameters of the training rows without a second pass over imputed data.

    The moments of the column after its nulls become the median follow from the moments of the known values, the number of
    nulls and the median (merging two groups' means and squared deviations).
    """
    train = filled.where(F.col("split") == "train")
    medians = {r["column"]: r["median"] for r in column_quantiles(train, columns, [0.5], names=["median"]).collect()}
    fitted = {}
    for r in moments(train, columns).collect():
        c, known, missing = r["column"], r["n_known"], r["n_missing"]
        med = float(medians.get(c, 0.0))
        if known == 0:
            fitted[c] = ColumnParams(c, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0)
            continue
        n, gap = known + missing, med - r["mean"]
        mean = (known * r["mean"] + missing * med) / n
        variance = (known * r["variance"] + gap * gap * known * missing / n) / n
        low, high = (min(r["min"], med), max(r["max"], med)) if missing else (r["min"], r["max"])
        fitted[c] = ColumnParams(c, med, mean, variance, standard_scale(variance), low, high)
    return {c: fitted[c] for c in columns}


def fit_standard(train: DataFrame, columns: list[str]) -> dict[str, ColumnParams]:
    """Mean and population variance of complete columns, one aggregate."""
    fitted = {}
    for r in moments(train, columns).collect():
        if r["n_known"] == 0:
            fitted[r["column"]] = ColumnParams(r["column"], 0.0, 0.0, 0.0, 1.0, 0.0, 0.0)
            continue
        fitted[r["column"]] = ColumnParams(
            r["column"], None, r["mean"], r["variance"], standard_scale(r["variance"]), r["min"], r["max"]
        )
    return {c: fitted[c] for c in columns}


def apply_standard(df: DataFrame, params: dict[str, ColumnParams], columns: list[str], prefix: str = "scaled_") -> DataFrame:
    """Append ``prefix + column``; an empty prefix replaces the columns."""
    return df.withColumns({
        f"{prefix}{c}": (col(c) - F.lit(params[c].mean)) / F.lit(params[c].scale) for c in columns
    })


def fit_robust(train: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Median and interquartile range per column; a zero range counts as 1."""
    rows = column_quantiles(train, columns, [0.25, 0.5, 0.75], names=["q25", "q50", "q75"]).collect()
    return {r["column"]: (r["q50"], (r["q75"] - r["q25"]) or 1.0) for r in rows}


def fit_minmax(train: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Minimum and range per column; a zero range counts as 1."""
    rows = moments(train, columns).collect()
    return {r["column"]: (r["min"], (r["max"] - r["min"]) or 1.0) for r in rows if r["n_known"]}


def apply_shift_scale(df: DataFrame, params: dict[str, tuple[float, float]], prefix: str) -> DataFrame:
    return df.withColumns({f"{prefix}{c}": (col(c) - F.lit(a)) / F.lit(b) for c, (a, b) in params.items()})
