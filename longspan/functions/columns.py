"""Small helpers on column names and expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """Reference a column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def require(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def unpivot(df: DataFrame, keys: list[str], columns: Iterable[str], name: str = "column", value: str = "value") -> DataFrame:
    """Long form (keys, column name, value); a narrow projection, no shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), col(c).cast("double").alias(value)) for c in columns])
    return df.select(*[col(k) for k in keys], F.inline(pairs))


def index_pairs(pairs: list[tuple[int, int]]) -> Column:
    """Generator over (pair, _a, _b): positions in an array column. As data, not code, 78 pairs cost no more than one."""
    return F.inline(F.array(*[
        F.struct(F.lit(i).alias("pair"), F.lit(a).alias("_a"), F.lit(b).alias("_b")) for i, (a, b) in enumerate(pairs)
    ]))


def column_stats(df: DataFrame, columns: Iterable[str], metrics: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    """One row per (keys, column) with aggregates of ``value`` over the long form; combined before the small shuffle."""
    keys = keys or []
    return unpivot(df, keys, columns).groupBy(*[col(k) for k in keys], "column").agg(
        *[e.alias(n) for n, e in metrics.items()]
    )


def per_column(df: DataFrame, columns: Iterable[str], metrics: dict) -> DataFrame:
    """One row per column, of any type, from one wide aggregate.

    ``metrics`` maps a metric name to a function from column name to an aggregate expression.
    """
    columns = list(columns)
    wide = df.agg(*[
        F.struct(F.lit(c).alias("column"), *[fn(c).alias(m) for m, fn in metrics.items()]).alias(f"_{i}")
        for i, c in enumerate(columns)
    ])
    return wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))])))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 for an empty whole."""
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole.cast("double")), F.lit(0.0))
