"""Chronological train / validation / test split inside each entity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longspan.config import SPLITS, PanelSpec, SplitConfig
from longspan.functions.columns import col
from longspan.operators.ordering import POS, ROWS, with_position

SPLIT_POS = "_split_pos"    # 1-based position of the row in its (entity, split)
SPLIT_ROWS = "_split_rows"  # rows of the (entity, split)


def _sizes(cfg: SplitConfig) -> tuple[Column, Column]:
    """Train and validation row counts: the double product, truncated."""
    n = F.col(ROWS).cast("double")
    return F.floor(n * F.lit(float(cfg.train))), F.floor(n * F.lit(float(cfg.val)))


def assign_split(df: DataFrame, spec: PanelSpec, cfg: SplitConfig | None = None) -> DataFrame:
    """Add ``split`` and the row's place in it; positions are computed when not yet present."""
    cfg = cfg or SplitConfig()
    if POS not in df.columns:
        df = with_position(df, spec)
    n_train, n_val = _sizes(cfg)
    pos, n = F.col(POS), F.col(ROWS)
    in_train, in_val = pos <= n_train, pos <= n_train + n_val
    return df.withColumns({
        "split": F.when(in_train, "train").when(in_val, "val").otherwise("test"),
        SPLIT_POS: F.when(in_train, pos).when(in_val, pos - n_train).otherwise(pos - n_train - n_val),
        SPLIT_ROWS: F.when(in_train, n_train).when(in_val, n_val).otherwise(n - n_train - n_val),
    })


def split_ranges(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows, first and last time of every (entity, split)."""
    return df.groupBy(col(spec.entity), "split").agg(
        F.count("*").alias("n_rows"), F.min(col(spec.time)).alias("start"), F.max(col(spec.time)).alias("end")
    )


def overall_ranges(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.groupBy("split").agg(
        F.count("*").alias("n_rows"), F.min(col(spec.time)).alias("start"), F.max(col(spec.time)).alias("end")
    )


def temporal_leaks(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Entities whose splits are not strictly ordered in time; empty splits are skipped."""
    t = col(spec.time)
    edges = df.groupBy(col(spec.entity)).agg(
        *[fn(F.when(F.col("split") == s, t)).alias(f"{s}_{name}")
          for s in SPLITS for name, fn in (("min", F.min), ("max", F.max))]
    )
    return edges.where((F.col("train_max") >= F.col("val_min")) | (F.col("val_max") >= F.col("test_min")))


def shared_keys(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Keys present in more than one split."""
    return df.groupBy(col(spec.entity), col(spec.time)).agg(F.count_distinct("split").alias("n_splits")).where(
        F.col("n_splits") > 1
    )


def tagged_union(parts: dict[str, DataFrame]) -> DataFrame:
    """One table from separate split tables, each row tagged with its split."""
    tagged = [df.withColumn("split", F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)
