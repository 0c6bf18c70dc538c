"""Row positions and bounded window groups for series of any length.

A window over one entity puts the whole entity into one task. The longest entity is measured first (a count on one
column). While it fits a block, positions and windows are taken per entity, one shuffle in all. Beyond that, positions
are counted per (entity, time bucket) plus a running count over the small bucket table, and every later window runs per
(entity, block of positions). Rows just before (or after) a block are copied into it so frames reach across borders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longspan.config import PanelSpec
from longspan.functions.columns import col

POS = "_pos"    # 1-based position of the row in its entity
ROWS = "_rows"  # rows of the entity
BLOCK = "_block"
CORE = "_core"  # false on rows copied in from a neighbouring block


UNTIMED_BUCKETS = 4096  # rows without a time have no order among themselves, so any buckets do


def time_bucket(df: DataFrame, spec: PanelSpec) -> Column:
    """Coarse time step of a row; rows without a time come last, as in the ordering of positions, spread over many buckets."""
    t = col(spec.time)
    if isinstance(df.schema[spec.time].dataType, T.DateType):
        step = F.floor(F.unix_date(t) / spec.bucket_days)
    else:
        step = F.floor(F.unix_seconds(t) / F.lit(spec.bucket_days * 86_400.0))
    untimed = F.lit(2**62) + F.pmod(F.xxhash64(*[col(c) for c in df.columns]), F.lit(UNTIMED_BUCKETS))
    return F.coalesce(step.cast("bigint"), untimed)


def longest_series(df: DataFrame, spec: PanelSpec) -> int:
    """Rows of the longest entity; reads one column and combines before its shuffle."""
    return df.groupBy(col(spec.entity)).count().agg(F.max("count").alias("n")).first()["n"] or 0


def with_position(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Add the row's position in its entity and the entity's row count. Rows without an entity are left out.

    The length of the longest entity stays with the row-count column as metadata for the operators that follow.
    """
    longest = longest_series(df, spec)
    df = df.where(col(spec.entity).isNotNull())
    placed = _within_entity(df, spec) if longest <= spec.block_rows else _by_bucket(df, spec)
    return placed.withMetadata(ROWS, {"longest": longest})


def _within_entity(df: DataFrame, spec: PanelSpec) -> DataFrame:
    by_entity = Window.partitionBy(col(spec.entity))
    in_time = by_entity.orderBy(col(spec.time).asc_nulls_last())
    return df.select("*", F.row_number().over(in_time).cast("bigint").alias(POS),
                     F.count("*").over(in_time.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(ROWS))


def _by_bucket(df: DataFrame, spec: PanelSpec) -> DataFrame:
    e = col(spec.entity)
    rows = df.withColumn("_tb", time_bucket(df, spec))
    buckets = rows.groupBy(e, "_tb").agg(F.count("*").alias("_in_bucket"))
    by_entity = Window.partitionBy(e)
    before = F.sum("_in_bucket").over(by_entity.orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1))
    buckets = buckets.select(
        e, "_tb", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_in_bucket").over(by_entity).alias(ROWS)
    )
    in_bucket = F.row_number().over(Window.partitionBy(e, "_tb").orderBy(col(spec.time).asc_nulls_last()))
    rows = rows.withColumn("_k", in_bucket).join(buckets, [spec.entity, "_tb"])
    return rows.withColumn(POS, F.col("_before") + F.col("_k")).drop("_tb", "_k", "_before")


def fits_one_block(df: DataFrame, spec: PanelSpec) -> bool:
    """Whether every entity is known to fit one block; unknown counts as no."""
    longest = df.schema[ROWS].metadata.get("longest") if ROWS in df.columns else None
    return longest is not None and longest <= spec.block_rows


def block_of(spec: PanelSpec, shift: int = 0) -> Column:
    return F.floor((F.col(POS) - 1 + shift) / spec.block_rows)


def with_blocks(df: DataFrame, spec: PanelSpec, back: int, ahead: int = 0) -> DataFrame:
    """Tag rows with their block and copy each block's border rows into its neighbours.

    ``back`` rows before a block and ``ahead`` rows after it are added to it with ``_core`` false.
    """
    if back >= spec.block_rows or ahead >= spec.block_rows:
        raise ValueError("block_rows must exceed the reach of the window")
    if fits_one_block(df, spec):
        return df.withColumn(BLOCK, F.lit(0).cast("bigint")).withColumn(CORE, F.lit(True))
    first = F.greatest(block_of(spec, -ahead), F.lit(0))
    reach = F.sequence(first, block_of(spec, back))
    return df.withColumn(BLOCK, F.explode(reach)).withColumn(CORE, F.col(BLOCK) == block_of(spec))


def block_window(spec: PanelSpec, scope: list[str] | None = None) -> WindowSpec:
    return Window.partitionBy(col(spec.entity), *[col(s) for s in scope or []], BLOCK).orderBy(POS)


def core_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORE)).drop(CORE, BLOCK)


def last_known(df: DataFrame, spec: PanelSpec, columns: list[str], scope: list[str], prefix: str) -> DataFrame:
    """For each column add the struct (pos, value) of its last non-null at or before the row, within entity and scope."""
    return _nearest_known(df, spec, columns, scope, prefix, backward=True)


def next_known(df: DataFrame, spec: PanelSpec, columns: list[str], scope: list[str], prefix: str) -> DataFrame:
    """As ``last_known``, but the first non-null at or after the row."""
    return _nearest_known(df, spec, columns, scope, prefix, backward=False)


def _nearest_known(
    df: DataFrame, spec: PanelSpec, columns: list[str], scope: list[str], prefix: str, backward: bool
) -> DataFrame:
    keys = [spec.entity, *scope]
    key_cols = [col(k) for k in keys]
    known = {c: F.when(col(c).isNotNull(), F.struct(F.col(POS).alias("pos"), col(c).alias("value"))) for c in columns}

    whole = fits_one_block(df, spec)
    df = df.withColumn(BLOCK, F.lit(0).cast("bigint") if whole else block_of(spec))
    # Looking ahead is looking back in reverse order: a frame that only grows is read once per row.
    pos, block, border = (F.col(POS), F.col(BLOCK), F.max) if backward else (F.col(POS).desc(), F.col(BLOCK).desc(), F.min)
    inner = Window.partitionBy(*key_cols, BLOCK).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy(*key_cols).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)

    def within(c: Column) -> Column:
        return F.last(c, ignorenulls=True)

    filled = df.select("*", *[within(known[c]).over(inner).alias(f"{prefix}{c}") for c in columns])
    if whole:
        return filled.drop(BLOCK)
    # Only entities longer than one block have anything to carry from one block to the next.
    carry = df.where(F.col(ROWS) > spec.block_rows).groupBy(*key_cols, BLOCK).agg(
        *[border(known[c]).alias(f"{prefix}{c}") for c in columns]
    )
    carry = carry.select(
        *key_cols, BLOCK, *[within(col(f"{prefix}{c}")).over(outer).alias(f"_carry{i}") for i, c in enumerate(columns)]
    )
    joined = filled.join(carry, [*keys, BLOCK], "left")
    out = {f"{prefix}{c}": F.coalesce(col(f"{prefix}{c}"), F.col(f"_carry{i}")) for i, c in enumerate(columns)}
    return joined.withColumns(out).drop(BLOCK, *[f"_carry{i}" for i in range(len(columns))])
