"""Filling of missing measures with parameters fitted on the training rows only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longspan.config import PanelSpec
from longspan.functions.columns import col, unpivot
from longspan.functions.quantiles import column_quantiles
from longspan.operators.ordering import POS, last_known, next_known

SCOPE = ["split"]


def forward_fill(df: DataFrame, spec: PanelSpec, columns: list[str] | None = None) -> DataFrame:
    """Last known value inside (entity, split); nothing crosses an entity or a split."""
    columns = columns or spec.numeric
    out = last_known(df, spec, columns, SCOPE, "_last_")
    return out.withColumns({c: col(f"_last_{c}").getField("value") for c in columns}).drop(*[f"_last_{c}" for c in columns])


def fit_medians(filled: DataFrame, columns: list[str]) -> dict[str, float]:
    """Training medians of forward-filled columns; 0 for a column with no value."""
    train = filled.where(F.col("split") == "train")
    rows = column_quantiles(train, columns, [0.5], names=["median"]).collect()
    found = {r["column"]: r["median"] for r in rows}
    return {c: float(found.get(c, 0.0)) for c in columns}


def fill_constants(df: DataFrame, values: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(col(c), F.lit(v)) for c, v in values.items()})


def missing_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls per (split, column)."""
    wide = df.groupBy("split").agg(*[F.count_if(col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), col(c).alias("n_missing")) for c in columns])
    return wide.select("split", F.inline(pairs))


def require_complete(df: DataFrame, columns: list[str]) -> None:
    left = missing_counts(df, columns).where(F.col("n_missing") > 0).collect()  # a row per split and column at most
    if left:
        raise ValueError(f"missing values remain after imputation: {[tuple(r) for r in left]}")


def validity_by_split(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Rows with and without a truly observed target, per split."""
    flag = col(spec.valid_flag)
    return df.groupBy("split").agg(F.count_if(flag).alias("n_observed"), F.count_if(~flag).alias("n_missing"),
                                   (F.avg(flag.cast("int")) * 100.0).alias("pct_observed"))


def interpolate(df: DataFrame, spec: PanelSpec, columns: list[str], max_gap: int = 5) -> DataFrame:
    """Linear interpolation over gaps of up to ``max_gap`` rows, then forward and backward padding, inside (entity, split)."""
    out = next_known(last_known(df, spec, columns, SCOPE, "_prev_"), spec, columns, SCOPE, "_next_")
    fills = {}
    for c in columns:
        before, after = col(f"_prev_{c}"), col(f"_next_{c}")
        p0, v0, p1, v1 = before.getField("pos"), before.getField("value"), after.getField("pos"), after.getField("value")
        line = v0 + (v1 - v0) * ((F.col(POS) - p0).cast("double") / F.nullif(p1 - p0, F.lit(0)).cast("double"))
        fills[c] = F.when(col(c).isNotNull(), col(c)).when(p1 - p0 - 1 <= max_gap, line).otherwise(F.coalesce(v0, v1))
    return out.withColumns(fills).drop(*[f"{p}{c}" for p in ("_prev_", "_next_") for c in columns])


#: Draws that stand for the observed gap lengths of a column.
DRAWS = 100


def _digest(spec: PanelSpec, column: str, at: int) -> Column:
    """A number below 65,536 for each cell, by a hash of its key and column."""
    text = F.concat_ws("|", col(spec.entity).cast("string"), col(spec.time).cast("string"), F.lit(column))
    return F.conv(F.substring(F.md5(text.cast("binary")), at, 4), 16, 10).cast("bigint")


def default_mask(spec: PanelSpec, columns: list[str], percent: int = 10) -> dict[str, Column]:
    """A repeatable choice of single cells to hide, of each column its own."""
    return {c: _digest(spec, c, 1) * 100 < 65536 * percent for c in columns}


def gap_draws(df: DataFrame, spec: PanelSpec, columns: list[str]) -> dict[str, list[int]]:
    """The observed gap lengths of each column, as ``DRAWS`` equally likely ones; 1 for a column without gaps.

    A gap is a run of missing cells between two known ones of an entity and split. Lengths are counted by Spark; the driver gets
    ``DRAWS`` numbers a column.
    """
    near = next_known(last_known(df, spec, columns, SCOPE, "_prev_"), spec, columns, SCOPE, "_next_")
    cells = []
    for c in columns:
        before, after = col(f"_prev_{c}").getField("pos"), col(f"_next_{c}").getField("pos")
        length = F.when(col(c).isNull() & (F.col(POS) == before + 1), after - before - 1)
        cells.append(F.struct(F.lit(c).alias("column"), length.cast("bigint").alias("length")))
    found = near.select(F.inline(F.filter(F.array(*cells), lambda x: x["length"].isNotNull())))
    counts = found.groupBy("column", "length").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("column").orderBy("length").rowsBetween(Window.unboundedPreceding, 0))
    counts = counts.select("column", "length", upto.alias("upto"), F.sum("n").over(Window.partitionBy("column")).alias("total"))
    # draw k is the smallest length that more than k of DRAWS equal shares reach up to, so a length has the draws up to its own share
    last = F.expr(f"cast((upto * {DRAWS} + total - 1) div total AS int)")
    drawn = counts.groupBy("column", last.alias("stop")).agg(F.min("length").alias("length"))
    out = {c: [1] * DRAWS for c in columns}
    rows = sorted((r["column"], r["stop"], r["length"]) for r in drawn.collect())  # DRAWS rows a column at most
    at = dict.fromkeys(columns, 0)
    for c, stop, length in rows:
        out[c][at[c]:stop] = [length] * (stop - at[c])
        at[c] = stop
    return out


def _hide(df: DataFrame, columns: list[str], hidden: dict[str, Column], fill) -> DataFrame:
    """The table filled after the chosen cells were hidden, with what they held."""
    chosen = {c: F.coalesce(hidden[c], F.lit(False)) for c in columns}
    truth = df.withColumns({f"_true_{c}": F.when(chosen[c], col(c)) for c in columns})
    return fill(truth.withColumns({c: F.when(~chosen[c], col(c)) for c in columns}))


def _errors(cells: DataFrame, by: list[str]) -> DataFrame:
    err = F.col("f") - F.col("t")
    return cells.where(F.col("t").isNotNull()).groupBy(*by).agg(
        F.count("*").alias("n_masked"), F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae")
    )


def masked_audit(df: DataFrame, spec: PanelSpec, columns: list[str], mask: Column | dict[str, Column], fill) -> DataFrame:
    """Reconstruction error per column: hide the known cells chosen by ``mask`` (of all columns, or one a column), fill, compare with
    the hidden values."""
    filled = _hide(df, columns, mask if isinstance(mask, dict) else dict.fromkeys(columns, mask), fill)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), col(f"_true_{c}").alias("t"), col(c).alias("f")) for c in columns])
    return _errors(filled.select(F.inline(cells)), ["column"])


def gap_audit(df: DataFrame, spec: PanelSpec, columns: list[str], fill, percent: int = 10) -> DataFrame:
    """Reconstruction error per column and gap length, with cells hidden as they are missed in fact: in runs whose lengths are drawn from
    the column's observed gaps, about ``percent`` of the cells together.

    Runs start at cells chosen by a hash of key and column and stay inside entity and split; a run that starts inside another ends it.
    """
    draws = gap_draws(df, spec, columns)
    starts = {}
    for c in columns:
        length = F.element_at(F.lit(draws[c]), (F.pmod(_digest(spec, c, 5), F.lit(DRAWS)) + 1).cast("int"))
        starts[f"_run_{c}"] = F.when(_digest(spec, c, 1) * sum(draws[c]) < 65536 * percent, length.cast("bigint"))
    placed = last_known(df.withColumns(starts), spec, list(starts), SCOPE, "_last")
    run = {c: col(f"_last_run_{c}") for c in columns}
    hidden = {c: run[c].getField("pos") + run[c].getField("value") > F.col(POS) for c in columns}
    filled = _hide(placed, columns, hidden, fill)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), run[c].getField("value").alias("gap_length"),
                               col(f"_true_{c}").alias("t"), col(c).alias("f")) for c in columns])
    return _errors(filled.select(F.inline(cells)), ["column", "gap_length"])
