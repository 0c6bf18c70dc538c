"""Sums of column pairs, each on the rows that are complete for it, without a row for every pair.

A batch of rows is a matrix of values and a mask of what is known. Four products of these hold all pair counts, sums, squares and
cross products at once, so a task adds up a few small matrices and returns one row for each pair; rows are never copied.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from longspan.functions.columns import col
from longspan.session import map_batches

_SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")
_ENDS = ("min_x", "max_x", "min_y", "max_y")


def batch_moments(values: np.ndarray, known: np.ndarray) -> dict[str, np.ndarray]:
    """Matrices over (x, y): counts, sums and extremes of x where y is known too, and cross products. Unknown values are 0."""
    m = known.astype(np.float64)
    n_columns = values.shape[1]
    low, high = (np.full((n_columns, n_columns), end) for end in (np.inf, -np.inf))
    for j in range(n_columns):
        both = known & known[:, j:j + 1]
        low[:, j] = np.where(both, values, np.inf).min(axis=0, initial=np.inf)
        high[:, j] = np.where(both, values, -np.inf).max(axis=0, initial=-np.inf)
    with np.errstate(invalid="ignore"):
        odd = ~np.isfinite(values).all(axis=1)
        v, k = values[~odd], m[~odd]
        out = {"n": m.T @ m, "sx": v.T @ k, "sxx": (v * v).T @ k, "sxy": v.T @ v}
        for row, mask in zip(values[odd], known[odd], strict=True):  # infinite or NaN: only where both are known
            both = mask[:, None] & mask[None, :]
            for name, cell in (("sx", row[:, None]), ("sxx", (row * row)[:, None]), ("sxy", row[:, None] * row[None, :])):
                out[name] = out[name] + np.where(both, cell, 0.0)
    return out | {"min_x": low, "max_x": high}


def pair_moments(df: DataFrame, pairs: list[tuple[str, str]], centres: dict[str, float | None] | None = None) -> DataFrame:
    """(x, y, n_pairs) of each named pair with sums about ``centres`` (by default the columns' means) and the pair's extremes."""
    columns = sorted({c for p in pairs for c in p})
    if centres is None:
        centres = df.agg(*[F.avg(col(c).cast("double")).alias(f"_{i}") for i, c in enumerate(columns)]).first()
        centres = dict(zip(columns, centres, strict=True))
    shift = np.array([centres[c] if centres[c] is not None and np.isfinite(centres[c]) else 0.0 for c in columns])
    at = {c: i for i, c in enumerate(columns)}
    x, y = (np.array([at[p[side]] for p in pairs]) for side in (0, 1))

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            cells = [batch.column(i) for i in range(len(columns))]
            known = np.stack([np.asarray(c.is_valid()) for c in cells], axis=1)
            values = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in cells], axis=1)
            found = batch_moments(np.where(known, values - shift, 0.0), known)
            for name, matrix in found.items():
                add = {"min_x": np.minimum, "max_x": np.maximum}.get(name, np.add)
                total[name] = add(total[name], matrix) if name in total else matrix
        if total:
            told = {"n": total["n"][x, y].astype(np.int64), "sxy": total["sxy"][x, y]}
            for name in ("sx", "sxx", "min_x", "max_x"):
                told[name], told[name.replace("x", "y") if name[0] == "s" else f"{name[:-1]}y"] = total[name][x, y], total[name][y, x]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(pairs)), pa.int32()), *[pa.array(told[n]) for n in (*_SUMS, *_ENDS)]],
                                             names=["pair", *_SUMS, *_ENDS])

    schema = "pair int, n bigint, " + ", ".join(f"{n} double" for n in (*_SUMS[1:], *_ENDS))
    parts = map_batches(df.select(*[col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)]), run, schema)
    sums = parts.groupBy("pair").agg(F.sum("n").alias("n_pairs"), *[F.sum(n).alias(n) for n in _SUMS[1:]],
                                     *[(F.min if n.startswith("min") else F.max)(n).alias(n) for n in _ENDS])
    names = df.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "pair int, x string, y string")
    return names.join(sums, "pair", "left").drop("pair").fillna(0, ["n_pairs"])


def moment_correlation() -> Column:
    """Pearson correlation from ``pair_moments``; null when either side is constant."""
    n = F.col("n_pairs")
    varies = (F.col("min_x") < F.col("max_x")) & (F.col("min_y") < F.col("max_y"))
    xx, yy = (F.col(f"s{v}{v}") - F.col(f"s{v}") * F.col(f"s{v}") / n for v in "xy")
    return F.when(varies, F.try_divide(F.col("sxy") - F.col("sx") * F.col("sy") / n, F.sqrt(xx * yy)))
