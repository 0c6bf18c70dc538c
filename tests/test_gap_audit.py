"""Cells hidden in runs like the observed gaps."""

import datetime as dt

from pyspark.sql import functions as F

from longspan.config import PanelSpec
from longspan.operators import impute
from longspan.operators.ordering import with_position

SPEC = PanelSpec(entity="e", time="d", measures=("a", "b"), target="t", category="c", valid_flag="ok")


def placed(spark, spec=SPEC, n=400):
    rows = []
    for e in "xy":
        for i in range(n):
            gone = i % 40 in (5, 20, 30, 31, 32)  # gaps of 1, 1 and 3 rows
            rows.append((e, dt.date(2020, 1, 1) + dt.timedelta(days=i), None if gone else float(i), float(-i), None))
    rows += [("x", dt.date(2030, 1, 1), None, 0.0, None)]  # missing up to the end: no gap
    df = spark.createDataFrame(rows, "e string, d date, a double, b double, none double").withColumn("split", F.lit("train"))
    return with_position(df, spec)


def test_draws_follow_the_observed_gaps(spark):
    draws = impute.gap_draws(placed(spark), SPEC, ["a", "b", "none"])
    assert draws == {"a": [1] * 67 + [3] * 33, "b": [1] * 100, "none": [1] * 100}
    assert impute.gap_draws(placed(spark).limit(0), SPEC, ["a"]) == {"a": [1] * 100}


def test_errors_by_gap_length(spark):
    def fill(df):
        return impute.forward_fill(df, SPEC, ["a", "b"])

    done = {}
    for size in (SPEC.block_rows, 50):
        spec = PanelSpec(entity="e", time="d", measures=("a", "b"), target="t", category="c", valid_flag="ok", block_rows=size)
        got = impute.gap_audit(placed(spark, spec), spec, ["a", "b"], fill).collect()
        done[size] = sorted((r["column"], r.gap_length, r.n_masked, round(r.rmse or -1, 6), round(r.mae or -1, 6)) for r in got)
    assert done[50] == done[SPEC.block_rows]
    rows = {(c, n): (k, rmse) for c, n, k, rmse, _ in done[50]}
    assert set(rows) == {("a", 1), ("a", 3), ("b", 1)}
    assert 0.05 * 700 < rows["a", 1][0] + rows["a", 3][0] < 0.15 * 700 and 0.05 * 800 < rows["b", 1][0] < 0.15 * 800
    assert rows["a", 3][1] > rows["a", 1][1]  # longer gaps are filled worse
    empty = impute.gap_audit(placed(spark).limit(0), SPEC, ["a"], lambda df: impute.forward_fill(df, SPEC, ["a"]))
    assert empty.count() == 0


def test_cells_are_chosen_one_by_one(spark):
    mask = impute.default_mask(SPEC, ["a", "b"])
    n = placed(spark).agg(F.count_if(mask["a"]).alias("a"), F.count_if(mask["b"]).alias("b"), F.count_if(mask["a"] & mask["b"]).alias("both")).first()
    assert 40 < n["a"] < 130 and 40 < n["b"] < 130 and n["both"] < 30
    got = impute.masked_audit(placed(spark), SPEC, ["a", "b"], mask, lambda df: impute.forward_fill(df, SPEC, ["a", "b"]))
    assert {r["column"]: r["n_masked"] for r in got.collect()}["b"] == n["b"]
