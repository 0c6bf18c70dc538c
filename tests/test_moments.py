"""Pair sums by masked products, rank correlation of repeated rows, and signatures of repeated rows."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from longspan.functions.moments import moment_correlation, pair_moments
from longspan.operators import ranks, validate
from longspan.operators.explore import pearson_matrix


def frame(spark, seed=3, n=500):
    random = np.random.default_rng(seed)
    a = random.normal(size=n)
    columns = {"a": a, "b.c": 1e9 + a * 2 + random.normal(size=n), "const": np.full(n, 0.1), "part": np.where(np.arange(n) < 300, 7.3, a)}
    rows = pd.DataFrame(columns).astype(object)
    for c, step in (("a", 7), ("b.c", 5)):
        rows.loc[np.arange(n) % step == 0, c] = None
    rows["half"] = [float(i) if i < 300 else None for i in range(n)]  # complete only where "part" is constant
    rows["none"] = None
    return rows, spark.createDataFrame(rows.astype(object).where(rows.notna(), None).values.tolist(),
                                       "a double, `b.c` double, const double, part double, half double, none double").repartition(4)


def test_correlations_equal_those_of_the_complete_rows(spark):
    rows, df = frame(spark)
    for r in pearson_matrix(df, list(rows.columns)).collect():
        both = rows[[r.x, r.y]].dropna().astype(float) if r.x != r.y else rows[[r.x]].dropna().astype(float)
        if len(both) < 2 or (both.nunique() == 1).any():
            assert r.r is None, (r.x, r.y, r.r)
        else:
            assert r.r == pytest.approx(1.0 if r.x == r.y else np.corrcoef(both.values.T)[0, 1], abs=1e-9)


def test_no_row_is_copied_for_its_pairs(spark):
    _, df = frame(spark)
    plan = pair_moments(df, [("a", "b.c"), ("a", "part")])._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_infinite_values_and_empty_tables(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, float("inf"), 5.0), (3.0, 1.0, 6.0), (4.0, None, 8.0)], "a double, b double, c double")
    got = {(r.x, r.y): r for r in pair_moments(df, [("a", "b"), ("a", "c")]).withColumn("r", moment_correlation()).collect()}
    assert got["a", "c"].r == pytest.approx(np.corrcoef([2, 3, 4], [5, 6, 8])[0, 1]) and got["a", "b"].n_pairs == 3
    assert got["a", "b"].r is None or math.isnan(got["a", "b"].r)
    empty = pair_moments(df.where("a > 9"), [("a", "b")]).withColumn("r", moment_correlation()).first()
    assert (empty.n_pairs, empty.r) == (0, None)


def test_a_row_repeated_a_million_times(spark):
    """No group of the join path holds more than one row's cells."""
    n = 1_000_000
    some = spark.createDataFrame([("k", 1, 1.0, 4.0), ("k", 2, 2.0, 1.0), ("k", 3, 3.0, None), ("k", 4, 5.0, 2.0)], "e string, t int, a double, b double")
    hot = spark.range(n, numPartitions=8).select(F.lit("k").alias("e"), F.lit(1).alias("t"), F.lit(2.5).alias("a"), F.lit(3.0).alias("b"))
    df = some.unionByName(hot)
    got = [ranks.rank_correlations(df, ["e", "t"], [("a", "b")], broadcast_bytes=size).first() for size in (0, 1 << 27)]
    x = pd.Series([1.0, 2.0, 5.0] + [2.5] * n).rank()
    y = pd.Series([4.0, 1.0, 2.0] + [3.0] * n).rank()
    assert got[0].n_pairs == got[1].n_pairs == n + 3
    assert got[0].rho == pytest.approx(got[1].rho) == pytest.approx(np.corrcoef(x, y)[0, 1])


ROWS = [("a", 1, 0.0, None), ("a", 1, -0.0, None), ("a", 1, None, 0.0), ("a", 1, 0.0, None), (None, 2, 1.0, 1.0), (None, 2, 1.0, 1.0),
        (None, None, None, None), (None, None, None, None), ("b", 3, float("nan"), 1.0), ("b", 3, float("nan"), 1.0), ("c", 4, 2.0, 2.0)]


def one_for_all(df, columns):
    return F.lit(1).cast("bigint"), F.lit(2).cast("bigint")


@pytest.mark.parametrize("sign", [validate.signature, one_for_all])
@pytest.mark.parametrize("broadcast", [0, 1000])
def test_repeats(spark, sign, broadcast):
    """Nulls in different places are different rows; hashes that all collide change nothing."""
    df = spark.createDataFrame(ROWS, "e string, `t.x` int, v double, w double").repartition(3)
    assert validate.repeats(df, ["e", "t.x"], sign, broadcast) == {"rows": 5, "keys": 6}
    assert validate.repeats(df, [], sign, broadcast) == {"rows": 5, "keys": 0}
    assert validate.repeats(df.limit(0), ["e"], sign, broadcast) == {"rows": 0, "keys": 0}
    assert validate.duplicate_rows(df).first()[0] == 5
