"""Quantiles and rank correlations against pandas, with every internal path forced."""

import numpy as np
import pandas as pd
import pytest

from longspan.functions import quantiles as q
from longspan.operators import explore
from longspan.operators.ranks import rank_correlations
from longspan.config import PanelSpec

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]
NAMES = [f"q{i}" for i in range(len(PROBS))]


@pytest.fixture(scope="module")
def grouped():
    """A hot group with a third of its rows equal, small groups, and single values."""
    rng = np.random.default_rng(7)
    hot = pd.DataFrame({"g": "hot", "v": np.where(rng.random(20_000) < 0.33, 5.0, rng.normal(0, 100, 20_000))})
    parts = [hot] + [pd.DataFrame({"g": f"s{n}", "v": rng.exponential(10, n).round(1)}) for n in (1, 2, 3, 4, 5, 6, 7, 50, 333)]
    out = pd.concat(parts, ignore_index=True)
    out.loc[rng.random(len(out)) < 0.1, "v"] = None
    return out


def check(got: pd.DataFrame, frame: pd.DataFrame):
    got = got.set_index("g")
    for g, part in frame.dropna().groupby("g"):
        want = part["v"].quantile(PROBS).to_numpy()
        assert got.loc[g, "n"] == len(part)
        np.testing.assert_allclose(got.loc[g, NAMES].to_numpy(dtype=float), want, rtol=1e-12, atol=1e-9, err_msg=g)


@pytest.mark.parametrize("accuracy", [200, 5_000, 50_000])
def test_bracketed_quantiles_are_exact(spark, grouped, accuracy):
    rows = spark.createDataFrame(grouped.dropna().rename(columns={"v": "_v"})).repartition(7)
    check(q.bracketed_quantiles(rows, ["g"], PROBS, NAMES, accuracy=accuracy).toPandas(), grouped)


def test_many_groups_split_hot_ones(spark, grouped):
    rows = spark.createDataFrame(grouped.dropna().rename(columns={"v": "_v"})).repartition(7)
    got = q.bracketed_quantiles(rows, ["g"], PROBS, NAMES, accuracy=5_000, broadcast_groups=2, hot_rows=100)
    check(got.toPandas(), grouped)


@pytest.mark.parametrize("buffered", [0, 10**9])
def test_both_quantile_paths(spark, grouped, buffered):
    rows = spark.createDataFrame(grouped.astype({"v": object}).where(grouped.notna(), None), "g string, v double")
    check(q.grouped_quantiles(rows, ["g"], "v", PROBS, NAMES, buffered=buffered).toPandas(), grouped)


def test_null_groups_and_no_groups(spark, grouped):
    frame = grouped.copy()
    frame.loc[frame["g"] == "s333", "g"] = None
    rows = spark.createDataFrame(frame.astype(object).where(frame.notna(), None), "g string, v double")
    one, two = (q.grouped_quantiles(rows, ["g"], "v", [0.5], ["m"], buffered=b).toPandas().sort_values("g").reset_index(drop=True) for b in (0, 10**9))
    pd.testing.assert_frame_equal(one, two)
    assert one["g"].isna().sum() == 1
    whole = [q.grouped_quantiles(rows, [], "v", [0.25, 0.5], ["a", "b"], buffered=b).first() for b in (0, 10**9)]
    assert whole[0] == whole[1] and whole[0]["b"] == pytest.approx(frame["v"].median())


@pytest.mark.parametrize("options", [{}, {"broadcast_groups": 2, "hot_rows": 100}])
def test_narrowed_brackets_are_exact(spark, grouped, options):
    rows = spark.createDataFrame(grouped.dropna().rename(columns={"v": "_v"})).repartition(7)
    check(q.bracketed_quantiles(rows, ["g"], PROBS, NAMES, accuracy=20, sliver_rows=10, **options).toPandas(), grouped)


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(3)
    n = 700
    t = pd.DataFrame({"e": ["x"] * n, "d": range(n), "a": rng.integers(0, 6, n).astype(float), "b": rng.normal(size=n).round(2), "c": rng.normal(size=n)})
    t["f"] = t["b"] * 2 + rng.normal(size=n)
    t["k"] = 1.0
    for i, c in enumerate("abcf"):
        t.loc[rng.random(n) < 0.1 * (i + 1), c] = None
    return pd.concat([t, t.iloc[:40]], ignore_index=True)  # repeated rows count as often as they occur


PAIRS = [("a", "b"), ("a", "c"), ("b", "c"), ("b", "f"), ("a", "f"), ("c", "f")]


def as_spark(spark, t):
    return spark.createDataFrame(t.astype(object).where(t.notna(), None), "e string, d long, a double, b double, c double, f double, k double")


@pytest.mark.parametrize("options", [
    {}, {"range_values": 20}, {"broadcast_bytes": 0}, {"range_values": 20, "broadcast_bytes": 0}, {"broadcast_bytes": 0, "hot_cells": 5}])
def test_rank_correlations_match_pandas(spark, table, options):
    got = {(r["x"], r["y"]): r for r in rank_correlations(as_spark(spark, table), ["e", "d"], PAIRS, **options).collect()}
    for x, y in PAIRS:
        complete = table[[x, y]].dropna()
        want = complete[x].rank().corr(complete[y].rank())
        assert got[x, y]["rho"] == pytest.approx(want, abs=1e-12) and got[x, y]["n_pairs"] == len(complete)


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "hot_cells": 1}])
def test_rows_of_one_key_with_different_gaps_stay_apart(spark, options):
    rows = [("k", 1, 5.0, None), ("k", 1, None, 5.0), ("k", 2, 1.0, 2.0), ("k", 2, 2.0, 1.0), ("k", 3, 3.0, 3.0), ("k", 4, None, 7.0), ("k", 4, 7.0, None)]
    df = spark.createDataFrame(rows, "e string, d long, a double, b double")
    got = rank_correlations(df, ["e", "d"], [("a", "b")], **options).first()
    assert got["rho"] == pytest.approx(0.5) and got["n_pairs"] == 3


def test_pearson_matrix_and_constant_column(spark, table):
    got = {(r["x"], r["y"]): r["r"] for r in explore.pearson_matrix(as_spark(spark, table), ["a", "b", "c", "f", "k"]).collect()}
    want = table[["a", "b", "c", "f"]].corr()
    for x in want:
        for y in want:
            assert got[x, y] == pytest.approx(want.loc[x, y], abs=1e-12)
    assert len(got) == 25 and got["k", "a"] is None and got["k", "k"] is None


def test_distribution_summary(spark):
    values = [3.0, 1.0, 4.0, 1.5, 9.0, 2.6, None]
    df = spark.createDataFrame([(v, 7.0, None if i else 1.0) for i, v in enumerate(values)], "v double, same double, one double")
    got = {r["column"]: r for r in explore.distribution_summary(df, ["v", "same", "one"]).collect()}
    s = pd.Series(values).dropna()
    assert got["v"]["skewness"] == pytest.approx(s.skew()) and got["v"]["p95"] == pytest.approx(s.quantile(0.95))
    assert got["same"]["skewness"] == 0.0 and got["same"]["std"] == 0.0
    assert got["one"]["std"] == 0.0 and got["one"]["skewness"] is None


def test_histogram_follows_numpy(spark):
    rng = np.random.default_rng(1)
    values = np.round(rng.integers(0, 11, 500) * 0.01, 2)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = explore.histograms(df, {"v": 40}).orderBy("bin").toPandas()
    assert list(got["n"]) == list(np.histogram(values, bins=40)[0])


def test_month_ends_include_empty_months(spark):
    spec = PanelSpec(entity="e", time="d", measures=(), target="y", category="k")
    df = spark.createDataFrame([("a", "2020-01-15", 1.0), ("a", "2020-01-20", 3.0), ("a", "2020-04-01", 5.0)], "e string, d string, y double")
    df = df.withColumn("d", df["d"].cast("date"))
    got = [(str(r["month_end"]), r["mean"]) for r in explore.month_end_means(df, spec).orderBy("month_end").collect()]
    assert got == [("2020-01-31", 2.0), ("2020-02-29", None), ("2020-03-31", None), ("2020-04-30", 5.0)]


def test_histogram_of_constant_and_very_narrow_columns(spark):
    """Where lower edges coincide only the last of such bins has room for a value: constants lie in the last bin."""
    far = 2.0 ** 53
    frame = pd.DataFrame({"same": [0.1] * 5, "narrow": [far, far, far + 2, far + 4, far + 4], "infinite": [np.inf] * 5, "wide": [0.0, 1.0, 2.0, 3.0, 4.0]})
    got = explore.histograms(spark.createDataFrame(frame), {"same": 40, "narrow": 40, "infinite": 8, "wide": 4}).toPandas()
    counts = {c: part.set_index("bin")["n"] for c, part in got.groupby("column")}
    assert counts["same"][40] == 5 and counts["same"].sum() == 5
    assert counts["infinite"][8] == 5 and counts["infinite"].sum() == 5
    assert counts["wide"].sort_index().tolist() == [1, 1, 1, 2]
    edges = np.array([far + k * (4.0 / 40) for k in range(40)])
    want = pd.Series([(edges <= v).sum() for v in frame["narrow"]]).value_counts()
    assert counts["narrow"][counts["narrow"] > 0].to_dict() == want.to_dict()
