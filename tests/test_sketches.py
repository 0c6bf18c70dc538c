"""Quantiles from merged sketches: the report's rows are the same as from buffers, and equal numpy's."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from longspan.config import PanelSpec
from longspan.functions import quantiles
from longspan.operators import explore

SPEC = PanelSpec(entity="e", time="d", measures=("a", "b"), target="t", category="c", valid_flag="ok")


def panel(spark, n=3_000):
    rng = random.Random(7)
    rows = []
    for k in range(n):
        e = rng.choice(["x", "y", "z", None])
        d = None if k % 97 == 0 else dt.date(2019, 11, 1) + dt.timedelta(days=rng.randrange(500))
        t = None if e == "z" or k % 11 == 0 else round(rng.gauss(100, 30), 4)
        rows.append((e, d, rng.random() if k % 5 else None, 1.5, t, rng.choice(["Good", "Poor", None])))
    return spark.createDataFrame(rows, "e string, d date, a double, b double, t double, c string")


def told(report):
    return {(r.section, r.key, r.metric): r.value for r in report.collect()}


def test_report_from_sketches(spark, monkeypatch):
    df = panel(spark)
    calls = []
    ready = quantiles.sketch_brackets
    monkeypatch.setattr(quantiles, "sketch_brackets", lambda *a: calls.append(1) or ready(*a))
    plain = told(explore.explore_report(df, SPEC))
    assert not calls
    mine = told(explore.explore_report(df, SPEC, buffered=1))
    assert calls and plain.keys() == mine.keys()
    for key, value in plain.items():
        try:
            assert float(mine[key]) == pytest.approx(float(value), rel=1e-9, abs=1e-12), key
        except (TypeError, ValueError):
            assert mine[key] == value, key


def test_merged_brackets_hold_the_ranks(spark, monkeypatch):
    """Sketches that can't hold all values, merged from cells; with and without a measured bracket width."""
    monkeypatch.setattr(quantiles, "SKETCH_ITEMS", 512)
    monkeypatch.setattr(quantiles, "SKETCH_MARGIN", 0.03)
    df = spark.range(40_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 40).alias("cell"),
                                    F.when(F.col("id") % 7 != 0, F.pmod(F.xxhash64("id"), F.lit(9_001)) / 7.0).alias("v"))
    cells = df.groupBy("g", "cell").agg(quantiles.sketch_of(F.col("v")).alias("_sketch"), F.count("v").alias("_n"))
    probs = [0.05, 0.5, 0.99]
    held = {}
    for r in df.where("v is not null").collect():
        held.setdefault(r.g, []).append(r.v)
    for sliver in (quantiles.SLIVER_ROWS, 100):
        made = cells.groupBy("g").agg(F.sum("_n").alias("_n"), quantiles.merged(F.col("_sketch")).alias("_sketch"))
        rows = df.select("g", F.col("v").alias("_v")).where("_v is not null")
        got = quantiles.bracketed_quantiles(rows, ["g"], probs, ["a", "b", "c"], sliver_rows=sliver,
                                            sketch=quantiles.sketch_brackets(made, ["g"], probs)).collect()
        assert {r.g for r in got} == set(held)
        for r in got:
            assert [r.a, r.b, r.c] == pytest.approx(np.quantile(held[r.g], probs).tolist()) and r.n == len(held[r.g])


def test_nan_goes_the_other_way(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", float("nan")), ("y", None), ("y", 2.0)], "g string, v double")
    made = df.groupBy("g").agg(F.count("v").alias("_n"), quantiles.sketch_of(F.col("v")).alias("_sketch"))
    assert quantiles.sketch_brackets(made, ["g"], [0.5]) is None
    assert [tuple(r)[:2] for r in quantiles.sketch_brackets(made.where("g = 'y'"), ["g"], [0.5]).collect()] == [("y", 1)]
    assert quantiles.sketch_brackets(made.where("g = 'none'"), ["g"], [0.5]).count() == 0
