"""Permutation importance of all features, from one donor per window."""

import math

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from longspan.operators import baseline
from registry import QUERIES, modelling
from registry.core import model_ready


def test_every_feature_has_its_importance(spark, sf):
    rows = {r.feature: r for r in QUERIES["B27_tree_importance_by_feature"](spark, sf).collect()}
    names = model_ready(spark, sf)[1]
    assert len(names) > 12 and set(rows) == set(names)
    assert all(math.isfinite(r.rmse) and math.isfinite(r.increase) for r in rows.values())
    assert any(abs(r.increase) > 1e-9 for r in rows.values())


def windows_of(spark, n):
    rows = [(k, [[float(k), float(-k), 1.0], [float(2 * k), float(k % 5), 2.0]], [float(k), 0.5], float(k)) for k in range(n)]
    return spark.createDataFrame(rows, "id int, x array<array<float>>, summary array<double>, y double")


def total(df):
    step = F.transform("x", lambda s: F.aggregate(s, F.lit(0.0), lambda a, v: a + v.cast("double")))
    return df.withColumn("prediction", F.aggregate(step, F.lit(0.0), lambda a, v: a + v) + F.aggregate("summary", F.lit(0.0), lambda a, v: a + v))


def test_equals_replacing_one_feature_at_a_time(spark):
    import hashlib
    n, names = 40, ["a", "b", "c"]
    df = windows_of(spark, n)
    got = {r.feature: r for r in baseline.window_importance(df, ["id"], names, total, "y", summary_of=["c"], group_rows=7).collect()}
    rows = df.orderBy("id").collect()
    groups = -(-n // 7)
    digest = [hashlib.md5(str(k).encode()).hexdigest() for k in range(n)]
    order = {}
    for k in range(n):
        order.setdefault(int(digest[k][:8], 16) % groups, []).append(k)
    donor = {}
    for members in order.values():
        members.sort(key=lambda k: digest[k])
        donor |= {k: members[(i + 1) % len(members)] for i, k in enumerate(members)}

    def rmse(feature):
        errors = []
        for r in rows:
            d = rows[donor[r.id]]
            x = [[d.x[s][f] if f == feature else v for f, v in enumerate(step)] for s, step in enumerate(r.x)]
            summary = d.summary if feature == 2 else r.summary
            errors.append(sum(map(sum, x)) + sum(summary) - r.y)
        return math.sqrt(sum(e * e for e in errors) / n)

    for f, name in enumerate(names):
        assert math.isclose(got[name].rmse, rmse(f), rel_tol=1e-9)
        assert math.isclose(got[name].increase, rmse(f) - rmse(None), rel_tol=1e-7, abs_tol=1e-9)


def test_unused_features_are_not_forecast_and_add_nothing(spark):
    got = {r.feature: r.increase for r in baseline.window_importance(
        windows_of(spark, 30), ["id"], ["a", "b", "c"], total, "y", used=[True, False, False]).collect()}
    assert got["b"] == 0.0 and got["c"] == 0.0 and got["a"] != 0.0


def test_one_shuffle_of_inputs(spark):
    """Whatever the number of features, the windows' inputs move once."""
    rows = baseline._in_digest_order(windows_of(spark, 10), ["id"], ["x", "summary"], 3, [])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_trees_that_leave_the_last_features_alone(spark, sf, monkeypatch):
    """A model cut to its first trees; the highest place that they split on is a single step of one feature, or within the summary."""
    samples, names = modelling._flat(spark, sf), model_ready(spark, sf)[1]
    width = 30 * len(names) + len(modelling._SUMMARIES)
    extreme = 30 * len(names) + modelling._SUMMARIES.index("scaled_price_a_max_14")  # no step holds it
    for place, name in ((3 * len(names) + 5, names[5]), (extreme, "scaled_price_a")):
        rows = samples.where("split = 'train'").select(array_to_vector("flat").alias("features"), F.get("flat", F.lit(place)).alias("label"))
        model = baseline._first_trees(GBTRegressor(maxDepth=1, maxIter=2, subsamplingRate=1.0, featureSubsetStrategy="all", seed=1).fit(rows), 1)
        assert model.featureImportances.indices.tolist() == [place] and place < width - 1
        monkeypatch.setattr(modelling, "_trees", lambda spark, sf, model=model: (samples, model))
        rows = {r.feature: r.increase for r in QUERIES["B27_tree_importance_by_feature"](spark, sf).collect()}
        assert set(rows) == set(names) and {n for n, v in rows.items() if v != 0.0} == {name}
