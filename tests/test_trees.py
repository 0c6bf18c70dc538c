"""Patience of the tree baseline, and fits per fold."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from longspan.operators import baseline


@pytest.mark.parametrize("errors,patience,rounds,decided", [
    ([5, 4, 3, 3.5, 3.2, 2.5, 2.6, 2.7, 2.8], 3, 6, True),    # rises for two rounds and falls again: not ended by the first rise
    ([5, 4, 3, 3.5, 3.6, 3.7, 1.0], 3, 3, True),              # three rounds without a better one: what comes later is not seen
    ([5, 4, 3, 3.5, 3.6], 3, 3, False),
    ([3, 3, 3, 3], 3, 1, True),                               # an equal round is no better one
    ([1.0], 20, 1, False),
])
def test_best_prefix(errors, patience, rounds, decided):
    assert baseline.best_prefix(errors, patience) == baseline.Prefix(rounds, decided)


def samples(spark, n=300):
    random = np.random.default_rng(5)
    x = random.integers(0, 2, size=(n, 4)).astype(float)
    y = 10 * x[:, 0] + 3 * x[:, 2]
    split = np.where(np.arange(n) % 5 == 0, "val", np.where(np.arange(n) % 5 == 1, "test", "train"))
    return spark.createDataFrame([(k, str(s), [float(v) for v in a], float(b)) for k, (s, a, b) in enumerate(zip(split, x, y))],
                                 "id int, split string, flat array<double>, y double")


def forecasts(model, df):
    return [r.prediction for r in baseline.predict(model, df).orderBy("id").collect()]


def test_forecasts_of_a_learnable_target(spark):
    df = samples(spark)
    model = baseline.fit_boosted_trees(df, rounds=30, depth=2, step=0.5)
    test = df.where("split = 'test'")
    assert forecasts(model, test) == pytest.approx([r.y for r in test.orderBy("id").collect()], abs=0.05)


def test_kept_trees_are_the_first_of_a_longer_fit(spark):
    """The held-out target is noise, so few rounds are kept; refitting with just these rounds gives the same forecasts."""
    df = samples(spark).withColumn("y", F.when(F.col("split") == "val", F.pmod(F.col("id") * 7, F.lit(11)) - 30).otherwise(F.col("y")))
    model = baseline.fit_boosted_trees(df, rounds=12, depth=2, step=0.3, patience=3, first_rounds=4)
    kept = model.getNumTrees
    errors = model.evaluateEachIteration(df.where("split = 'val'").select(
        baseline.array_to_vector("flat").alias("features"), F.col("y").alias("label")), "squared")
    assert kept < 12 and min(errors) == errors[-1]
    again = baseline.fit_boosted_trees(df.where("split = 'train'"), rounds=kept, depth=2, step=0.3)
    assert again.getNumTrees == kept and forecasts(model, df) == pytest.approx(forecasts(again, df))


def test_a_fit_per_fold(spark):
    rows = [(f, role, float(k), float(k) * f) for f in (1, 2, 3) for role, n in (("train", 4 * f), ("validate", 3)) for k in range(n)]
    folds = spark.createDataFrame(rows, "fold bigint, role string, v double, y double")
    seen = []

    def fit(train):
        seen.append(train.count())
        top = train.agg(F.max("y")).first()[0]
        return lambda rows: rows.withColumn("prediction", F.lit(top))

    got = [(r.fold, r.n_train, r.n_validate, round(r.mae, 6)) for r in baseline.fold_scores(folds, "y", fit).orderBy("fold").collect()]
    assert seen == [4, 8, 12]
    assert got == [(f, 4 * f, 3, round(sum(abs((4 * f - 1) * f - k * f) for k in range(3)) / 3, 6)) for f in (1, 2, 3)]
