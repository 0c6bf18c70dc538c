"""Tree baseline on flattened samples, expanding-window folds and permutation importance."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longspan.config import PanelSpec
from longspan.functions.columns import col
from longspan.operators.ordering import POS, ROWS
from longspan.session import pin


def expanding_folds(df: DataFrame, spec: PanelSpec, folds: int = 5) -> DataFrame:
    """Each row once per fold it takes part in: the first ``fold`` of ``folds + 1`` equal parts train, the next validates."""
    part = F.floor((F.col(POS) - 1) * (folds + 1) / F.col(ROWS))
    uses = F.transform(F.sequence(F.greatest(part, F.lit(1)), F.lit(folds).cast("bigint")), lambda f: F.struct(
        f.alias("fold"), F.when(part < f, "train").otherwise("validate").alias("role")))
    return df.select("*", F.inline(uses))


def fold_scores(folds: DataFrame, actual: str, fit: Callable[[DataFrame], Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """``fold, n_train, n_validate, rmse, mae``: one fit per fold on its training rows, scored on its validation rows.

    ``fit`` takes training rows and returns a function that appends ``prediction``. ``folds`` has a row's ``fold`` and ``role``.
    """
    folds = pin(folds)
    numbers = [r["fold"] for r in folds.select("fold").distinct().orderBy("fold").collect()]  # a row per fold
    out = None
    for number in numbers:
        train, held = (folds.where((F.col("fold") == number) & (F.col("role") == role)) for role in ("train", "validate"))
        error = F.col("prediction") - col(actual)
        scored = fit(train)(held).agg(F.count("*").alias("n_validate"), F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"))
        one = train.agg(F.count("*").alias("n_train")).crossJoin(scored)  # one row each
        one = one.select(F.lit(number).cast("bigint").alias("fold"), "n_train", "n_validate", "rmse", "mae")
        out = one if out is None else out.unionByName(one)
    return out


# The baseline's rounds, depth, step, shares of rows and columns, and the rounds it waits for a better one.
ROUNDS, DEPTH, STEP, ROW_SHARE, COLUMN_SHARE, PATIENCE = 300, 6, 0.03, 0.8, 0.8, 20
#: Rounds of the first fit; each further fit has twice as many.
FIRST_ROUNDS = 24


@dataclass(frozen=True)
class Prefix:
    """Rounds to keep, and whether no more are needed to know that."""

    rounds: int
    decided: bool


def best_prefix(errors: list[float], patience: int = PATIENCE) -> Prefix:
    """The best round before the first run of ``patience`` rounds without a better one; undecided if there is no such run."""
    best = 0
    for at, error in enumerate(errors):
        if error < errors[best]:
            best = at
        elif at - best >= patience:
            return Prefix(best + 1, True)
    return Prefix(best + 1, False)


def _first_trees(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model with its first trees only."""
    if rounds >= model.getNumTrees:
        return model
    gateway = SparkContext._active_spark_context._gateway
    names, kept = gateway.jvm.org.apache.spark.ml.regression, model._java_obj.trees()
    trees = gateway.new_array(names.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for i, w in enumerate(model.treeWeights[:rounds]):
        trees[i], weights[i] = kept[i], w
    return GBTRegressionModel(names.GBTRegressionModel(model.uid, trees, weights))


def fit_boosted_trees(
    samples: DataFrame, rounds: int = ROUNDS, depth: int = DEPTH, step: float = STEP, patience: int = PATIENCE, seed: int = 42,
    first_rounds: int = FIRST_ROUNDS, label: Column | None = None,
) -> GBTRegressionModel:
    """Boosted regression trees on the ``flat`` array of training samples, as many as the ``val`` samples want.

    All trees up to the best round are kept that no later ``patience`` rounds beat on ``val``; ``rounds`` at the latest, and
    all of them where there is no ``val``. Trees don't depend on how many follow, so a short fit decides most cases and a longer one
    starts with the same trees.
    """
    y = F.col("y") if label is None else label
    data = pin(samples.select("split", array_to_vector("flat").alias("features"), y.cast("double").alias("label")).where("split IN ('train', 'val')"))
    train, held = data.where("split = 'train'"), data.where("split = 'val'")
    trees = GBTRegressor(maxDepth=depth, stepSize=step, seed=seed, subsamplingRate=ROW_SHARE, featureSubsetStrategy=str(COLUMN_SHARE))
    some, watched = rounds, bool(held.limit(1).count())
    if watched:
        some = min(rounds, max(first_rounds, patience + 1))
    while True:
        model = trees.fit(train, {trees.maxIter: some})
        if not watched:
            return model
        prefix = best_prefix(model.evaluateEachIteration(held, "squared"), patience)
        if prefix.decided or some >= rounds:
            return _first_trees(model, prefix.rounds)
        some = min(rounds, 2 * some)


def predict(model: GBTRegressionModel, samples: DataFrame) -> DataFrame:
    return model.transform(samples.withColumn("features", array_to_vector("flat"))).drop("features")


def used_features(model: GBTRegressionModel, features: list[str], steps: int, summary_of: list[str], span: int) -> list[bool]:
    """Whether the trees split on any step of each feature of a flattened window, or on its ``span`` places of the summary.

    A model cut to its first trees tells importances up to the last feature that they split on only, so places are looked up by index.
    """
    split_on = set(model.featureImportances.indices.tolist())

    def places(at: int, name: str) -> list[int]:
        own = [s * len(features) + at for s in range(steps)]
        after = steps * len(features)
        return own + [after + k * span + i for k, n in enumerate(summary_of) if n == name for i in range(span)]

    return [not split_on.isdisjoint(places(at, name)) for at, name in enumerate(features)]


GROUP_ROWS = 100_000  # rows that one task orders


def group_count(df: DataFrame, group_rows: int = GROUP_ROWS) -> int:
    """Groups that keep a group at about ``group_rows`` rows, whatever the table's size."""
    return max(1, -(-df.count() // group_rows))


def _in_digest_order(df: DataFrame, key: list[str], names: list[str], groups: int, note: list[str]) -> DataFrame:
    """Add ``_moved``, the columns of the next row in the order of a digest of the key within digest groups.

    No global numbering is needed; the last row of a group gets the values of its first.
    """
    mixed = F.md5(F.concat_ws("|", *[col(k).cast("string") for k in key], *[F.lit(n) for n in note]).cast("binary"))
    group = F.pmod(F.conv(F.substring("_m", 1, 8), 16, 10).cast("bigint"), F.lit(groups))
    rows = df.withColumn("_m", mixed).withColumn("_g", group)
    in_group = Window.partitionBy("_g").orderBy("_m", *[col(k) for k in key])
    both = F.struct(*[col(n).alias(f"c{i}") for i, n in enumerate(names)])
    first = F.first(both).over(in_group.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("_moved", F.coalesce(F.lead(both, 1).over(in_group), first)).drop("_g", "_m")


def permuted(df: DataFrame, key: list[str], names: list[str], groups: int) -> DataFrame:
    """Replace columns by those of another row, the next in the order of a digest of the key. The columns move together."""
    moved = _in_digest_order(df, key, names, groups, [",".join(names)])
    return moved.withColumns({n: F.col(f"_moved.c{i}") for i, n in enumerate(names)}).drop("_moved")


def permutation_importance(
    df: DataFrame, key: list[str], inputs: dict[str, list[str]], forecast, actual: str, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Rise of the RMSE when the columns of one input are shuffled; ``forecast`` appends ``prediction``."""
    groups = group_count(df, group_rows)

    def rmse(frame: DataFrame, label: str) -> DataFrame:
        err = F.col("prediction") - col(actual)
        return forecast(frame).agg(F.sqrt(F.avg(err * err)).alias("rmse")).select(F.lit(label).alias("column"), "rmse")

    out = rmse(df, "")
    for name, columns in inputs.items():
        out = out.unionByName(rmse(permuted(df, key, columns, groups), name))
    base = F.max(F.when(F.col("column") == "", F.col("rmse"))).over(Window.partitionBy(F.lit(0)))  # a row per input
    return out.withColumn("increase", F.col("rmse") - base).where("column <> ''")


DONOR_ROWS = 4096  # windows that one task orders; each holds its whole input


def window_importance(
    windows: DataFrame, key: list[str], features: list[str], forecast, actual: str = "y", used: list[bool] | None = None,
    summary_of: list[str] | None = None, group_rows: int = DONOR_ROWS,
) -> DataFrame:
    """``feature, rmse, increase`` of every feature of look-back windows, when all its steps come from another window.

    One shuffle gives each window one donor, the next in the order of a digest of its key. A window is then repeated in its
    task, once as it is and once for each feature, with that feature's steps (and its part of ``summary``, named by
    ``summary_of``) taken from the donor. ``forecast`` appends ``prediction`` to rows with ``x`` and, if there, ``summary``. Features
    that ``used`` denies are not forecast: they add exactly nothing.
    """
    summary_of = summary_of or []
    moving = ["x", "summary"] if summary_of else ["x"]
    rows = windows.select(*[col(k) for k in key], col(actual).cast("double").alias("_actual"), *[c for c in ("x", "summary") if c in windows.columns])
    rows = _in_digest_order(rows, key, moving, group_count(rows, group_rows), [])
    tried = [i for i in range(len(features)) if used is None or used[i]]
    rows = rows.withColumn("_f", F.explode(F.array(*[F.lit(i) for i in [-1, *tried]])))
    f, other = F.col("_f"), F.col("_moved.c0")

    def patched(step: Column, at: Column) -> Column:
        return F.concat(F.slice(step, F.lit(1), f), F.slice(F.get(other, at), f + 1, F.lit(1)), F.slice(step, f + 2, F.lit(len(features))))

    changed = {"x": F.when(f < 0, F.col("x")).otherwise(F.transform("x", patched))}
    if summary_of:
        place = F.get(F.array(*[F.lit(summary_of.index(n) if n in summary_of else None).cast("int") for n in features]), f)
        span = F.size("summary") / len(summary_of)
        changed["summary"] = F.when((f < 0) | place.isNull(), F.col("summary")).otherwise(F.concat(
            F.slice("summary", F.lit(1), (place * span).cast("int")), F.slice(F.col("_moved.c1"), (place * span + 1).cast("int"), span.cast("int")),
            F.slice("summary", ((place + 1) * span + 1).cast("int"), F.size("summary"))))
    error = F.col("prediction") - F.col("_actual")
    scored = forecast(rows.withColumns(changed).drop("_moved")).groupBy("_f").agg(F.sqrt(F.avg(error * error)).alias("rmse"))
    scored = pin(scored)  # a row per feature
    names = windows.sparkSession.createDataFrame(list(enumerate(features)), "_f int, feature string")
    base = scored.where("_f = -1").select(F.col("rmse").alias("_base"))  # one row
    out = names.join(scored, "_f", "left").crossJoin(base)
    return out.select("feature", F.coalesce("rmse", "_base").alias("rmse"), F.coalesce(F.col("rmse") - F.col("_base"), F.lit(0.0)).alias("increase"))
