"""The test panel derived from the given tables, the shared stages, and the query register."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from longspan.config import FeatureConfig, PanelSpec
from longspan.operators import features, validate
from longspan.operators.catalogue import hazard_band
from longspan.plans import stages
from longspan.session import pin

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SPEC = PanelSpec(
    entity="entity", time="d",
    measures=("qty_a", "price_a", "disc_a", "tax_a", "qty_n", "price_n", "disc_n", "tax_n", "qty_r", "price_r", "disc_r", "tax_r"),
    target="target", category="bucket", valid_flag="target_valid",
)
FEATURES = FeatureConfig.of(
    lags=("qty_a", "price_a", "qty_n", "target"), rolling=("qty_a", "price_a", "qty_n", "target"),
    change=("qty_a", "price_a", "qty_n", "disc_a", "target"), volatility=("qty_a", "price_a", "target"),
)
MEASURES, NUMERIC = list(SPEC.measures), SPEC.numeric


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its check."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Rounded doubles, text dates and 64-bit integers, so that two engines can be compared value by value."""
    def one(f: T.StructField):
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            r = F.round(c.cast("double"), digits)
            return F.when(r == 0, F.lit(0.0)).otherwise(r).alias(f.name)
        if isinstance(f.dataType, (T.DateType,)):
            return c.cast("string").alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return c.cast("bigint").alias(f.name)
        return c
    return df.select(*[one(f) for f in df.schema])


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _keyed_panel(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    lines = lines.join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    sources = {"qty": (F.sum, "l_quantity"), "price": (F.max, "l_extendedprice"), "disc": (F.max, "l_discount"), "tax": (F.max, "l_tax")}
    cells = [
        fn(F.when(F.col("l_returnflag") == flag.upper(), F.col(c))).alias(f"{m}_{flag}")
        for flag in "anr" for m, (fn, c) in sources.items()
    ]
    target = (F.max(F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))) * 10).alias("target")
    return lines.groupBy(F.col("n_name").alias("entity"), F.to_date("l_shipdate").alias("d")).agg(
        *cells, target, F.max("n_nationkey").alias("nk")
    ).withColumn("bucket", hazard_band(F.col("target")))


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """One row per (supplier nation, ship day): twelve measures with natural gaps, a target and its band."""
    return _keyed_panel(spark, sf).select(*SPEC.required)


def raw_panel(spark: SparkSession, sf: str) -> DataFrame:
    """The panel as text with planted faults, chosen by arithmetic on the key."""
    src = _keyed_panel(spark, sf).withColumn("code", F.unix_date("d") * 25 + F.col("nk"))
    text = src.select("code", *[F.col(c).cast("string").alias(c) for c in SPEC.required])

    def hit(n: int):
        return F.col("code") % n == 0

    faulty = text.select(
        "code",
        F.when(hit(521), F.concat(F.lit("\t "), F.col("entity"), F.lit("  "))).otherwise(F.col("entity")).alias("entity"),
        F.when(hit(997), "bad-date").when(hit(991), "2020-02-30").otherwise(F.col("d")).alias("d"),
        *[{
            "qty_a": F.when(hit(499), "not_a_number").when(hit(503), "-15.0").otherwise(F.col("qty_a")),
            "price_n": F.when(hit(509), "NA").otherwise(F.col("price_n")),
            "tax_r": F.when(hit(541), "inf").otherwise(F.col("tax_r")),
        }.get(c, F.col(c)).alias(c) for c in NUMERIC],
        F.when(hit(523), "Unknown").otherwise(F.col("bucket")).alias("bucket"),
    )
    again = faulty.where(hit(1009))
    rekeyed = faulty.where(hit(1013)).withColumn("qty_a", F.lit("1"))
    return faulty.unionByName(again).unionByName(rekeyed).drop("code")


def clean_raw(spark: SparkSession, sf: str) -> DataFrame:
    return validate.clean_nulls(raw_panel(spark, sf))


_stages: dict[tuple, object] = {}


def once(spark: SparkSession, sf: str, name: str, build):
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _stages:
        _stages[key] = build()
    return _stages[key]


def filled(spark: SparkSession, sf: str) -> DataFrame:
    """Split and forward-filled panel, pinned once per session because many queries start from it."""
    return once(spark, sf, "filled", lambda: pin(stages.split_and_fill(panel(spark, sf), SPEC)))


def prepared(spark: SparkSession, sf: str) -> stages.Prepared:
    """Imputed and scaled panel with its fitted parameters."""
    return once(spark, sf, "prepared", lambda: stages.impute_and_scale(filled(spark, sf), SPEC))


def engineered(spark: SparkSession, sf: str) -> DataFrame:
    """All features, unscaled, pinned."""
    return once(spark, sf, "engineered", lambda: pin(features.engineer(prepared(spark, sf).table, SPEC, FEATURES)))


def model_ready(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """Scaled features, positions and targets, with the ordered feature names."""
    def build():
        raw = engineered(spark, sf)
        params = features.fit_feature_scaler(raw, SPEC, FEATURES)
        scaled = features.scale_engineered(raw, SPEC, FEATURES, params)
        return scaled, features.model_features(SPEC, FEATURES, scaled.columns)
    return once(spark, sf, "model_ready", build)
