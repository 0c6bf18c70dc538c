"""Dataset profile: spans, availability and summaries of a typed panel."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from longspan.config import PanelSpec
from longspan.functions.columns import col, column_stats, per_column, percent
from longspan.functions.quantiles import stats_and_quantiles
from longspan.functions.stats import sample_std
from longspan.operators.validate import Outcome
from longspan.session import pin


def temporal_span(df: DataFrame, spec: PanelSpec) -> DataFrame:
    t = col(spec.time)
    return df.agg(F.min(t).alias("min_date"), F.max(t).alias("max_date")).withColumn(
        "span_days", F.coalesce(F.date_diff("max_date", "min_date") + 1, F.lit(0))
    )


def distinct_entities(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.select(col(spec.entity)).where(col(spec.entity).isNotNull()).distinct()


def missing_by_column(df: DataFrame) -> DataFrame:
    return per_column(df, df.columns, {
        "n_missing": lambda c: F.count_if(col(c).isNull()),
        "pct_missing": lambda c: percent(F.count_if(col(c).isNull()), F.count("*")),
    })


def target_availability(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return availability(df, [spec.target]).drop("column")


def availability(df: DataFrame, columns: list[str]) -> DataFrame:
    return per_column(df, columns, {
        "n_total": lambda c: F.count("*"),
        "n_valid": lambda c: F.count(col(c)),
        "n_missing": lambda c: F.count_if(col(c).isNull()),
        "pct_available": lambda c: percent(F.count(col(c)), F.count("*")),
    })


def basic_stats() -> dict[str, Column]:
    v = F.col("value")
    return {"n": F.count(v), "mean": F.avg(v), "std": sample_std(v), "min": F.min(v), "max": F.max(v)}


def numeric_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample std, min, quartiles and max; a column without values keeps its row with nulls."""
    return stats_and_quantiles(df, columns, basic_stats(), [0.25, 0.5, 0.75], ["p25", "p50", "p75"])


def category_counts(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.groupBy(F.coalesce(col(spec.category), F.lit("Missing")).alias("category")).agg(F.count("*").alias("n"))


def entity_profile(df: DataFrame, spec: PanelSpec) -> DataFrame:
    t, y = col(spec.time), col(spec.target)
    return df.where(col(spec.entity).isNotNull()).groupBy(col(spec.entity)).agg(
        F.count("*").alias("n_rows"), F.min(t).alias("min_date"), F.max(t).alias("max_date"),
        F.count(y).alias("n_valid"), F.count_if(y.isNull()).alias("n_missing"),
        percent(F.count(y), F.count("*")).alias("pct_available"),
    )


def long_form(df: DataFrame, section: str, keys: list[str]) -> DataFrame:
    """(section, key, metric, value) rows of a summary table."""
    metrics = [c for c in df.columns if c not in keys]
    key: Column = F.concat_ws("|", *[col(k).cast("string") for k in keys]) if keys else F.lit("")
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), col(m).cast("string").alias("value")) for m in metrics])
    return df.select(F.lit(section).alias("section"), key.alias("key"), F.inline(cells))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


@dataclass(frozen=True)
class Source:
    """Where a panel came from."""

    path: str
    size_bytes: int

    @property
    def name(self) -> str:
        return self.path.rstrip("/").rsplit("/", 1)[-1]


def _rows(spark: SparkSession, section: str, rows: list[tuple]) -> DataFrame:
    """Report rows that the driver knows: (key, metric, value)."""
    kind = "section string, key string, metric string, value string"
    return spark.createDataFrame([(section, k, m, None if v is None else str(v)) for k, m, v in rows], kind)


def outcome_report(spark: SparkSession, outcome: Outcome, source: Source | None = None) -> DataFrame:
    """What validation found, in long form: verdict, messages, every check with its severity, every unexpected category, and the source."""
    messages = [(f"{kind}s", [(f"{i + 1}", "message", m) for i, m in enumerate(outcome.fired(kind))]) for kind in ("error", "warning")]
    verdict = [("", "is_valid", str(outcome.is_valid).lower()), ("", "row_count", outcome.n_rows), ("", "column_count", outcome.n_columns),
               *[("", f"{name.removesuffix('s')}_count", len(rows)) for name, rows in messages]]
    audit = [(f"{c.check_name}|{c.column}", m, v) for c in outcome.checks for m, v in (("n", c.n), ("severity", c.severity))]
    origin = [("", "name", source.name), ("", "path", source.path), ("", "size_bytes", source.size_bytes)] if source else []
    parts = [("validation", verdict), *messages, ("integrity_audit", audit), ("source", origin)]
    found = [_rows(spark, name, rows) for name, rows in parts]
    if outcome.unexpected is not None:
        found.append(long_form(outcome.unexpected, "unexpected_categories", ["value"]))
    return union_all(found)


def _known_per_group(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Counts per (entity, category), from which all sections but the numeric summary follow."""
    t = col(spec.time)
    columns = [c for c in df.columns if c not in (spec.entity, spec.category)]
    return df.groupBy(col(spec.entity).alias("_e"), col(spec.category).alias("_c")).agg(
        F.count("*").alias("_n"), F.min(t).alias("_from"), F.max(t).alias("_to"), *[F.count(col(c)).alias(f"_k_{c}") for c in columns])


def profile_report(df: DataFrame, spec: PanelSpec, outcome: Outcome | None = None, source: Source | None = None) -> DataFrame:
    """The whole profile in long form, in three scans of the panel; ``outcome`` adds what validation found."""
    spark = df.sparkSession
    groups = pin(_known_per_group(df, spec))
    n = F.sum("_n")

    def known(c: str) -> Column:
        own = {spec.entity: "_e", spec.category: "_c"}
        return F.sum(F.when(F.col(own[c]).isNotNull(), F.col("_n"))) if c in own else F.sum(col(f"_k_{c}"))

    def per_name(columns: list[str], metrics: dict) -> DataFrame:
        wide = groups.agg(*[F.struct(F.lit(c).alias("column"), *[fn(c).alias(m) for m, fn in metrics.items()]).alias(f"_{i}")
                            for i, c in enumerate(columns)])
        return wide.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))])))

    def known_or_none(c: str) -> Column:
        return F.coalesce(known(c), F.lit(0))

    total = F.coalesce(n, F.lit(0))
    missing = {"n_missing": lambda c: total - known_or_none(c), "pct_missing": lambda c: percent(total - known_or_none(c), total)}
    available = {"n_total": lambda c: total, "n_valid": known_or_none, "n_missing": lambda c: total - known_or_none(c),
                 "pct_available": lambda c: percent(known_or_none(c), total)}
    shape = groups.agg(total.alias("row_count")).withColumn("column_count", F.lit(len(df.columns)))
    types = [(c, m, v) for i, (c, kind) in enumerate(df.dtypes) for m, v in (("position", i), ("data_type", kind))]
    span = groups.agg(F.min("_from").alias("min_date"), F.max("_to").alias("max_date")).withColumn(
        "span_days", F.coalesce(F.date_diff("max_date", "min_date") + 1, F.lit(0)))
    entities = groups.where("_e is not null").groupBy(F.col("_e").alias("entity")).agg(
        n.alias("n_rows"), F.min("_from").alias("min_date"), F.max("_to").alias("max_date"), known(spec.target).alias("n_valid"),
        (n - known(spec.target)).alias("n_missing"), percent(known(spec.target), n).alias("pct_available"))
    categories = groups.groupBy(F.coalesce("_c", F.lit("Missing")).alias("category")).agg(n.alias("n"))
    geography = groups.agg(F.count_distinct("_e").alias("entity_count"))
    listed = groups.where("_e is not null").select(F.col("_e").alias("entity")).distinct().withColumn("name", F.col("entity"))
    parts = [
        long_form(shape, "dataset_shape", []),
        _rows(spark, "columns", types),
        long_form(geography, "geography", []),
        long_form(listed, "entities", ["entity"]),
        long_form(span, "temporal_span", []),
        long_form(per_name(df.columns, missing), "missing_values", ["column"]),
        long_form(per_name([spec.target], available).drop("column"), "target_availability", []),
        long_form(per_name(list(spec.measures), available), "measure_availability", ["column"]),
        long_form(numeric_summary(df, spec.numeric), "numeric_summary", ["column"]),
        long_form(categories, "category_distribution", ["category"]),
        long_form(entities, "entity_profiles", ["entity"]),
    ]
    if outcome is not None:
        parts.append(outcome_report(spark, outcome, source))
    return union_all(parts)
