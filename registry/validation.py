"""Validation and typing."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from longspan.functions.parsing import parse_date, parse_number, strip
from longspan.operators import validate
from longspan.session import scratch_path
from longspan.sources import files
from registry import sql
from registry.core import NUMERIC, SPEC, clean_raw, panel, query, tidy

_ALL = ", ".join(SPEC.required)


@query("V1_duplicate_rows", sql.with_(sql.RAW, f"""
SELECT CAST(sum(c - 1) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS c FROM raw GROUP BY {_ALL})"""))
def duplicate_rows(spark, sf):
    return validate.duplicate_rows(clean_raw(spark, sf))


@query("V2_duplicate_keys", sql.with_(sql.RAW, """
SELECT CAST(sum(c - 1) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS c FROM raw GROUP BY entity, d)"""))
def duplicate_keys(spark, sf):
    return validate.duplicate_keys(clean_raw(spark, sf), SPEC)


@query("V3_strip", sql.with_(sql.RAW, f"SELECT {sql.strip('entity')} AS entity, {sql.strip('bucket')} AS bucket, d, target FROM raw"))
def stripped(spark, sf):
    return clean_raw(spark, sf).select(strip(F.col("entity")).alias("entity"), strip(F.col("bucket")).alias("bucket"), "d", "target")


@query("V4_empty_keys", sql.with_(sql.RAW, f"""
SELECT count(*) FILTER (WHERE entity IS NULL OR {sql.strip('entity')} = '') AS n_empty FROM raw"""))
def empty_keys(spark, sf):
    return clean_raw(spark, sf).agg(F.count_if(validate.empty_key(F.col("entity"))).alias("n_empty"))


@query("V5_date_parse", sql.with_(sql.RAW, f"""
SELECT entity, d AS raw_text, CAST({sql.date('d')} AS VARCHAR) AS parsed, d IS NOT NULL AND ({sql.date('d')}) IS NULL AS invalid FROM raw"""))
def date_parse(spark, sf):
    d = F.col("d")
    return tidy(clean_raw(spark, sf).select(
        "entity", d.alias("raw_text"), parse_date(d).alias("parsed"), validate.bad_date(d).alias("invalid")))


@query("V5_date_samples", sql.with_(sql.RAW, f"SELECT d AS sample FROM raw WHERE d IS NOT NULL AND ({sql.date('d')}) IS NULL ORDER BY d LIMIT 5"))
def date_samples(spark, sf):
    return validate.invalid_date_samples(clean_raw(spark, sf), SPEC)


@query("V6_invalid_numbers", sql.with_(sql.RAW, sql.union(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NOT NULL AND ({sql.num(c)}) IS NULL) AS n_invalid FROM raw""" for c in NUMERIC)))
def invalid_numbers(spark, sf):
    return validate.strict_counts(clean_raw(spark, sf), SPEC).select("column", "n_invalid")


@query("V6_number_parse", sql.with_(sql.RAW, "SELECT entity, d, " + ", ".join(
    f"({sql.num(c)}) AS {c}" for c in NUMERIC) + " FROM raw"))
def number_parse(spark, sf):
    return clean_raw(spark, sf).select("entity", "d", *[parse_number(F.col(c)).alias(c) for c in NUMERIC])


@query("V7_negative_counts", sql.with_(sql.TYPED, sql.union(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} < 0) AS n_negative FROM typed""" for c in NUMERIC)))
def negative_counts(spark, sf):
    return validate.strict_counts(clean_raw(spark, sf), SPEC).select("column", "n_negative")


_DOMAIN = ", ".join(f"'{c}'" for c in SPEC.categories)


@query("V8_category_domain", sql.with_(sql.RAW, f"""
SELECT {sql.strip('bucket')} AS value, count(*) AS n FROM raw WHERE {sql.strip('bucket')} NOT IN ({_DOMAIN}) GROUP BY 1"""))
def category_domain(spark, sf):
    return validate.unexpected_categories(clean_raw(spark, sf), SPEC)


@query("V9_sorted", sql.with_(sql.TYPED, """
SELECT entity, CAST(d AS VARCHAR) AS d, rank() OVER (ORDER BY entity NULLS LAST, d NULLS LAST) AS place FROM typed"""))
def sorted_rows(spark, sf):
    """The place of each row's key in the stored order; rows with equal keys share the first place."""
    path = scratch_path(spark, "sorted")
    files.write_panel(validate.sorted_panel(validate.typed(clean_raw(spark, sf), SPEC), SPEC), path)
    rows = spark.read.parquet(path).select("entity", "d", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"))
    names = rows.groupBy("file").agg(F.count("*").alias("n"), F.min("at").alias("low"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    names = names.select("file", "low", before.alias("before"))  # one row per file of the sorted table
    placed = rows.join(names, "file").withColumn("place", F.col("before") + F.col("at") - F.col("low") + 1)
    same = Window.partitionBy("entity", "d")
    return tidy(placed.select("entity", "d", F.min("place").over(same).alias("place")))


CHECKS = [
    f"SELECT 'empty_entities' AS check_name, 'entity' AS \"column\", 'error' AS severity, count(*) FILTER (WHERE entity IS NULL OR {sql.strip('entity')} = '') AS n FROM raw",
    f"SELECT 'invalid_dates', 'd', 'error', count(*) FILTER (WHERE d IS NOT NULL AND ({sql.date('d')}) IS NULL) FROM raw",
    f"SELECT 'invalid_categories', 'bucket', 'warning', count(*) FILTER (WHERE {sql.strip('bucket')} NOT IN ({_DOMAIN})) FROM raw",
    f"SELECT 'duplicate_rows', '*', 'warning', CAST(sum(c - 1) AS BIGINT) FROM (SELECT count(*) AS c FROM raw GROUP BY {_ALL})",
    "SELECT 'duplicate_keys', 'entity,d', 'error', CAST(sum(c - 1) AS BIGINT) FROM (SELECT count(*) AS c FROM raw GROUP BY entity, d)",
]
CHECKS += [f"SELECT 'invalid_numbers', '{c}', 'error', count(*) FILTER (WHERE {c} IS NOT NULL AND ({sql.num(c)}) IS NULL) FROM raw" for c in NUMERIC]
CHECKS += [f"SELECT 'negative_values', '{c}', 'warning', count(*) FILTER (WHERE ({sql.num(c)}) < 0) FROM raw" for c in NUMERIC]


@query("V10_validation_report", sql.with_(sql.RAW, sql.union(CHECKS)))
def validation_report(spark, sf):
    return validate.check_counts(clean_raw(spark, sf), SPEC).drop("n_rows")


@query("V11_strict_validation", sql.with_(sql.PANEL, f"""
SELECT entity, {sql.day('d', 'd')}, target_valid, {', '.join(sql.r(c, c) for c in NUMERIC)} FROM (SELECT *, target IS NOT NULL AS target_valid FROM panel)"""))
def strict_validation(spark, sf):
    return tidy(validate.validate_strict(panel(spark, sf), SPEC).select("entity", "d", "target_valid", *NUMERIC))


@query("V12_infinite_counts", sql.with_(sql.TYPED, sql.union(
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE isinf({c})) AS n_infinite FROM typed""" for c in NUMERIC)))
def infinite_counts(spark, sf):
    return validate.strict_counts(clean_raw(spark, sf), SPEC).select("column", "n_infinite")


@query("V13_target_flag", sql.with_(sql.PANEL, f"SELECT entity, {sql.day('d', 'd')}, target IS NOT NULL AS target_valid FROM panel"))
def target_flag(spark, sf):
    return tidy(validate.flag_target(panel(spark, sf), SPEC).select("entity", "d", "target_valid"))


@query("V14_panel_summary", sql.with_(sql.PANEL, f"""
SELECT count(*) AS n_rows, count(DISTINCT entity) AS n_entities, {sql.day('min(d)', 'date_min')}, {sql.day('max(d)', 'date_max')},
       count(target) AS n_observed, count(*) - count(target) AS n_missing FROM panel"""))
def panel_summary(spark, sf):
    return tidy(validate.panel_summary(panel(spark, sf), SPEC))
