"""Whole reports, checked against the union of their sections."""

from pyspark.sql import functions as F

from longspan.operators import explore, profile, validate
from longspan.session import pin
from registry import sql
from registry.core import MEASURES, NUMERIC, ORACLES, SPEC, clean_raw, panel, query
from registry.validation import CHECKS

_DIGITS = 6
_SECTION_DIGITS = {"measure_summaries": 4, "target_summary": 4, "yearly": 4, "monthly": 4}  # as these sections' own checks round


def _section(name: str, source: str, keys: list[str], numbers: list[str], texts: list[str] = ()) -> str:
    """A summary query in long form: numbers rounded, texts as they are."""
    key = " || '|' || ".join(f'CAST("{k}" AS VARCHAR)' for k in keys) or "''"
    cells = [(m, f'(round(CAST("{m}" AS DOUBLE), {_SECTION_DIGITS.get(name, _DIGITS)}) + 0.0)', "NULL") for m in numbers] + [(m, "NULL", f'CAST("{m}" AS VARCHAR)') for m in texts]
    return sql.union(f"SELECT '{name}' AS section, {key} AS key, '{m}' AS metric, CAST({n} AS DOUBLE) AS number, CAST({t} AS VARCHAR) AS text FROM {source}"
                     for m, n, t in cells)


def _long(report):
    """Numbers rounded and texts apart, as the SQL has them. A report may leave out what is null."""
    number = F.expr("try_cast(value AS DOUBLE)")
    coarse = F.col("section").isin(*_SECTION_DIGITS)
    rounded = F.when(coarse, F.round(number, 4)).otherwise(F.round(number, _DIGITS))
    number = F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)
    return report.select("section", "key", "metric", number.alias("number"), F.when(number.isNull(), F.col("value")).alias("text"))


def _table(name: str, alias: str) -> str:
    return f"{alias} AS ({ORACLES[name]})"


_STATS, _QUARTILES = ["n", "mean", "std", "min", "max"], ["p5", "p25", "median", "p75", "p95", "p99"]
_PERIOD = ["n", "mean", "median", "std", "min", "max"]
_EXPLORED = [
    ("E1_overview", "dataset_overview", [], ["n_rows", "n_columns", "n_entities", "span_days"], ["min_date", "max_date"]),
    ("E1_rows_per_entity", "rows_per_entity", ["entity"], ["n_rows"], []),
    ("E2_missing_by_column", "missing_values", ["column"], ["n_missing", "pct_missing"], []),
    ("E3_missing_by_entity", "missing_by_entity", ["entity", "column"], ["pct_missing"], []),
    ("E4_duplicates", "duplicates", ["kind"], ["n_duplicates"], []),
    ("E5_outlier_audit", "outliers", ["column"], ["n_valid", "q25", "q75", "iqr", "lower", "upper", "n_outliers", "pct_outliers"], []),
    ("E6_entity_statistics", "entity_statistics", ["entity"], ["n_rows", "n_valid", "n_missing", "mean", "median", "std", "min", "max"], []),
    ("E7_distributions", "measure_summaries", ["column"], [*_STATS, "skewness", *_QUARTILES], []),
    ("E8_target_summary", "target_summary", [], [*_STATS, "skewness", *_QUARTILES, "p90", "n_missing", "iqr"], []),
    ("P7_category_counts", "category_distribution", ["category"], ["n"], []),
    ("E9_yearly", "yearly", ["year"], _PERIOD, []),
    ("E10_monthly", "monthly", ["month"], _PERIOD, []),
    ("E11_pearson_matrix", "pearson", ["x", "y"], ["r"], []),
    ("E12_spearman_matrix", "spearman", ["x", "y"], ["rho"], []),
    ("E13_target_correlations", "target_correlations", ["column"], ["pearson_r", "n_pairs", "spearman_rho"], []),
]


@query("E14_explore_report", "WITH " + ",\n".join(_table(n, f"t{i}") for i, (n, *_) in enumerate(_EXPLORED)) + "\n" + sql.union(
    _section(name, f"t{i}", keys, numbers, texts) for i, (_, name, keys, numbers, texts) in enumerate(_EXPLORED)))
def explore_report(spark, sf):
    return _long(explore.explore_report(panel(spark, sf), SPEC))


_TYPES = {"entity": "string", "d": "date", **{c: "double" for c in NUMERIC}, "bucket": "string"}
_SUMMARY = sql.union(f"""SELECT '{c}' AS "column", count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min, max({c}) AS max,
  quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75 FROM finite""" for c in NUMERIC)
_AVAILABLE = "count(*) AS n_total, count({c}) AS n_valid, count(*) - count({c}) AS n_missing, 100.0::DOUBLE * count({c}) / count(*) AS pct_available FROM typed"
_PROFILE = sql.TYPED + f""",
finite AS (SELECT * FROM typed),
shape AS (SELECT count(*) AS row_count, CAST(16 AS BIGINT) AS column_count FROM typed),
kinds AS ({sql.union(f"""SELECT '{c}' AS "column", {i} AS position, '{t}' AS data_type""" for i, (c, t) in enumerate(_TYPES.items()))}),
geography AS (SELECT count(DISTINCT entity) AS entity_count FROM typed),
listed AS (SELECT DISTINCT entity, entity AS name FROM typed WHERE entity IS NOT NULL),
span AS (SELECT min(d) AS min_date, max(d) AS max_date, max(d) - min(d) + 1 AS span_days FROM typed),
missing AS ({sql.union(f"""SELECT '{c}' AS "column", count(*) - count({c}) AS n_missing, 100.0::DOUBLE * (count(*) - count({c})) / count(*) AS pct_missing FROM typed""" for c in _TYPES)}),
target_known AS (SELECT {_AVAILABLE.format(c='target')}),
measures AS ({sql.union(f"""SELECT '{c}' AS "column", {_AVAILABLE.format(c=c)}""" for c in MEASURES)}),
numbers AS ({_SUMMARY}),
categories AS (SELECT coalesce(bucket, 'Missing') AS category, count(*) AS n FROM typed GROUP BY 1),
entities AS (SELECT entity, count(*) AS n_rows, min(d) AS min_date, max(d) AS max_date, count(target) AS n_valid, count(*) - count(target) AS n_missing,
  100.0::DOUBLE * count(target) / count(*) AS pct_available FROM typed WHERE entity IS NOT NULL GROUP BY entity),
checks AS ({sql.union(CHECKS)}),
verdict AS (SELECT 'false' AS is_valid, (SELECT count(*) FROM raw) AS row_count, 16 AS column_count,
  count(*) FILTER (WHERE severity = 'error' AND n > 0) AS error_count, count(*) FILTER (WHERE severity = 'warning' AND n > 0) AS warning_count FROM checks),
unexpected AS (SELECT {sql.strip('bucket')} AS value, count(*) AS n FROM raw
  WHERE {sql.strip('bucket')} NOT IN ('Good', 'Satisfactory', 'Moderate', 'Poor', 'Very Poor', 'Severe') GROUP BY 1),
source AS (SELECT 'raw' AS name, CAST(7 AS BIGINT) AS size_bytes)"""
_PROFILED = [
    ("dataset_shape", "shape", [], ["row_count", "column_count"], []), ("columns", "kinds", ["column"], ["position"], ["data_type"]),
    ("geography", "geography", [], ["entity_count"], []), ("entities", "listed", ["entity"], [], ["name"]), ("temporal_span", "span", [], ["span_days"], ["min_date", "max_date"]),
    ("missing_values", "missing", ["column"], ["n_missing", "pct_missing"], []),
    ("target_availability", "target_known", [], ["n_total", "n_valid", "n_missing", "pct_available"], []),
    ("measure_availability", "measures", ["column"], ["n_total", "n_valid", "n_missing", "pct_available"], []),
    ("numeric_summary", "numbers", ["column"], ["n", "min", "max", "p25", "p50", "p75"], []),
    ("category_distribution", "categories", ["category"], ["n"], []),
    ("entity_profiles", "entities", ["entity"], ["n_rows", "n_valid", "n_missing", "pct_available"], ["min_date", "max_date"]),
    ("validation", "verdict", [], ["row_count", "column_count", "error_count", "warning_count"], ["is_valid"]),
    ("integrity_audit", "checks", ["check_name", "column"], ["n"], ["severity"]),
    ("unexpected_categories", "unexpected", ["value"], ["n"], []),
    ("source", "source", [], ["size_bytes"], ["name"]),
]


@query("P9_profile_report", sql.with_(_PROFILE, sql.union(_section(*x[:1], *x[1:]) for x in _PROFILED)))
def profile_report(spark, sf):
    """All but the free text: messages, the path, and mean and deviation where the planted infinity makes them infinite."""
    raw = pin(clean_raw(spark, sf))
    typed, outcome = validate.validate_raw(raw, SPEC)
    report = profile.profile_report(pin(typed), SPEC, outcome, profile.Source("somewhere/raw", 7))
    told = report.where("section NOT IN ('errors', 'warnings') AND NOT (section = 'source' AND metric = 'path')")
    return _long(told.where("NOT (section = 'numeric_summary' AND metric IN ('mean', 'std'))"))
