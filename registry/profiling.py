"""The dataset profile."""

from longspan.operators import profile
from registry import sql
from registry.core import MEASURES, NUMERIC, SPEC, panel, query, tidy


@query("P1_temporal_span", sql.with_(sql.PANEL, f"""
SELECT {sql.day('min(d)', 'min_date')}, {sql.day('max(d)', 'max_date')}, CAST(max(d) - min(d) + 1 AS BIGINT) AS span_days FROM panel"""))
def temporal_span(spark, sf):
    return tidy(profile.temporal_span(panel(spark, sf), SPEC))


@query("P2_distinct_entities", sql.with_(sql.PANEL, "SELECT DISTINCT entity FROM panel"))
def distinct_entities(spark, sf):
    return profile.distinct_entities(panel(spark, sf), SPEC).orderBy("entity")


MISSING = sql.union(f"""SELECT '{c}' AS "column", count(*) - count({c}) AS n_missing,
    {sql.r(f'100.0::DOUBLE * (count(*) - count({c})) / count(*)', 'pct_missing')} FROM panel""" for c in SPEC.required)


@query("P3_missing_by_column", sql.with_(sql.PANEL, MISSING))
def missing_by_column(spark, sf):
    return tidy(profile.missing_by_column(panel(spark, sf)))


def _available(c: str, label: str = "") -> str:
    return f"""SELECT {label} count(*) AS n_total, count({c}) AS n_valid, count(*) - count({c}) AS n_missing,
    {sql.r(f'100.0::DOUBLE * count({c}) / count(*)', 'pct_available')} FROM panel"""


@query("P4_target_availability", sql.with_(sql.PANEL, _available("target")))
def target_availability(spark, sf):
    return tidy(profile.target_availability(panel(spark, sf), SPEC))


@query("P5_measure_availability", sql.with_(sql.PANEL, sql.union(_available(c, f"""'{c}' AS "column",""") for c in MEASURES)))
def measure_availability(spark, sf):
    return tidy(profile.availability(panel(spark, sf), MEASURES))


def summary(c: str, probs: dict[str, float], digits: int = 4, extra: str = "", source: str = "panel") -> str:
    q = ", ".join(sql.r(f"quantile_cont({c}, {p})", n, digits) for n, p in probs.items())
    return f"""SELECT '{c}' AS "column", count({c}) AS n, {sql.r(f'avg({c})', 'mean', digits)}, {sql.r(f'stddev_samp({c})', 'std', digits)},
    {sql.r(f'min({c})', 'min', digits)}, {sql.r(f'max({c})', 'max', digits)}, {extra} {q} FROM {source}"""


@query("P6_numeric_summary", sql.with_(sql.PANEL, sql.union(summary(c, {"p25": 0.25, "p50": 0.5, "p75": 0.75}) for c in NUMERIC)))
def numeric_summary(spark, sf):
    return tidy(profile.numeric_summary(panel(spark, sf), NUMERIC), 4)


@query("P7_category_counts", sql.with_(sql.PANEL, "SELECT coalesce(bucket, 'Missing') AS category, count(*) AS n FROM panel GROUP BY 1"))
def category_counts(spark, sf):
    return profile.category_counts(panel(spark, sf), SPEC)


@query("P8_entity_profile", sql.with_(sql.PANEL, f"""
SELECT entity, count(*) AS n_rows, {sql.day('min(d)', 'min_date')}, {sql.day('max(d)', 'max_date')}, count(target) AS n_valid,
       count(*) - count(target) AS n_missing, {sql.r('100.0::DOUBLE * count(target) / count(*)', 'pct_available')} FROM panel GROUP BY entity"""))
def entity_profile(spark, sf):
    return tidy(profile.entity_profile(panel(spark, sf), SPEC))

