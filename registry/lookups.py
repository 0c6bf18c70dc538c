"""Bands, catalogue, snapshots, look-back pulls, fuzzy volatility and readiness."""

from pyspark.sql import functions as F

from longspan.config import BAND_COLOURS, BAND_LIMITS, PanelSpec
from longspan.operators import catalogue, fuzzy
from longspan.session import scratch_path
from longspan.sources import files, listing
from registry import sql
from registry.core import MEASURES, NUMERIC, SPEC, model_ready, panel, prepared, query, table, tidy

_COLOUR = "CASE " + " ".join(f"WHEN target <= {l} THEN '{c}'" for l, c in zip(BAND_LIMITS, BAND_COLOURS)) + f" WHEN target IS NOT NULL THEN '{BAND_COLOURS[-1]}' END"
INDICATORS = ["qty_a", "price_a", "qty_n"]


@query("B1_hazard_band", sql.with_(sql.PANEL, f"SELECT entity, {sql.day('d', 'd')}, {sql.r('target', 'target')}, {sql.band('target')} AS band, {_COLOUR} AS colour FROM panel"))
def hazard_band(spark, sf):
    t = F.col("target")
    return tidy(panel(spark, sf).select("entity", "d", "target", catalogue.hazard_band(t).alias("band"), catalogue.band_colour(t).alias("colour")))


@query("B2_entity_catalogue", sql.with_(sql.PANEL, f"""
SELECT entity, {sql.day('min(d)', 'data_start')}, {sql.day('max(d)', 'data_end')}, count(*) AS n_records,
  {sql.r('count(target)::DOUBLE / count(*)', 'completeness')} FROM panel GROUP BY entity"""))
def entity_catalogue(spark, sf):
    return tidy(catalogue.entity_catalogue(panel(spark, sf), SPEC))


@query("B3_latest_events", f"""
SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_id, event_type, {sql.r('"value"', '"value"')}
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1""")
def latest_events(spark, sf):
    out = catalogue.latest_rows(table(spark, sf, "events"), "user_id", "ts", ["event_id", "event_type", "value"])
    return tidy(out.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")))


@query("B3_latest_observation", sql.with_(sql.PANEL, f"""
SELECT entity, {sql.day('d', 'd')}, {sql.r('target', 'target')}, bucket, {', '.join(sql.r(m, m) for m in MEASURES)}
FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY d DESC) AS rn FROM panel) WHERE rn = 1"""))
def latest_observation(spark, sf):
    return tidy(catalogue.latest_rows(panel(spark, sf), "entity", "d", ["target", "bucket", *MEASURES]))


@query("B4_snapshot_as_of", f"""
SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, {sql.r('"value"', '"value"')}
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00') WHERE rn = 1""")
def snapshot_as_of(spark, sf):
    at = F.lit("2024-01-15 12:00:00").cast("timestamp")
    out = catalogue.snapshot(table(spark, sf, "events"), "user_id", "ts", ["value"], at)
    return tidy(out.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")))


@query("B4_snapshot_on_day", sql.with_(sql.PANEL, f"SELECT entity, {sql.day('d', 'd')}, {sql.r('target', 'target')}, bucket FROM panel WHERE d = DATE '1998-06-15'"))
def snapshot_on_day(spark, sf):
    at = F.lit("1998-06-15").cast("date")
    return tidy(catalogue.snapshot(panel(spark, sf), "entity", "d", ["target", "bucket"], at, exact=True))


_FOUND = """found AS MATERIALIZED (SELECT entity, d, count(*) OVER (PARTITION BY entity ORDER BY d RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS n_found FROM panel)"""


@query("B5_look_back_pull", sql.with_(sql.PANEL + ", " + _FOUND, f"SELECT entity, {sql.day('d', 'reference_date')}, n_found, n_found = 30 AS accepted FROM found"))
def look_back_pull(spark, sf):
    p = panel(spark, sf)
    return tidy(catalogue.lookback_pull(p.select("entity", F.col("d").alias("reference_date")), p, SPEC))


@query("B5_look_back_rows", sql.with_(sql.PANEL + ", " + _FOUND, f"""
SELECT f.entity, {sql.day('f.d', 'reference_date')}, count(*) AS n, count(p.target) AS n_target, {sql.r('sum(p.target)', 'target_sum')}
FROM found f JOIN panel p ON p.entity = f.entity AND p.d BETWEEN f.d - INTERVAL 29 DAYS AND f.d WHERE n_found = 30 GROUP BY f.entity, f.d"""))
def look_back_rows(spark, sf):
    p = panel(spark, sf)
    rows = catalogue.lookback_rows(p.select("entity", F.col("d").alias("reference_date")), p, SPEC)
    return tidy(rows.groupBy("entity", "reference_date").agg(
        F.count("*").alias("n"), F.count("target").alias("n_target"), F.sum("target").alias("target_sum")))


def _relative(c: str) -> str:
    prev = f"lag({c}) OVER (PARTITION BY entity ORDER BY d)"
    return f"({c} - {prev}) / ({prev} + 1e-3::DOUBLE)"


_FUZZY = sql.SCALED + f""",
roc AS (SELECT entity, d, pos, scaled_target, 0.5::DOUBLE * {_relative('qty_a')} + 0.3::DOUBLE * {_relative('price_a')} + 0.2::DOUBLE * {_relative('qty_n')} AS u FROM scaled),
sets AS (SELECT *, exp(-(u * u) / 0.02::DOUBLE) AS stable,
  CASE WHEN u IS NOT NULL THEN greatest(0.0::DOUBLE, least((u - 0.05::DOUBLE) / 0.10::DOUBLE, 1.0::DOUBLE, (0.45::DOUBLE - u) / 0.15::DOUBLE)) END AS moderate,
  1.0::DOUBLE / (1.0::DOUBLE + exp(least(-15.0::DOUBLE * (u - 0.35::DOUBLE), 700.0::DOUBLE + 0 * u))) AS surge FROM roc),
gammas AS MATERIALIZED (SELECT *, 1.0::DOUBLE + 0.5::DOUBLE * moderate + surge - 0.3::DOUBLE * stable AS gamma FROM sets)"""


def _fuzzy(spark, sf):
    rows = fuzzy.composite_change(prepared(spark, sf).table, SPEC, INDICATORS)
    return fuzzy.multiplier(fuzzy.memberships(rows))


@query("B15_composite_change", sql.with_(_FUZZY, f"SELECT entity, {sql.day('d', 'd')}, {sql.r('u', 'composite_roc')} FROM roc"))
def composite_change(spark, sf):
    return tidy(fuzzy.composite_change(prepared(spark, sf).table, SPEC, INDICATORS).select("entity", "d", "composite_roc"))


@query("B16_memberships", sql.with_(_FUZZY, f"SELECT entity, {sql.day('d', 'd')}, {', '.join(sql.r(c, c) for c in ('stable', 'moderate', 'surge'))} FROM sets"))
def memberships(spark, sf):
    return tidy(_fuzzy(spark, sf).select("entity", "d", "stable", "moderate", "surge"))


@query("B17_multiplier", sql.with_(_FUZZY, f"SELECT entity, {sql.day('d', 'd')}, {sql.r('gamma', 'gamma')} FROM gammas"))
def multiplier(spark, sf):
    return tidy(_fuzzy(spark, sf).select("entity", "d", "gamma"))


@query("B18_attention_weights", sql.with_(_FUZZY + """,
energies AS (SELECT entity, d, pos, scaled_target * coalesce(gamma, 1.0::DOUBLE) AS e FROM gammas),
spread AS (SELECT entity, d, pos, e, max(e) OVER w AS peak, lag(e, 29) OVER (PARTITION BY entity ORDER BY d) AS e0, list(e) OVER w AS es FROM energies
           WINDOW w AS (PARTITION BY entity ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
totals AS (SELECT *, list_sum(list_transform(es, lambda x: exp(x - peak))) AS total FROM spread WHERE pos >= 30)""",
    f"""SELECT entity, {sql.day('d', 'd')}, {sql.r('exp(e0 - peak) / total', 'oldest')}, {sql.r('exp(e - peak) / total', 'newest')},
    {sql.r('1.0::DOUBLE / total', 'largest')}, 1.0::DOUBLE AS total, CAST(30 AS BIGINT) AS steps FROM totals"""))
def attention_weights(spark, sf):
    out = fuzzy.attention_weights(_fuzzy(spark, sf), SPEC, "scaled_target")
    w = F.col("weights")
    return tidy(out.select("entity", "d", w[0].alias("oldest"), F.element_at(w, -1).alias("newest"), F.array_max(w).alias("largest"),
                           F.aggregate(w, F.lit(0.0), lambda a, v: a + v).alias("total"), F.size(w).alias("steps")))


@query("B18_attention_with_gaps", sql.with_(_FUZZY + """,
energies AS (SELECT entity, d, pos, CASE WHEN pos % 5 <> 2 THEN scaled_target * coalesce(gamma, 1.0::DOUBLE) END AS e FROM gammas),
spread AS (SELECT entity, d, pos, e, max(e) OVER w AS peak, lag(e, 29) OVER (PARTITION BY entity ORDER BY d) AS e0,
           list(e) FILTER (WHERE e IS NOT NULL) OVER w AS es FROM energies
           WINDOW w AS (PARTITION BY entity ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
totals AS (SELECT *, list_sum(list_transform(es, lambda x: exp(x - peak))) AS total FROM spread WHERE pos >= 30)""",
    f"""SELECT entity, {sql.day('d', 'd')}, {sql.r('coalesce(exp(e0 - peak) / total, 0.0)', 'oldest')}, {sql.r('coalesce(exp(e - peak) / total, 0.0)', 'newest')},
    CAST(30 AS BIGINT) AS steps, CAST(30 - len(es) AS BIGINT) AS n_zero FROM totals"""))
def attention_with_gaps(spark, sf):
    """Every fifth score missing: its step stays, with weight 0."""
    rows = _fuzzy(spark, sf).withColumn("scaled_target", F.when(F.col("_pos") % 5 != 2, F.col("scaled_target")))
    w = F.col("weights")
    out = fuzzy.attention_weights(rows, SPEC, "scaled_target")
    return tidy(out.select("entity", "d", w[0].alias("oldest"), F.element_at(w, -1).alias("newest"), F.size(w).alias("steps"),
                           F.size(F.filter(w, lambda v: v == 0)).alias("n_zero")))


_BEST = f"greatest({', '.join(f'scaled_{m}' for m in MEASURES)})"


@query("B29_dominant_driver", sql.with_(sql.SCALED, f"""
SELECT entity, {sql.day('d', 'd')}, CASE {' '.join(f"WHEN scaled_{m} = {_BEST} THEN '{m}'" for m in MEASURES)} END AS driver, {sql.r(_BEST, 'driver_value')}
FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY d DESC) AS rn FROM scaled) WHERE rn = 1"""))
def dominant_driver(spark, sf):
    scaled = [f"scaled_{m}" for m in MEASURES]
    newest = catalogue.latest_rows(prepared(spark, sf).table, "entity", "d", scaled)
    return tidy(catalogue.dominant_driver(newest, SPEC))


@query("B30_page", sql.with_(sql.PANEL, f"""
SELECT entity, {sql.day('d', 'd')}, {sql.r('target', 'target')}, bucket FROM (SELECT * FROM panel ORDER BY entity, d LIMIT 50 OFFSET 100)"""))
def page(spark, sf):
    return tidy(catalogue.page(panel(spark, sf), ["entity", "d"], 50, offset=100).select("entity", "d", "target", "bucket"))


@query("B30_page_of_listing", sql.with_(sql.PANEL, f"""
SELECT entity, {sql.day('d', 'd')}, {sql.r('target', 'target')}, bucket FROM (
  SELECT *, row_number() OVER (ORDER BY entity, d) AS place FROM panel) WHERE place > 150 AND place <= 200"""))
def page_of_listing(spark, sf):
    path = scratch_path(spark, "listing")
    stored = listing.write_listing(panel(spark, sf).select("entity", "d", "target", "bucket"), ["entity", "d"], path)
    last = stored.page(spark, 1, offset=149).first()
    return tidy(stored.page(spark, 50, after=(last["entity"], last["d"])))


@query("B30_csv_export", sql.with_(sql.PANEL, f"SELECT entity, CAST(d AS VARCHAR) AS d, {', '.join(sql.r(c, c) for c in NUMERIC)} FROM panel"))
def csv_export(spark, sf):
    path = scratch_path(spark, "export")
    files.write_csv(panel(spark, sf).select("entity", "d", *NUMERIC), path)
    return tidy(files.read_raw_csv(spark, path).select("entity", "d", *[F.col(c).cast("double").alias(c) for c in NUMERIC]))


@query("B31_readiness", sql.with_(sql.PANEL + """,
runs AS (SELECT entity, d - CAST(row_number() OVER (PARTITION BY entity ORDER BY d) AS INTEGER) AS run FROM panel),
lengths AS (SELECT entity, run, count(*) AS n FROM runs GROUP BY 1, 2)""", """
SELECT entity, CAST(sum(n) AS BIGINT) AS n_rows, max(n) AS longest_run, sum(n) >= 31 AS enough_rows, max(n) >= 31 AS enough_consecutive
FROM lengths GROUP BY entity"""))
def readiness(spark, sf):
    return catalogue.readiness(panel(spark, sf), SPEC, 31)
