"""IO1-IO7: scans, sinks and round trips."""

from pyspark.sql import functions as F

from longspan.operators import profile, sequences, split, validate
from longspan.config import SequenceConfig
from longspan.operators.scale import params_table
from longspan.session import scratch_path
from longspan.sources import files
from registry import sql
from registry.core import MEASURES, NUMERIC, SPEC, clean_raw, model_ready, panel, prepared, query, raw_panel, table, tidy

_ALL = ", ".join(SPEC.required)
_VALUES = ", ".join(sql.r(c, c) for c in NUMERIC)


@query("IO1_csv_scan", sql.with_(sql.RAW, f"SELECT {_ALL} FROM raw"))
def csv_scan(spark, sf):
    path = scratch_path(spark, "raw_csv")
    raw = raw_panel(spark, sf)
    raw.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return validate.clean_nulls(files.read_raw_csv(spark, path))


@query("IO1_csv_reordered_header", sql.with_(sql.RAW, f"SELECT {_ALL} FROM raw WHERE entity IS NOT NULL"))
def csv_reordered_header(spark, sf):
    """Two files whose headers list the columns in opposite order."""
    path = scratch_path(spark, "raw_csv")
    raw = raw_panel(spark, sf)
    early = F.coalesce(F.crc32(F.col("d").cast("binary")) % 2 == 0, F.lit(False))
    for part, columns in ((raw.where(early), raw.columns), (raw.where(~early), raw.columns[::-1])):
        writer = part.select(*columns).coalesce(1).write.mode("append").option("header", True)
        writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return validate.clean_nulls(files.read_raw_csv(spark, path)).select(*SPEC.required).where("entity IS NOT NULL")


@query("IO2_parquet_scan", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
  (round(l_quantity, 6) + 0.0) AS l_quantity, (round(l_extendedprice, 6) + 0.0) AS l_extendedprice, (round(l_discount, 6) + 0.0) AS l_discount,
  (round(l_tax, 6) + 0.0) AS l_tax, CAST(l_shipdate AS VARCHAR)[1:10] AS day FROM lineitem""")
def parquet_scan(spark, sf):
    lines = files.read_panel(spark, f"{sf}/lineitem.parquet")
    return tidy(lines.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity",
                             "l_extendedprice", "l_discount", "l_tax", F.to_date("l_shipdate").alias("day")))


@query("IO2_parquet_pushdown", """
SELECT l_orderkey, l_linenumber, l_returnflag, (round(l_quantity, 6) + 0.0) AS l_quantity, CAST(l_shipdate AS VARCHAR)[1:10] AS day
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_linestatus = 'O'""".replace("l_linenumber,", "CAST(l_linenumber AS BIGINT) AS l_linenumber,"))
def parquet_pushdown(spark, sf):
    lines = files.read_panel(spark, f"{sf}/lineitem.parquet")
    lines = lines.where((F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp")) & (F.col("l_linestatus") == "O"))
    return tidy(lines.select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", F.to_date("l_shipdate").alias("day")))


@query("IO3_parquet_sink", sql.with_(sql.PANEL, f"SELECT entity, {sql.day('d', 'd')}, {_VALUES}, bucket FROM panel"))
def parquet_sink(spark, sf):
    path = scratch_path(spark, "panel")
    files.write_panel(validate.sorted_panel(panel(spark, sf), SPEC), path)
    return tidy(files.read_panel(spark, path))


@query("IO4_split_sink", sql.with_(sql.IMPUTED, f"""
SELECT entity, {sql.day('d', 'd')}, split, {_VALUES} FROM imputed"""))
def split_sink(spark, sf):
    path = scratch_path(spark, "prepared")
    files.write_by_split(prepared(spark, sf).table.select("entity", "d", "split", *NUMERIC), path)
    parts = [files.read_panel(spark, path).where(F.col("split") == s) for s in ("train", "val", "test")]  # one directory each
    return tidy(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query("IO5_report_sink", sql.with_(sql.PANEL, """
SELECT 'category_distribution' AS section, coalesce(bucket, 'Missing') AS "key", 'n' AS metric, CAST(count(*) AS VARCHAR) AS "value"
FROM panel GROUP BY bucket
UNION ALL SELECT 'entity_rows', entity, 'n_rows', CAST(count(*) AS VARCHAR) FROM panel GROUP BY entity"""))
def report_sink(spark, sf):
    path = scratch_path(spark, "report")
    p = panel(spark, sf)
    rows = p.groupBy("entity").agg(F.count("*").alias("n_rows"))
    report = profile.long_form(profile.category_counts(p, SPEC), "category_distribution", ["category"]).unionByName(
        profile.long_form(rows, "entity_rows", ["entity"]))
    files.write_report(report, path)
    return files.read_report(spark, path)


@query("IO6_sample_sink", sql.with_(sql.windows(), f"""
SELECT split, count(*) AS n, {sql.r('sum(y::DOUBLE)', 'y_sum', 1)}, 30 * count(*) AS n_steps
FROM candidates WHERE target_observed GROUP BY split""".replace("30 * count(*)", "CAST(30 * count(*) AS BIGINT)")))
def sample_sink(spark, sf):
    path = scratch_path(spark, "samples")
    data, names = model_ready(spark, sf)
    cfg = SequenceConfig()
    files.write_by_split(sequences.sample_chunks(data, SPEC, cfg, names), path)
    return tidy(sequences.read_samples(files.read_panel(spark, path), SPEC, cfg).groupBy("split").agg(
        F.count("*").alias("n"), F.sum(F.col("y").cast("double")).alias("y_sum"), F.sum(F.size("x")).alias("n_steps")), 1)


@query("IO7_params_store", sql.with_(sql.SCALED, sql.union(
    f"""SELECT '{c}' AS "column", {sql.r(f'max(md.{c})', 'median', 4)}, {sql.r(f'max(m_{c})', 'mean', 4)}, {sql.r(f'max(s_{c})', 'scale', 4)}
    FROM medians md CROSS JOIN moments""" for c in NUMERIC)))
def params_store(spark, sf):
    path = scratch_path(spark, "params")
    files.save_params(spark, prepared(spark, sf).params, path)
    return tidy(params_table(spark, files.load_params(spark, path)).select("column", "median", "mean", "scale"), 4)
