"""Chronological split."""

from pyspark.sql import functions as F

from longspan.operators import split
from longspan.session import scratch_path
from longspan.sources import files
from registry import sql
from registry.core import SPEC, filled, panel, query, tidy


@query("X1_chronological_split", sql.with_(sql.SPLIT, f"SELECT entity, {sql.day('d', 'd')}, split, CAST(pos AS BIGINT) AS pos, CAST(spos AS BIGINT) AS split_pos, CAST(sn AS BIGINT) AS split_rows FROM splits"))
def chronological_split(spark, sf):
    out = split.assign_split(panel(spark, sf), SPEC)
    return tidy(out.select("entity", "d", "split", F.col("_pos").alias("pos"), F.col("_split_pos").alias("split_pos"), F.col("_split_rows").alias("split_rows")))


@query("X2_temporal_leaks", sql.with_(sql.SPLIT, """
SELECT entity, CAST(train_min AS VARCHAR) AS train_min, CAST(train_max AS VARCHAR) AS train_max, CAST(val_min AS VARCHAR) AS val_min,
       CAST(val_max AS VARCHAR) AS val_max, CAST(test_min AS VARCHAR) AS test_min, CAST(test_max AS VARCHAR) AS test_max
FROM (SELECT entity, min(d) FILTER (WHERE split = 'train') AS train_min, max(d) FILTER (WHERE split = 'train') AS train_max,
      min(d) FILTER (WHERE split = 'val') AS val_min, max(d) FILTER (WHERE split = 'val') AS val_max,
      min(d) FILTER (WHERE split = 'test') AS test_min, max(d) FILTER (WHERE split = 'test') AS test_max FROM splits GROUP BY entity)
WHERE train_max >= val_min OR val_max >= test_min"""))
def temporal_leaks(spark, sf):
    return tidy(split.temporal_leaks(filled(spark, sf), SPEC))


_MOVED = """,
moved AS (SELECT * REPLACE (CASE WHEN pos % 97 = 5 AND split = 'train' THEN 'test' WHEN entity < 'NATION_2' AND pos % 89 = 7 THEN 'val' ELSE split END AS split) FROM splits)"""


def _moved(spark, sf):
    """Splits with planted leaks: some training rows in test, and for some entities rows of any time in val."""
    rows = filled(spark, sf)
    pos = F.col("_pos")
    return rows.withColumn("split", F.when((pos % 97 == 5) & (F.col("split") == "train"), "test").when(
        (F.col("entity") < "NATION_2") & (pos % 89 == 7), "val").otherwise(F.col("split")))


@query("X2_planted_leaks", sql.with_(sql.SPLIT + _MOVED, """
SELECT entity, CAST(train_min AS VARCHAR) AS train_min, CAST(train_max AS VARCHAR) AS train_max, CAST(val_min AS VARCHAR) AS val_min,
       CAST(val_max AS VARCHAR) AS val_max, CAST(test_min AS VARCHAR) AS test_min, CAST(test_max AS VARCHAR) AS test_max
FROM (SELECT entity, min(d) FILTER (WHERE split = 'train') AS train_min, max(d) FILTER (WHERE split = 'train') AS train_max,
      min(d) FILTER (WHERE split = 'val') AS val_min, max(d) FILTER (WHERE split = 'val') AS val_max,
      min(d) FILTER (WHERE split = 'test') AS test_min, max(d) FILTER (WHERE split = 'test') AS test_max FROM moved GROUP BY entity)
WHERE train_max >= val_min OR val_max >= test_min"""))
def planted_leaks(spark, sf):
    return tidy(split.temporal_leaks(_moved(spark, sf), SPEC))


@query("X5_planted_overlap", sql.with_(sql.SPLIT + """,
doubled AS (SELECT entity, d, split FROM splits UNION ALL SELECT entity, d, 'test' FROM splits WHERE pos % 61 = 3 AND split <> 'test')""", f"""
SELECT entity, {sql.day('d', 'd')}, count(DISTINCT split) AS n_splits FROM doubled GROUP BY 1, doubled.d HAVING count(DISTINCT split) > 1"""))
def planted_overlap(spark, sf):
    rows = filled(spark, sf)
    again = rows.where((F.col("_pos") % 61 == 3) & (F.col("split") != "test")).withColumn("split", F.lit("test"))
    return tidy(split.shared_keys(rows.unionByName(again), SPEC))


@query("X3_split_ranges", sql.with_(sql.SPLIT, f"SELECT entity, split, count(*) AS n_rows, {sql.day('min(d)', 'start')}, {sql.day('max(d)', '\"end\"')} FROM splits GROUP BY 1, 2"))
def split_ranges(spark, sf):
    return tidy(split.split_ranges(filled(spark, sf), SPEC))


@query("X4_overall_ranges", sql.with_(sql.SPLIT, f"SELECT split, count(*) AS n_rows, {sql.day('min(d)', 'start')}, {sql.day('max(d)', '\"end\"')} FROM splits GROUP BY 1"))
def overall_ranges(spark, sf):
    return tidy(split.overall_ranges(filled(spark, sf), SPEC))


@query("X5_shared_keys", sql.with_(sql.SPLIT, f"SELECT entity, {sql.day('d', 'd')}, count(DISTINCT split) AS n_splits FROM splits GROUP BY 1, splits.d HAVING count(DISTINCT split) > 1"))
def shared_keys(spark, sf):
    return tidy(split.shared_keys(filled(spark, sf), SPEC))


@query("X6_tagged_union", sql.with_(sql.SPLIT, "SELECT split, entity, count(*) AS n, count(target) AS n_target FROM splits GROUP BY 1, 2"))
def tagged_union(spark, sf):
    base = scratch_path(spark, "parts")
    out = split.assign_split(panel(spark, sf), SPEC)
    files.write_by_split(out, base)
    parts = {s: files.read_panel(spark, f"{base}/split={s}") for s in ("train", "val", "test")}
    return split.tagged_union(parts).groupBy("split", "entity").agg(F.count("*").alias("n"), F.count("target").alias("n_target"))
